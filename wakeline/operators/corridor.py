"""The corridor study: projection, transits, waypoint times, spacing, concurrency, profiles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config
from wakeline.functions.geo import projection
from wakeline.operators.quantiles import exact_quantiles
from wakeline.operators.segments import with_segments


def in_corridor(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Points of the padded box that are fast and low enough, with along and cross. Cross-track is not filtered on."""
    lats, lons = [w[1] for w in cfg.corridor], [w[2] for w in cfg.corridor]
    dlat, dlon = cfg.corridor_buffer_nm / 60, cfg.corridor_buffer_nm / (60 * cfg.cos_corridor)
    box = F.col("lat").between(min(lats) - dlat, max(lats) + dlat) & F.col("lon").between(min(lons) - dlon, max(lons) + dlon)
    kept = points.where(box & (F.col("gs") >= cfg.corridor_min_gs) & F.col("alt_ft").between(0, cfg.corridor_ceiling_ft))
    kept = kept.withColumn("_p", projection(F.col("lat"), F.col("lon"), cfg))
    return kept.withColumn("along", F.col("_p.along")).withColumn("cross", F.col("_p.cross")).drop("_p")


def transit_points(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Points of runs (hex, day, seg) that pass along the corridor in its direction.

    Runs break at archive days as well as gaps; a pass spans enough of the corridor and has a
    rising least-squares line. ``hex`` and ``day`` are one entity here.
    """
    rows = in_corridor(points, cfg).withColumn("_hex", F.col("hex")).withColumn("hex", F.struct("hex", "day"))
    rows = with_segments(rows, cfg).withColumn("hex", F.col("_hex")).drop("_hex", "dt", "dnm", "speed")
    run = Window.partitionBy("hex", "day", "seg")
    start = F.min("ts").over(run)
    rows = rows.withColumn("_x", F.col("ts") - start)
    slope = F.covar_pop(F.col("along"), F.col("_x")).over(run)  # the sign of the slope is the sign of the covariance
    rows = rows.withColumns({"_n": F.count("*").over(run), "_span": F.max("along").over(run) - F.min("along").over(run), "_slope": slope})
    good = (F.col("_n") >= cfg.transit_points) & (F.col("_span") >= cfg.transit_span_nm) & (F.col("_slope") > 0)
    return rows.where(good).drop("_x", "_n", "_span", "_slope")


def waypoints(transits: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(hex, day, seg, code, wp, t, alt_ft, gs): values interpolated where the running maximum of along meets each waypoint."""
    w = Window.partitionBy("hex", "day", "seg").orderBy("ts")
    rows = transits.withColumn("m", F.max("along").over(w.rowsBetween(Window.unboundedPreceding, 0)) + (F.row_number().over(w) - 1) * F.lit(1e-9))
    rows = rows.withColumns({"m2": F.lead("m").over(w), "t2": F.lead("ts").over(w), "a2": F.lead("alt_ft").over(w), "g2": F.lead("gs").over(w)})
    codes = F.array(*[F.struct(F.lit(i).alias("wp"), F.lit(c).alias("code"), F.lit(d).alias("at")) for i, (c, d) in enumerate(cfg.waypoint_nm.items())])
    rows = rows.withColumn("w", F.explode(F.filter(codes, lambda c: (F.col("m") <= c["at"]) & (F.coalesce(c["at"] < F.col("m2"), c["at"] == F.col("m"))))))
    share = (F.col("w.at") - F.col("m")) / (F.col("m2") - F.col("m"))
    mid = lambda a, b: F.coalesce(F.col(a) + (F.col(b) - F.col(a)) * share, F.col(a).cast("double"))
    return rows.select("hex", "day", "seg", F.col("w.code").alias("code"), F.col("w.wp").alias("wp"), mid("ts", "t2").alias("t"), mid("alt_ft", "a2").alias("alt_ft"), mid("gs", "g2").alias("gs"))


def segment_speeds(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Speed between neighbouring waypoints that a transit has both of."""
    w = Window.partitionBy("hex", "day", "seg").orderBy("wp")
    at = F.create_map(*[F.lit(x) for i, d in enumerate(cfg.waypoint_nm.values()) for x in (i, d)])
    rows = points.withColumns({"next_wp": F.lead("wp").over(w), "next_t": F.lead("t").over(w), "next_code": F.lead("code").over(w)})
    rows = rows.where((F.col("next_wp") == F.col("wp") + 1) & (F.col("next_t") > F.col("t")))
    return rows.select("hex", "day", "seg", F.concat_ws("_", "code", "next_code").alias("part"), F.round((at[F.col("next_wp")] - at[F.col("wp")]) / (F.col("next_t") - F.col("t")) * 3600, 1).alias("gs"))


def spacing(points: DataFrame, code: str) -> DataFrame:
    """In-trail spacing at a waypoint: gap to the transit before on the same day, from rounded times and speeds.

    Rows follow each other within an hour; an hour's first one follows the last one of the day's hour before, of
    which a day has two dozen.
    """
    rows = points.where(F.col("code") == code).select("hex", "day", "seg", F.round("t", 1).alias("t"), F.round("gs", 1).alias("gs"))
    rows = rows.where("t is not null").withColumn("hour", F.floor(F.col("t") / 3600))
    state, order = F.struct("t", "gs", "hex"), F.struct("t", "hex", "seg")
    last = rows.groupBy("day", "hour").agg(F.max_by(state, order).alias("last"))
    hours = last.groupBy("day").agg(F.sort_array(F.collect_list(F.struct("hour", "last"))).alias("h"))
    carried = hours.select("day", F.explode(F.transform("h", lambda x, i: F.struct(x["hour"].alias("hour"), F.get("h", i - 1)["last"].alias("carry"))))).select("day", "col.hour", "col.carry")
    w = Window.partitionBy("day", "hour").orderBy("t", "hex", "seg")
    rows = rows.withColumn("lead", F.lag(state).over(w)).join(carried, ["day", "hour"]).withColumn("lead", F.coalesce("lead", "carry")).where("lead is not null")
    gap = F.col("t") - F.col("lead.t")
    lead_gs = F.col("lead.gs")
    return rows.select("hex", "day", "seg", F.round(gap, 1).alias("gap_s"), F.round(gap * (F.col("gs") + lead_gs) / 2 / 3600, 3).alias("gap_nm"), F.col("lead.hex").alias("lead_hex"), lead_gs.alias("lead_gs"))


def peak_concurrency(points: DataFrame, first: str, last: str) -> DataFrame:
    """Most transits at once between two waypoints and the earliest time of it; entries come before exits at one instant.

    The sweep is summed by hour first, so only the steps inside an hour are ordered together.
    """
    at = lambda c: F.max(F.when(F.col("code") == c, F.round("t", 1)))
    spans = points.groupBy("hex", "day", "seg").agg(at(first).alias("a"), at(last).alias("b")).where("a is not null and b is not null")
    steps = spans.select(F.explode(F.array(F.struct(F.col("a").alias("t"), F.lit(1).alias("d")), F.struct(F.col("b").alias("t"), F.lit(-1).alias("d")))).alias("e")).select("e.t", "e.d")
    steps = steps.groupBy("t", "d").agg(F.sum("d").alias("n")).withColumn("hour", F.floor(F.col("t") / 3600))
    hours = steps.groupBy("hour").agg(F.sum("n").alias("net"))
    before = hours.withColumn("carry", F.sum("net").over(Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1))).select("hour", F.coalesce("carry", F.lit(0)).alias("carry"))
    w = Window.partitionBy("hour").orderBy("t", F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    level = steps.join(before, "hour").withColumn("level", F.sum("n").over(w) + F.col("carry"))
    return level.agg(F.max("level").alias("peak"), F.min_by("t", F.struct(-F.col("level"), F.col("t"))).alias("peak_t"))


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Dense bins over [low, high], the last one closed; values outside, and nulls, are dropped."""
    width = (high - low) / bins
    v = F.col(value)
    counts = rows.where(v.between(low, high)).groupBy(F.when(v == high, bins - 1).otherwise(F.floor((v - low) / width)).cast("int").alias("bin")).count()
    grid = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(F.broadcast(counts), "bin", "left").select("bin", (F.lit(low) + F.col("bin") * width).alias("edge"), F.coalesce("count", F.lit(0)).alias("n"))


def along_profile(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Exact quartiles of gs and altitude for each nautical mile along; null below three points.

    Quartiles are found by counting, so no bin's values are held together.
    """
    bins = max(1, math.ceil(max(cfg.waypoint_nm.values())))
    rows = points.select(F.least(F.greatest(F.col("along").cast("int"), F.lit(0)), F.lit(bins - 1)).alias("bin"), "gs", "alt_ft")
    found = exact_quantiles(rows, "bin", ["gs", "alt_ft"], [0.25, 0.5, 0.75])
    named = {("gs", 0): ("gs_p25", 1), ("gs", 1): ("gs_median", 1), ("gs", 2): ("gs_p75", 1), ("alt_ft", 0): ("alt_p25", 0), ("alt_ft", 1): ("alt_median", 0), ("alt_ft", 2): ("alt_p75", 0)}
    one = lambda c, i: F.max(F.when((F.col("column") == c) & (F.col("i") == i), F.col("value")))
    wide = found.groupBy("bin").agg(*[one(c, i).alias(name) for (c, i), (name, _) in named.items()])
    got = rows.groupBy("bin").agg(F.count("*").alias("n")).join(F.broadcast(wide), "bin", "left")  # a row for each bin
    enough = F.col("n") >= 3
    return got.select("bin", (F.col("bin") + 0.5).cast("double").alias("centre"), "n", *[F.when(enough, F.round(name, d)).alias(name) for name, d in named.values()])


def on_profile(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Percent of transits at the last waypoint within tolerance of the published altitudes."""
    fisk = points.where(F.col("code") == cfg.corridor[-1][0]).withColumn("alt", F.round("alt_ft", 0))
    low, high = F.abs(F.col("alt") - cfg.low_ft) <= cfg.tolerance_ft, F.abs(F.col("alt") - cfg.high_ft) <= cfg.tolerance_ft
    pct = lambda c: F.round(F.avg(c.cast("double")) * 100, 4)
    return fisk.agg(F.count("*").alias("n"), pct(low).alias("pct_low"), pct(high).alias("pct_high"), pct(low | high).alias("pct_either"), F.round(F.percentile("gs", F.lit(0.5)), 4).alias("median_gs"))
