"""Tracks for display and lookup: downsampling, interpolation, neighbours, interval joins, visits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config
from wakeline.functions.geo import flat_nm
from wakeline.operators.reports import numbered


def kept_places(ts: np.ndarray, wait: np.ndarray, track: np.ndarray, turn: float) -> list[int]:
    """Places of a segment that a display keeps: both ends, and each first place that is due.

    A place is due once its own wait has passed since the last kept one, or
    its heading is ``turn`` degrees off the last one known there; an unknown
    heading is never off. The next due place is looked for in ever longer stretches.
    """
    places, end = [0], len(ts) - 1
    known = track[0]
    at, reach = 1, 16
    while at < end:
        stretch = slice(at, min(end, at + reach))
        off = np.abs(np.remainder(track[stretch] - known + 180.0, 360.0) - 180.0)
        due = np.flatnonzero((ts[stretch] - ts[places[-1]] >= wait[stretch]) | (off >= turn))
        if not len(due):
            at, reach = stretch.stop, 2 * reach
            continue
        place = at + int(due[0])
        places.append(place)
        known = known if np.isnan(track[place]) else track[place]
        at, reach = place + 1, 16
    return places if not end else [*places, end]


def _borders(rows: pa.Table) -> np.ndarray:
    """Places where another (hex, seg) begins; ids of any type, a null one being an id of its own."""
    new = np.zeros(max(0, rows.num_rows - 1), bool)
    for name in ("hex", "seg"):
        codes = pc.dictionary_encode(rows.column(name).combine_chunks(), null_encoding="encode").indices.to_numpy()
        new |= np.diff(codes) != 0
    return np.flatnonzero(new) + 1


def _walk(cfg: Config) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (hex, seg, ts, near, track) sorted by segment and time to the kept (hex, seg, ts), many segments at once."""

    def kept(parts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(parts).combine_chunks()
        ts, near, track = (rows.column(c).to_numpy() for c in ("ts", "near", "track"))
        wait = np.where(near, cfg.near_interval_s, cfg.far_interval_s)
        new = _borders(rows).tolist()
        places = [a + i for a, b in zip([0, *new], [*new, len(ts)]) for i in kept_places(ts[a:b], wait[a:b], track[a:b], cfg.heading_deg)]
        yield from rows.select(["hex", "seg", "ts"]).take(places).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # a segment's rows so far; only new rows are looked through for its end
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            joined = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), rows]) if held else rows
            new = _borders(joined) - (1 if held else 0)
            if len(new):  # the last segment may go on in the next batch
                yield from kept([*held, rows.slice(0, int(new[-1]))])
                held = []
                rows = rows.slice(int(new[-1]))
            held.append(rows)
        if held:
            yield from kept(held)

    return run


def downsample(points: DataFrame, most: int, cfg: Config = DEFAULT, share: bool = False) -> DataFrame:
    """Kept points (hex, seg, ts) of each segment.

    Each next choice depends on the last one, so sorted partitions are walked
    segment by segment. ``share``: ``most`` is a budget for the entity, dealt to
    its segments by their kept points, four at least; else it holds for each
    segment. Too many points are thinned evenly, by their rank. A segment of one point keeps it.
    Ids keep their types; null ids are one entity, or segment, of their own.
    """
    near = flat_nm(F.col("lat") - cfg.anchor_lat, F.col("lon") - cfg.anchor_lon, cfg) <= cfg.near_nm
    heading = F.coalesce(F.col("track").cast("double"), F.lit(float("nan")))
    rows = points.select("hex", "seg", F.col("ts").cast("double").alias("ts"), F.coalesce(near, F.lit(False)).alias("near"), heading.alias("track"))
    rows = rows.repartition("hex", "seg").sortWithinPartitions("hex", "seg", "ts")
    kept = rows.mapInArrow(_walk(cfg), rows.select("hex", "seg", "ts").schema)
    w, seg = Window.partitionBy("hex"), Window.partitionBy("hex", "seg")
    kept = kept.withColumns({"k": F.count("*").over(seg), "r": F.row_number().over(seg.orderBy("ts")) - 1})
    cap = F.least("k", F.lit(most))
    if share:
        kept = kept.withColumn("n", F.count("*").over(w))
        cap = F.when((F.col("n") > most) & (F.col("k") > 4), F.least("k", F.greatest(F.lit(4), F.floor(F.col("k") * most / F.col("n"))))).otherwise(F.col("k"))
    kept = kept.withColumn("cap", cap.cast("long"))
    # Ranks floor(j step) stay, j = 0 .. cap - 1; the j of a rank is its quotient or next to it.
    step = (F.col("k") - 1) / F.nullif(F.col("cap") - 1, F.lit(0))
    j = F.ceil(F.try_divide("r", step))
    stays = F.lit(False)
    for by in (-1, 0, 1):
        stays = stays | (F.floor((j + by) * step) == F.col("r"))
    return kept.where((F.col("cap") == F.col("k")) | (F.col("r") == F.col("k") - 1) | stays).select("hex", "seg", "ts")


def at_times(series: DataFrame, keys: list[str], x: str, values: list[str], queries: DataFrame, q: str, bucket: float = 600.0) -> DataFrame:
    """Values linearly interpolated at queries (keys, q); null bracket values give null, outside gives no row.

    A bracket is a row with the next one; queries meet brackets by key and
    bucket of ``x``, so that a long series isn't met whole.
    """
    w = Window.partitionBy(*keys).orderBy(x)
    rows = series.select(*keys, x, *values, F.lead(x).over(w).alias("_x2"), *[F.lead(v).over(w).alias(f"_{v}2") for v in values])
    number = lambda c: F.floor(c / bucket)
    rows = rows.where(F.col(x).isNotNull()).withColumn("_bucket", F.explode(F.sequence(number(F.col(x)), number(F.coalesce("_x2", x)))))
    inside = (F.col(q) >= F.col(x)) & F.coalesce(F.col(q) < F.col("_x2"), F.col(q) == F.col(x))
    share = (F.col(q) - F.col(x)) / (F.col("_x2") - F.col(x))
    out = rows.join(queries.withColumn("_bucket", number(F.col(q))), [*keys, "_bucket"]).where(inside)
    mixed = [F.when(F.col("_x2").isNull(), F.col(v).cast("double")).otherwise(F.col(v) + (F.col(f"_{v}2") - F.col(v)) * share).alias(v) for v in values]
    return out.select(*keys, q, *mixed)


def headings_at(points: DataFrame, queries: DataFrame, bucket_s: int = 600) -> DataFrame:
    """(hex, q, lat, lon, heading) at queries (hex, q), between two points of a track; headings turn the short way.

    Brackets and queries meet by entity and time bucket, so a long track is not met whole.
    """
    w = Window.partitionBy("hex").orderBy("ts")
    after = {f"_{c}2": F.lead(c).over(w) for c in ("ts", "lat", "lon", "track")}
    rows = points.select("hex", "ts", "lat", "lon", "track").withColumns(after).where("_ts2 > ts")
    rows = rows.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("ts") / bucket_s), F.floor(F.col("_ts2") / bucket_s))))
    met = rows.join(queries.withColumn("_bucket", F.floor(F.col("q") / bucket_s)), ["hex", "_bucket"]).where("q >= ts and q < _ts2")
    f = (F.col("q") - F.col("ts")) / (F.col("_ts2") - F.col("ts"))
    turn = F.pmod(F.col("_track2") - F.col("track") + 540, F.lit(360.0)) - 180
    between = lambda c: (F.col(c) + (F.col(f"_{c}2") - F.col(c)) * f).alias(c)
    return met.select("hex", "q", between("lat"), between("lon"), F.pmod(F.col("track") + turn * f + 360, F.lit(360.0)).alias("heading"))


def points_in_spans(points: DataFrame, spans: DataFrame, slack: float = 1.0, least: int = 2) -> DataFrame:
    """How many points of an entity lie in each of its spans (hex, leg_idx, t_start, t_end), with slack; at least ``least``.

    One sweep over the points and the spans' edges: a span has the points before its end that are not before its start, so
    an entity's points never meet its spans one by one. Rows without an entity or an instant count nowhere.
    """
    at = points.where("hex is not null and ts is not null").select("hex", F.col("ts").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(spans.schema["leg_idx"].dataType).alias("leg_idx"))
    edges = F.array(F.struct((F.col("t_start") - slack).alias("t"), F.lit(0).alias("kind")), F.struct((F.col("t_end") + slack).alias("t"), F.lit(2).alias("kind")))
    sides = spans.where("hex is not null and t_start <= t_end").select("hex", F.explode(edges).alias("e"), "leg_idx").select("hex", "e.t", "e.kind", "leg_idx")
    rows = at.union(sides).withColumn("one", F.col("kind") % 2)
    passed = numbered(rows, "t", ["kind"], within=["hex"], size="one").where("kind <> 1")
    counts = passed.groupBy("hex", "leg_idx").agg(F.sum(F.when(F.col("kind") == 2, F.col("start")).otherwise(-F.col("start"))).alias("n"))
    return counts.where(F.col("n") >= least)


def stab_counts(spans: DataFrame, t0: float, step: float, times: int) -> DataFrame:
    """(t, n): spans (t_start, t_end) that hold each of ``times`` instants from t0 on, ends included.

    A span adds one at its first instant and takes it back after its last; the running sum is the count.
    """
    place = lambda f, c: f((F.col(c) - t0) / step)
    first, after = F.greatest(place(F.ceil, "t_start"), F.lit(0)), F.least(place(F.floor, "t_end") + 1, F.lit(times))
    steps = spans.withColumns({"_a": first, "_b": after}).where("_a < _b")
    steps = steps.select(F.explode(F.array(F.struct(F.col("_a").alias("i"), F.lit(1).alias("d")), F.struct(F.col("_b").alias("i"), F.lit(-1).alias("d")))).alias("e"))
    net = steps.groupBy(F.col("e.i").alias("i")).agg(F.sum("e.d").alias("net"))
    grid = spans.sparkSession.range(times).select(F.col("id").alias("i"), (F.lit(float(t0)) + F.col("id") * step).alias("t"))
    rows = numbered(grid.join(net, "i", "left").withColumn("net", F.coalesce("net", F.lit(0))), "t", [], size="net")
    return rows.select("t", (F.col("start") + F.col("net")).alias("n"))


def neighbours_at(transits: DataFrame, instants: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    """(day, q, ids, values): the state of every transit (day, ids, ts, values) under way at each instant (day, q).

    A transit is under way from its first to its last point, both included; values are interpolated. Brackets and
    instants meet by day and ten minutes.
    """
    keys = ["day", *ids]
    w = Window.partitionBy(*keys).orderBy("ts")
    after = {f"_{c}2": F.lead(c).over(w) for c in ("ts", *values)}
    rows = transits.select(*keys, "ts", *values).withColumns(after)
    rows = rows.where("_ts2 is null or _ts2 > ts").withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("ts") / 600), F.floor(F.coalesce("_ts2", "ts") / 600))))
    met = rows.join(instants.select("day", "q", F.floor(F.col("q") / 600).alias("_bucket")), ["day", "_bucket"])
    met = met.where((F.col("q") >= F.col("ts")) & F.coalesce(F.col("q") < F.col("_ts2"), F.col("q") == F.col("ts")))
    share = (F.col("q") - F.col("ts")) / (F.col("_ts2") - F.col("ts"))
    return met.select("day", "q", *ids, *[F.coalesce(F.col(c) + (F.col(f"_{c}2") - F.col(c)) * share, F.when(F.col("q") == F.col("ts"), F.col(c))).alias(c) for c in values])


def overlaps(spans: DataFrame, by: str) -> DataFrame:
    """Pairs of spans (id, by, a, b) that overlap in time and share ``by``; both orders.

    Spans are cut into hour buckets, so that ``by`` alone never has to hold a join key's rows;
    a pair is reported in the bucket where the later of the two begins.
    """
    hours = spans.withColumn("hour", F.explode(F.sequence(F.floor(F.col("a") / 3600), F.floor(F.col("b") / 3600))))
    x, y = hours.alias("x"), hours.alias("y")
    on = (F.col(f"x.{by}") == F.col(f"y.{by}")) & (F.col("x.hour") == F.col("y.hour")) & (F.col("x.id") != F.col("y.id"))
    pairs = x.join(y, on & (F.col("x.a") < F.col("y.b")) & (F.col("x.b") > F.col("y.a")))
    return pairs.where(F.col("x.hour") == F.floor(F.greatest("x.a", "y.a") / 3600)).select(F.col(f"x.{by}").alias(by), F.col("x.id").alias("id"), F.col("y.id").alias("other"))


def followers(points: DataFrame, ids: list[str]) -> DataFrame:
    """For each point (day, id, ts, along): how far the nearest transits ahead and behind are at that instant, and which.

    Of two at one distance the smaller id counts. Neighbours' positions are interpolated between their points; brackets are dealt by day and minute.
    """
    w = Window.partitionBy("day", *ids).orderBy("ts")
    me = F.struct(*ids)
    rows = points.select("day", me.alias("id"), "ts", "along", F.lead("ts").over(w).alias("ts2"), F.lead("along").over(w).alias("along2"))
    brackets = rows.where("ts2 > ts").withColumn("minute", F.explode(F.sequence(F.floor(F.col("ts") / 60), F.floor(F.col("ts2") / 60))))
    own = rows.withColumn("minute", F.floor(F.col("ts") / 60)).alias("o")
    b = brackets.alias("b")
    on = (F.col("o.day") == F.col("b.day")) & (F.col("o.minute") == F.col("b.minute")) & (F.col("o.id") != F.col("b.id"))
    # A bracket holds its start and, for the last one of a track, no end: an instant is in one bracket only.
    met = own.join(b, on & (F.col("o.ts") >= F.col("b.ts")) & (F.col("o.ts") < F.col("b.ts2")))
    there = F.col("b.along") + (F.col("b.along2") - F.col("b.along")) * (F.col("o.ts") - F.col("b.ts")) / (F.col("b.ts2") - F.col("b.ts"))
    met = met.select(F.col("o.day").alias("day"), F.col("o.id").alias("id"), F.col("o.ts").alias("ts"), F.col("b.id").alias("other"), (there - F.col("o.along")).alias("diff"))
    ahead, behind = F.when(F.col("diff") > 0, F.col("diff")), F.when(F.col("diff") < 0, -F.col("diff"))
    keys = ["day", "id", "ts"]
    # Least distances first, by hash aggregation over doubles; ids only of the few rows at that distance.
    least = met.groupBy(*keys).agg(F.min(ahead).alias("ahead_nm"), F.min(behind).alias("behind_nm"), F.count("*").alias("n_near"))
    near = met.join(least, keys).where((F.col("diff") == F.col("ahead_nm")) | (-F.col("diff") == F.col("behind_nm")))
    other = lambda at: F.min(F.when(at, F.col("other")))
    who = near.groupBy(*keys).agg(other(F.col("diff") == F.col("ahead_nm")).alias("ahead"), other(-F.col("diff") == F.col("behind_nm")).alias("behind"))
    return least.join(who, keys, "left").select(*keys, "ahead_nm", "behind_nm", "ahead", "behind", "n_near")


def visits(points: DataFrame, cfg: Config = DEFAULT, least: int = 2) -> DataFrame:
    """Visits of the anchor for each (day, hex): low or on the ground, inside the box and the radius.

    The lowest altitude covers all low points of the box; everything else only
    those inside the radius. Unknown altitudes fall back on the geometric one.
    """
    box = F.col("lat").between(cfg.anchor_lat - cfg.box_lat, cfg.anchor_lat + cfg.box_lat) & F.col("lon").between(cfg.anchor_lon - cfg.box_lon, cfg.anchor_lon + cfg.box_lon)
    ground = F.coalesce(F.col("alt_ft") == -1, F.lit(False))
    alt = F.coalesce("alt_ft", "geom_alt") if "geom_alt" in points.columns else F.col("alt_ft")
    low = points.where(box).withColumn("_g", ground).withColumn("_a", F.when(ground, -1).otherwise(alt)).where(F.col("_g") | (F.col("_a") <= cfg.visit_ceiling_ft))
    d = flat_nm(F.col("lat") - cfg.anchor_lat, F.col("lon") - cfg.anchor_lon, cfg)
    hit = lambda c: F.when(F.col("_d") <= cfg.visit_radius_nm, c)
    rows = low.withColumn("_d", d).groupBy("day", "hex").agg(
        F.min(hit(F.col("ts"))).alias("first_ts"), F.max(hit(F.col("ts"))).alias("last_ts"),
        F.round(F.min(hit(F.col("_d"))), 2).alias("min_dist_nm"), F.min("_a").cast("int").alias("min_alt_ft"),
        F.max(hit(F.col("_g"))).alias("saw_ground"), F.count(hit(F.lit(1))).alias("n_hits"),
    )
    return rows.where(F.col("n_hits") >= least)
