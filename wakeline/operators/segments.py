"""Segments and legs of per-entity, time-ordered points.

One shuffle by entity serves every window here: the later ones are
partitioned by the entity and a segment number, which the same distribution
satisfies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config
from wakeline.functions.geo import flat_nm, great_circle_nm


def _by_time() -> Window:
    return Window.partitionBy("hex").orderBy(F.col("ts").asc_nulls_first())


def with_deltas(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Points (hex, ts, lat, lon) with dt, dnm and speed against the point before; null at the first."""
    w = _by_time()
    out = points.withColumn("dt", F.col("ts") - F.lag("ts").over(w))
    out = out.withColumn("dnm", flat_nm(F.col("lat") - F.lag("lat").over(w), F.col("lon") - F.lag("lon").over(w), cfg))
    return out.withColumn("speed", F.when(F.col("dt") > 0, F.col("dnm") * 3600 / F.col("dt")).when(F.col("dt").isNotNull(), 0.0))


def with_segments(points: DataFrame, cfg: Config = DEFAULT, flags: bool = False) -> DataFrame:
    """Points with ``seg``, which grows at coverage gaps, teleports and (``flags``) new-leg flags."""
    out = with_deltas(points, cfg)
    cut = (F.col("dt") > cfg.gap_s) | ((F.col("speed") > cfg.teleport_kt) & (F.col("dnm") > cfg.teleport_nm))
    if flags:
        cut = cut | (F.coalesce("flags", F.lit(0)).bitwiseAND(F.lit(2)) != 0)
    running = _by_time().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("seg", F.sum(F.coalesce(cut, F.lit(False)).cast("int")).over(running))


def distinct_instants(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Points more than half a second after the raw point before them; the first stays."""
    step = F.col("ts") - F.lag("ts").over(_by_time())
    return points.withColumn("_step", step).where(F.col("_step").isNull() | (F.col("_step") > cfg.same_instant_s)).drop("_step")


def event_segments(events: DataFrame, entity: str, gap_s: float, min_points: int, min_s: float) -> DataFrame:
    """Gap-only segments of (entity, ts): count, start, end, number of the kept segment."""
    w = Window.partitionBy(entity).orderBy("ts")
    cut = (F.col("ts") - F.lag("ts").over(w)) > gap_s
    numbered = events.select(entity, "ts").withColumn("seg", F.sum(F.coalesce(cut, F.lit(False)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    legs = numbered.groupBy(entity, "seg").agg(F.count("*").alias("n_points"), F.min("ts").alias("t_start"), F.max("ts").alias("t_end"))
    return legs.where((F.col("n_points") >= min_points) & (F.col("t_end") - F.col("t_start") >= min_s))


def legs(points: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Accepted legs with their ends: enough points, long enough, not all on the ground.

    A leg whose altitudes are all unknown is kept. ``leg_idx`` counts an
    entity's accepted legs from 0.
    """
    cut = with_segments(distinct_instants(points, cfg), cfg, flags=True)
    w = Window.partitionBy("hex", "seg").orderBy("ts")
    hop = great_circle_nm(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"), cfg)
    ends = F.struct("lat", "lon", "alt_ft")
    found = cut.withColumn("hop", hop).groupBy("hex", "seg").agg(
        F.min("ts").alias("t_start"),
        F.max("ts").alias("t_end"),
        F.count("*").cast("int").alias("n_points"),
        F.min_by(ends, "ts").alias("first"),
        F.max_by(ends, "ts").alias("last"),
        F.max("alt_ft").alias("top"),
        F.round(F.coalesce(F.sum("hop"), F.lit(0.0)), 1).alias("path_nm"),
    )
    found = found.where((F.col("n_points") >= cfg.min_leg_points) & (F.col("t_end") - F.col("t_start") >= cfg.min_leg_s) & (F.col("top").isNull() | (F.col("top") > 0)))
    number = F.row_number().over(Window.partitionBy("hex").orderBy("t_start")) - 1
    return found.select(
        "hex", number.alias("leg_idx"), "t_start", "t_end",
        F.col("first.lat").alias("from_lat"), F.col("first.lon").alias("from_lon"), F.col("first.alt_ft").alias("from_alt"),
        F.col("last.lat").alias("to_lat"), F.col("last.lon").alias("to_lon"), F.col("last.alt_ft").alias("to_alt"),
        "n_points", "path_nm",
    )
