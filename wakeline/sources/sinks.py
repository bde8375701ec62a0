"""Sinks: day-partitioned tables and packed points; documents by key are in ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.reports import numbered
from wakeline.sources.packed import PackedRecords


def write_traces(points: DataFrame, path: str) -> None:
    """Parquet by day, sorted by entity and time inside each file."""
    points.repartition("day", "hex").sortWithinPartitions("day", "hex", "ts").write.partitionBy("day").option("compression", "zstd").parquet(path, mode="overwrite")


def segment_offsets(points: DataFrame, least: int = 2) -> DataFrame:
    """(hex, seg, segment, start, n) of the segments with ``least`` points or more: their number and the points before them.

    Segments are ordered by their first instant, then by hex and seg. Counts are summed by day first, so no
    order over all segments is needed.
    """
    sizes = points.groupBy("hex", "seg").agg(F.count("*").alias("n"), F.min("ts").alias("t_start")).where(F.col("n") >= least)
    return numbered(sizes, "t_start", ["hex", "seg"], size="n").select("hex", "seg", F.col("id").alias("segment"), "start", "n")


def packed_rows(points: DataFrame, offsets: DataFrame, t0: float) -> DataFrame:
    """(pos, t, lon, lat, alt): each point's place in the file, and float32 quads [ts - t0, lon, lat, 0].

    Points are numbered within days of their segment, so a long segment is no single window.
    """
    rows = numbered(points.select("hex", "seg", "ts", "lon", "lat"), "ts", ["lon", "lat"], within=["hex", "seg"])
    rows = rows.join(offsets, ["hex", "seg"])
    single = lambda c: c.cast("float")
    return rows.select((F.col("start") + F.col("id")).alias("pos"), single(F.col("ts") - t0).alias("t"), single(F.col("lon")).alias("lon"), single(F.col("lat")).alias("lat"), F.lit(0.0).cast("float").alias("alt"))


def write_packed(points: DataFrame, path: str, t0: float, least: int = 2) -> None:
    """``points.bin`` of all segments of (hex, seg, ts, lon, lat), one after another, ``points.idx`` with each one's offset, and the table ``offsets``.

    Ids keep their types. The folder exists. The offsets are written first and read back, so both files hold the same segments.
    """
    spark = points.sparkSession
    spark.dataSource.register(PackedRecords)
    segment_offsets(points, least).write.mode("overwrite").parquet(f"{path}/offsets")
    offsets = spark.read.parquet(f"{path}/offsets")
    put = lambda rows, name: rows.sortWithinPartitions("pos").write.format("packed_records").mode("overwrite").save(f"{path}/{name}")
    put(packed_rows(points, offsets, t0).repartitionByRange("pos"), "points.bin")
    put(offsets.select(F.col("segment").alias("pos"), "start", "n").repartitionByRange("pos"), "points.idx")


def read_packed(spark: SparkSession, path: str, points: int | None = None) -> DataFrame:
    """(hex, seg, i, t, lon, lat, alt) of ``write_packed``'s folder; ``points``: how many make a partition, about."""
    spark.dataSource.register(PackedRecords)
    reader = spark.read.format("packed_records").option("index", f"{path}/points.idx")
    rows = (reader.option("points", points) if points else reader).load(f"{path}/points.bin")
    return rows.join(spark.read.parquet(f"{path}/offsets").select("hex", "seg", "segment"), "segment").drop("segment")
