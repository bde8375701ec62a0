"""Tracks and legs made from the test tables, as DataFrames and as DuckDB SQL.

``pts``: synthetic tracks along the corridor from ``events``; ``chain``: one
leg for each row of ``orders``. Both use only sums, products, quotients and integer
remainders, which every engine computes alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(column: str) -> str:
    return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}) / 1000000.0D"


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.row_number().over(w) - 1).cast("long").alias("rn"))
    return rows.selectExpr(
        "user_id as hex",
        "double(1784160000 + user_id * 97 + rn * 20 + (rn div 60) * 1200) as ts",
        "43.7508D + ((rn % 60) / 59.0D) * 0.205D + (event_id % 11 - 5) * 0.0005D as lat",
        "-89.4822D + ((rn % 60) / 59.0D) * 0.8041D as lon",
        "case when event_id % 53 = 0 then null when event_id % 59 = 0 then -1 else 1700 + (event_id % 15) * 50 end as alt_ft",
        "double(70 + event_id % 70) as gs",
        "double((rn * 7) % 360) as track",
        "case when rn % 90 = 89 then 2 else 0 end as flags",
        "event_id",
    ).withColumn("day", F.floor(F.col("ts") / 86400).cast("long"))


PTS = """
raw as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as rn from events),
pts0 as (
  select user_id as hex, cast(1784160000 + user_id * 97 + rn * 20 + (rn // 60) * 1200 as double) as ts,
    cast(43.7508 as double) + ((rn % 60) / cast(59.0 as double)) * cast(0.205 as double) + (event_id % 11 - 5) * cast(0.0005 as double) as lat,
    cast(-89.4822 as double) + ((rn % 60) / cast(59.0 as double)) * cast(0.8041 as double) as lon,
    case when event_id % 53 = 0 then null when event_id % 59 = 0 then -1 else 1700 + (event_id % 15) * 50 end as alt_ft,
    cast(70 + event_id % 70 as double) as gs, cast((rn * 7) % 360 as double) as track,
    case when rn % 90 = 89 then 2 else 0 end as flags, event_id
  from raw),
pts as (select *, cast(floor(ts / 86400) as bigint) as day from pts0)"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("hex").orderBy("o_orderdate", "o_orderkey")
    place = lambda e: f"element_at(array('A', 'B', 'C', 'D', null), int({e}) + 1)"
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as hex", "o_orderdate", "o_orderkey", f"{epoch('o_orderdate')} as t_start",
        f"{place('o_orderkey % 5')} as from_apt", f"{place('(o_orderkey * 7 + o_custkey) % 5')} as to_apt", "(o_orderkey % 500) / 2.0D as path_nm",
    )
    rows = rows.withColumn("leg_idx", F.row_number().over(w) - 1)
    return rows.withColumn("t_end", F.col("t_start") + 3600 * (1 + F.col("o_orderkey") % 9)).drop("o_orderdate", "o_orderkey")


CHAIN = """
chain0 as (
  select o_custkey as hex, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as leg_idx,
    cast(epoch(o_orderdate) as double) as t_start, o_orderkey,
    case o_orderkey % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' end as from_apt,
    case (o_orderkey * 7 + o_custkey) % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' end as to_apt,
    (o_orderkey % 500) / cast(2.0 as double) as path_nm
  from orders),
chain as (select *, t_start + 3600 * (1 + o_orderkey % 9) as t_end from chain0)"""
