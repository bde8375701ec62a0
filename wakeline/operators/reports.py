"""Small reports over legs and transits: manifest, numbering, clocks, daily counts, type statistics."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config
from wakeline.functions.labels import local_date

#: Order of the regions in reports. Fixed values.
REGIONS = ("Local", "Northeast", "Southeast", "Southwest", "Northwest", "Unknown")
#: Seconds of a bucket that is numbered by itself.
BUCKET = 86_400


def manifest(legs: DataFrame) -> DataFrame:
    """One row: the window of all legs in whole seconds, entities, legs and path."""
    return legs.agg(
        F.min("t_start").cast("long").alias("t0"), F.max("t_end").cast("long").alias("t1"),
        F.count_distinct("hex").alias("n_hex"), F.count("*").alias("n_legs"), F.sum("path_nm").alias("nm"),
    )


def numbered(rows: DataFrame, by: str, ties: Sequence[str], within: Sequence[str] = (), size: str | None = None) -> DataFrame:
    """``rows`` with ``id``, their number from 0 by ``by`` (seconds) and then ``ties``, each group ``within`` by itself.

    With ``size``, ``start`` is the sum of the sizes before the row. Rows are numbered within a day; only one count for each day is ordered
    as a whole. Rows whose ``by`` is null come first; null groups are groups.
    """
    rows = rows.withColumn("_bucket", F.coalesce(F.floor(F.col(by) / BUCKET), F.lit(-(2**62))))
    amount = F.sum(size) if size else F.lit(None).cast("long")
    days = rows.groupBy(*within, "_bucket").agg(F.count("*").alias("_n"), amount.alias("_size"))
    earlier = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    keys = [*within, "_bucket"]
    offsets = days.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], before("_n").alias("_before"), before("_size").alias("_start"))
    on = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    own = Window.partitionBy(*keys).orderBy(by, *ties)
    rows = rows.withColumn("_own", F.row_number().over(own) - 1)
    if size:
        rows = rows.withColumn("_sum", F.coalesce(F.sum(size).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(offsets, on).withColumn("id", F.col("_before") + F.col("_own"))
    rows = rows.withColumn("start", F.col("_start") + F.col("_sum")) if size else rows
    return rows.drop("_bucket", "_before", "_start", "_own", "_sum", *[f"_k{i}" for i in range(len(keys))])


def window_start(spark: SparkSession, path: str) -> DataFrame | None:
    """The one row (window_start) of a manifest's JSON, None where there is no such file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.option("multiLine", True).schema("window_start long").json(path).agg(F.max("window_start").alias("window_start"))


def on_shared_clock(legs: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """``legs`` with start_s and end_s, whole seconds since the manifest's window_start, else since the first start of all."""
    zero = legs.agg(F.min("t_start").cast("long").alias("_zero"))  # one row
    if manifest is not None:
        zero = zero.select(F.coalesce(manifest.select("window_start").scalar(), "_zero").alias("_zero"))
    since = lambda c: (F.col(c) - F.col("_zero")).cast("long")
    return legs.join(F.broadcast(zero)).withColumns({"start_s": since("t_start"), "end_s": since("t_end")}).drop("_zero")


def day_list(rows: DataFrame, at: str) -> DataFrame:
    """Every day from the first to the last of ``at``, those without rows too."""
    ends = rows.agg(F.min(F.to_date(at)).alias("a"), F.max(F.to_date(at)).alias("b")).where("a is not null")
    return ends.select(F.explode(F.sequence("a", "b")).alias("day")).select(F.col("day").cast("string").alias("day"))


def daily_in_out(journeys: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(day, inbound, outbound): journeys by the local day of their arrival or, outbound, their departure; days that have either."""
    into = F.col("direction") == "inbound"
    day = local_date(F.when(into, F.col("t_end")).otherwise(F.col("t_start")), cfg).cast("string")
    return journeys.groupBy(day.alias("day")).agg(F.count_if(into).alias("inbound"), F.count_if(~into).alias("outbound")).orderBy("day")


def region_counts(journeys: DataFrame) -> DataFrame:
    """(place, region, inbound, outbound) of journeys (direction, region), all regions in their fixed order, 0 where there are none."""
    into = F.col("direction") == "inbound"
    counts = journeys.groupBy("region").agg(F.count_if(into).alias("i"), F.count_if(~into).alias("o"))
    order = F.explode(F.transform(F.array(*map(F.lit, REGIONS)), lambda r, i: F.struct(i.alias("place"), r.alias("region"))))
    every = journeys.sparkSession.range(1).select(order.alias("r")).select("r.place", "r.region")
    got = every.join(F.broadcast(counts), "region", "left")  # a row for each region
    return got.select("place", "region", F.coalesce("i", F.lit(0)).alias("inbound"), F.coalesce("o", F.lit(0)).alias("outbound")).orderBy("place")


def busiest_far_ends(journeys: DataFrame, airports: DataFrame, end: str, home: str, most: int = 12) -> DataFrame:
    """(ident, name, city, iso_region, n): the ``most`` ends (``origin`` or ``destination``) with the most journeys, without unknown ones and home."""
    counts = journeys.where(F.col(end).isNotNull() & (F.col(end) != home)).groupBy(F.col(end).alias("ident")).agg(F.count("*").alias("n"))
    named = counts.join(airports.select("ident", "name", "city", "iso_region"), "ident", "left")
    return named.select("ident", "name", "city", "iso_region", "n").orderBy(F.desc("n"), "ident").limit(most)


def statistics_document(journeys: DataFrame, airports: DataFrame, aircraft: DataFrame, home: str, most: int = 12) -> DataFrame:
    """One row (doc): totals, daily and regional counts, the busiest far ends and types as JSON.

    journeys: (hex, direction, origin, destination, t_start, t_end, region); aircraft: (hex, type, desc).
    """
    into = journeys.where("direction = 'inbound'")
    out = journeys.where("direction = 'outbound'")
    totals = journeys.agg(F.count_distinct("hex").alias("aircraft"), F.count_if(F.col("direction") == "inbound").alias("inbound"), F.count_if(F.col("direction") == "outbound").alias("outbound"))
    label = F.coalesce("desc", "type")
    flown = aircraft.join(journeys.select("hex"), "hex", "left_semi").where(label.isNotNull())
    types = flown.groupBy(label.alias("label")).agg(F.count_distinct("hex").alias("n")).orderBy(F.desc("n"), "label").limit(most)
    rows = lambda df, by, *names: df.agg(F.transform(F.sort_array(F.collect_list(F.struct(*by, F.struct(*names).alias("_x")))), lambda r: r["_x"]).alias("x"))
    fewest, ends = [(-F.col("n")).alias("_k")], ["ident", "name", "city", "iso_region", "n"]
    parts = {
        "daily": rows(daily_in_out(journeys), [F.col("day").alias("_k")], "day", "inbound", "outbound"),
        "regions": rows(region_counts(journeys), [F.col("place").alias("_k")], "region", "inbound", "outbound"),
        "top_origins": rows(busiest_far_ends(into, airports, "origin", home, most), fewest, *ends),
        "top_dests": rows(busiest_far_ends(out, airports, "destination", home, most), fewest, *ends),
        "top_types": rows(types, fewest, "label", "n"),
    }
    doc = totals.select(F.struct("*").alias("totals"))
    for name, part in parts.items():  # one row each
        doc = doc.join(F.broadcast(part.withColumnRenamed("x", name)))
    return doc.select(F.to_json(F.struct("totals", *parts), {"ignoreNullFields": "false"}).alias("doc"))


def guided_tour(journeys: DataFrame, most_nm: float = 6_000.0) -> DataFrame:
    """(hex, rank, nm): stops of the tour, each once under its first category: 1 the four longest flights, 2 three military ones, 3 four from abroad, 4 three of a type of their own.

    journeys: (hex, nm, first, military, reg, label), one for each entity, its longest; ``first`` and then hex are the order of ties and of the other categories.
    """
    order = [F.col("first"), F.col("hex")]
    pick = lambda rank, rows, k, *by: rows.orderBy(*by, *order).limit(k).select(F.lit(rank).alias("rank"), "hex", "nm")
    alone = journeys.groupBy("label").agg(F.count("*").alias("_n")).where("_n = 1 and label <> ''").select("label")
    chosen = pick(1, journeys.where(F.col("nm") < most_nm), 4, F.desc("nm"))
    chosen = chosen.union(pick(2, journeys.where("military"), 3)).union(pick(3, journeys.where("reg <> '' and not reg rlike '^[Nn]'"), 4))
    chosen = chosen.union(pick(4, journeys.join(alone, "label", "left_semi"), 3))
    return chosen.groupBy("hex").agg(F.min("rank").alias("rank"), F.min("nm").alias("nm"))


def type_statistics(ways: DataFrame, codes: Sequence[str]) -> DataFrame:
    """For each type: count, mean, least and largest speed at each of the waypoints (type, code, gs)."""
    made = []
    for code in codes:
        here = F.when(F.col("code") == code, F.col("gs"))
        made.append(F.count_if(F.col("code") == code).alias(f"{code.lower()}_n"))
        made += [F.round(f(here), 1).alias(f"{code.lower()}_{name}") for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    return ways.groupBy("type").agg(*made)


def bounding_boxes(points: DataFrame) -> DataFrame:
    return points.groupBy("hex").agg(
        F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"), (F.max("ts") - F.min("ts")).alias("s")
    )
