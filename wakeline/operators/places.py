"""Airports: dimension, nearest place by grid join, anchor override, traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config
from wakeline.functions.geo import great_circle_nm
from wakeline.operators.reports import numbered

#: Degrees of latitude of a grid band; a snap radius of 3 nm is just under it.
BAND = 0.05


def airport_dimension(raw: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ident, name, lat, lon, elev) of snap-able airports; rows with bad coordinates are skipped."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = raw.where(F.col("type").isin(*cfg.airport_types))
    rows = rows.select(
        F.coalesce(filled("icao_code"), filled("gps_code"), F.col("ident")).alias("ident"), "name",
        F.col("latitude_deg").try_cast("double").alias("lat"), F.col("longitude_deg").try_cast("double").alias("lon"),
        F.coalesce(F.col("elevation_ft").try_cast("double"), F.lit(0.0)).alias("elev"),
    )
    return rows.where("lat is not null and lon is not null")


def _cells_in_band(band):
    """Number of cells around the band, so that a cell is never narrower than BAND at its widest latitude."""
    edge = F.least(F.lit(89.9), F.greatest(F.abs((band - 1) * BAND), F.abs((band + 2) * BAND)))
    return F.greatest(F.floor(F.lit(360.0) / (F.lit(BAND) / F.cos(F.radians(edge)))), F.lit(1))


def _around(airports: DataFrame) -> DataFrame:
    """(band, cell, places): the airports that may be near a probe of each cell, as structs of ident, elev, lat and lon."""
    place = F.struct("ident", "elev", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    band = F.floor(F.col("lat") / BAND)
    rows = airports.withColumn("place", place).withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
    nearby = F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: F.pmod(_cell(F.col("band")) + i, _cells_in_band(F.col("band"))))
    rows = rows.withColumn("cell", F.explode(F.array_distinct(nearby)))
    return rows.groupBy("band", "cell").agg(F.collect_list("place").alias("places"))


def _cell(band):
    return F.floor((F.col("lon") + 180.0) / 360.0 * _cells_in_band(band))


def nearest_airport(probes: DataFrame, airports: DataFrame, cfg: Config = DEFAULT, few: int = 100_000) -> DataFrame:
    """(id, ident, dist_nm): the nearest airport within the snap radius of each probe (id, lat, lon, alt_ft).

    The altitude guard comes after the choice, with no second choice; a
    probe near the anchor and low is the anchor's. Probes without an answer have a
    null ident. Each cell carries the airports around it, so a probe meets one row and
    chooses within it. Up to ``few`` airports are broadcast and probes are not shuffled; more are joined by cell.
    """
    around = _around(airports)
    if airports.limit(few + 1).count() <= few:
        around = F.broadcast(around)
    band = F.floor(F.col("lat") / BAND)
    probes = probes.select("id", "lat", "lon", "alt_ft").withColumns({"band": band, "cell": F.pmod(_cell(band), _cells_in_band(band))})
    arc = lambda a, b: great_circle_nm(F.col("lat"), F.col("lon"), a, b, cfg)
    measured = F.transform("places", lambda x: F.struct(arc(x["lat"], x["lon"]).alias("d"), x["ident"].alias("ident"), x["elev"].alias("elev")))
    best = F.array_min(F.filter(measured, lambda x: x["d"] <= cfg.snap_nm))
    out = probes.join(around, ["band", "cell"], "left").withColumn("best", best)
    high = (F.col("alt_ft") >= 0) & (F.col("alt_ft") > F.col("best.elev") + cfg.snap_agl_ft)
    home = arc(F.lit(cfg.anchor_lat), F.lit(cfg.anchor_lon)) <= cfg.visit_radius_nm
    low = F.col("alt_ft").isNull() | (F.col("alt_ft") < 0) | (F.col("alt_ft") <= cfg.visit_ceiling_ft)
    ident = F.when(home & low, cfg.anchor).when(F.coalesce(high, F.lit(False)), None).otherwise(F.col("best.ident"))
    return out.select("id", ident.alias("ident"), F.col("best.d").alias("dist_nm"))


def touches(legs: DataFrame) -> DataFrame:
    """A row for each arrival and each departure (ident, other, dir, hex, t_start, t_end); one scan of the legs."""
    sides = F.array(
        F.struct(F.col("to_apt").alias("ident"), F.col("from_apt").alias("other"), F.lit("arrival").alias("dir")),
        F.struct(F.col("from_apt").alias("ident"), F.col("to_apt").alias("other"), F.lit("departure").alias("dir")),
    )
    out = legs.withColumn("s", F.explode(sides)).where("s.ident is not null")
    return out.where(F.col("s.ident").rlike("^[A-Za-z0-9_-]+$")).select("s.ident", "s.other", "s.dir", "hex", "t_start", "t_end")


def airport_index(traffic: DataFrame) -> DataFrame:
    counts = traffic.groupBy("ident").agg(F.count_if(F.col("dir") == "arrival").alias("arrivals"), F.count_if(F.col("dir") == "departure").alias("departures"))
    return counts.orderBy(F.desc(F.col("arrivals") + F.col("departures")), "ident")


def airport_names(raw: DataFrame) -> DataFrame:
    """(ident, name, city, iso_region, lat, lon) of the airport file, a row for each ident: of several rows the first by their own ident counts."""
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    number = lambda c: F.col(c).try_cast("double")
    facts = F.struct("name", F.col("municipality").alias("city"), "iso_region", number("latitude_deg").alias("lat"), number("longitude_deg").alias("lon"))
    rows = raw.select(F.coalesce(filled("icao_code"), filled("gps_code"), F.col("ident")).alias("ident"), F.col("ident").alias("own"), facts.alias("facts"))
    return rows.groupBy("ident").agg(F.min_by("facts", F.struct("own", "facts")).alias("facts")).select("ident", "facts.*")


def airport_parts(traffic: DataFrame, airports: DataFrame, aircraft: DataFrame, size: int = 1_000) -> DataFrame:
    """(ident, part, known, name, city, iso_region, lat, lon, arrivals, departures, touches) of touches: an airport's touches by time, ``size`` of them a part.

    ``arrivals`` and ``departures`` are the whole airport's; ``touches`` are structs with the aircraft's reg, type and desc (hex, reg, type, desc),
    null where it isn't known, as are the airport's facts (``known`` tells). Touches are numbered within days, and an airport's counts and facts come to
    its parts by ident and part, so a hub is neither one value nor one window nor one task's.
    """
    rows = numbered(traffic, "t_start", ["t_end", "hex", "dir"], within=["ident"]).withColumn("part", F.floor(F.col("id") / size))
    rows = rows.join(aircraft.select("hex", "reg", "type", "desc"), "hex", "left")
    item = F.struct("id", F.struct("hex", "reg", "type", "desc", "dir", "other", F.col("t_start").cast("double").alias("t_start"), F.col("t_end").cast("double").alias("t_end")).alias("x"))
    rows = rows.repartition("ident", "part")  # rows of an entity are in many parts: lists before the shuffle would be of one touch each
    parts = rows.groupBy("ident", "part").agg(F.transform(F.sort_array(F.collect_list(item)), lambda i: i["x"]).alias("touches"))
    facts = airports.select("ident", "name", "city", "iso_region", "lat", "lon", F.lit(True).alias("known"))
    last = F.floor((F.col("arrivals") + F.col("departures") - 1) / size)  # ids are gapless, so every part up to it is there
    heads = airport_index(traffic).join(facts, "ident", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return parts.join(heads, ["ident", "part"]).withColumn("known", F.coalesce("known", F.lit(False)))


def airport_documents(parts: DataFrame) -> DataFrame:
    """(key, part, head, items) for ``sources.documents``: JSON without the facts of an airport that isn't known, with nulls otherwise."""
    as_json = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    counts = ["arrivals", "departures"]
    head = F.when(F.col("known"), as_json("ident", "name", "city", "iso_region", "lat", "lon", *counts)).otherwise(as_json("ident", *counts))
    return parts.select(F.col("ident").alias("key"), "part", head.alias("head"), F.to_json("touches", {"ignoreNullFields": "false"}).alias("items"))


def airport_list(traffic: DataFrame, airports: DataFrame) -> DataFrame:
    """(ident, name, city, iso_region, lat, lon, arrivals, departures), the busiest first."""
    named = airport_index(traffic).join(airports.select("ident", "name", "city", "iso_region", "lat", "lon"), "ident", "left")
    return named.select("ident", "name", "city", "iso_region", "lat", "lon", "arrivals", "departures").orderBy(F.desc(F.col("arrivals") + F.col("departures")), "ident")
