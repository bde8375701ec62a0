"""Geometry as column expressions; square roots of sums, which every engine rounds alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config


def flat_nm(dlat: Column, dlon: Column, cfg: Config = DEFAULT) -> Column:
    """Length of a difference in degrees on the plane scaled at the anchor."""
    y, x = dlat * F.lit(60.0), dlon * F.lit(60.0) * F.lit(cfg.cos_anchor)
    return F.sqrt(y * y + x * x)


def bearing(lat: Column, lon: Column, cfg: Config = DEFAULT) -> Column:
    """Degrees from the anchor, clockwise from north."""
    x = (lon - cfg.anchor_lon) * 60.0 * cfg.cos_anchor
    return F.pmod(F.degrees(F.atan2(x, (lat - cfg.anchor_lat) * 60.0)) + 360.0, F.lit(360.0))


def region(lat: Column, lon: Column, cfg: Config = DEFAULT) -> Column:
    far = flat_nm(lat - cfg.anchor_lat, lon - cfg.anchor_lon, cfg)
    quarter = F.floor(bearing(lat, lon, cfg) / 90)
    return (
        F.when(lat.isNull() | lon.isNull() | F.isnan(lat), "Unknown")
        .when(far <= cfg.local_nm, "Local")
        .when(quarter == 0, "Northeast").when(quarter == 1, "Southeast").when(quarter == 2, "Southwest").otherwise("Northwest")
    )


def great_circle_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column, cfg: Config = DEFAULT) -> Column:
    """Arc over the chord between two places on the sphere."""

    def xyz(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
        a, o = F.radians(lat), F.radians(lon)
        return F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)

    squares = [(p - q) * (p - q) for p, q in zip(xyz(lat1, lon1), xyz(lat2, lon2))]
    chord = F.sqrt(squares[0] + squares[1] + squares[2])
    return F.lit(2 * cfg.earth_nm) * F.asin(F.least(F.greatest(chord / 2, F.lit(0.0)), F.lit(1.0)))


def heading_change(degrees: Column) -> Column:
    return F.pmod(degrees + 180.0, F.lit(360.0)) - 180.0


def projection(lat: Column, lon: Column, cfg: Config = DEFAULT) -> Column:
    """struct(dist, i, along, cross) of the closest straight part of the corridor; the earlier part wins a tie."""
    x, y = lon * 60.0 * cfg.cos_corridor, lat * 60.0
    found = []
    for i, p in enumerate(cfg.legs_of_corridor):
        px, py = x - p["ax"], y - p["ay"]
        t = F.least(F.greatest((px * p["vx"] + py * p["vy"]) / (p["len"] * p["len"]), F.lit(0.0)), F.lit(1.0))
        dx, dy = x - (F.lit(p["ax"]) + t * p["vx"]), y - (F.lit(p["ay"]) + t * p["vy"])
        dist = F.sqrt(dx * dx + dy * dy)
        side = F.when(F.lit(p["vx"]) * py - F.lit(p["vy"]) * px >= 0, 1.0).otherwise(-1.0)
        found.append(F.struct(dist.alias("dist"), F.lit(i).alias("i"), (F.lit(p["cum"]) + t * p["len"]).alias("along"), (side * dist).alias("cross")))
    return F.array_min(F.array(*found))


#: Low-precision solar position, degrees and degrees a day since J2000. Fixed values.
MEAN_LONGITUDE = (280.46, 0.9856474)
MEAN_ANOMALY = (357.528, 0.9856003)
CENTRE = (1.915, 0.02)
OBLIQUITY = (23.439, -0.0000004)
SIDEREAL = (280.46061837, 360.98564736629)


def subsolar(epoch: Column) -> Column:
    """struct(lat, lon) of the point under the sun at an epoch second."""
    day = epoch / 86400.0 + 2440587.5 - 2451545.0
    turn = lambda pair: F.pmod(F.lit(pair[0]) + day * pair[1], F.lit(360.0))
    anomaly = F.radians(turn(MEAN_ANOMALY))
    length = F.radians(turn(MEAN_LONGITUDE) + F.sin(anomaly) * CENTRE[0] + F.sin(anomaly * 2) * CENTRE[1])
    tilt = F.radians(F.lit(OBLIQUITY[0]) + day * OBLIQUITY[1])
    lat = F.degrees(F.asin(F.sin(tilt) * F.sin(length)))
    right = F.degrees(F.atan2(F.cos(tilt) * F.sin(length), F.cos(length)))
    return F.struct(lat.alias("lat"), (F.pmod(right - turn(SIDEREAL) + 180.0, F.lit(360.0)) - 180.0).alias("lon"))


def night_ring(lat: Column, lon: Column, step: int = 3) -> Column:
    """array<struct(lon, lat)> around the night side: the terminator by longitude, then the dark pole."""
    edge, tilt = 89.9, F.radians(lat)

    def place(x: Column) -> Column:
        high = F.cos(F.radians(x - lon))
        line = F.degrees(F.atan(-high / F.tan(tilt)))
        flat = F.when(high >= 0, -edge).otherwise(edge)  # sun over the equator: the poles are the terminator
        y = F.when(F.abs(tilt) < 1e-6, flat).otherwise(F.greatest(F.least(line, F.lit(edge)), F.lit(-edge)))
        return F.struct(x.cast("double").alias("lon"), y.alias("lat"))

    pole = F.when(lat >= 0, -90.0).otherwise(90.0)
    ends = F.array(*[F.struct(F.lit(x).alias("lon"), pole.alias("lat")) for x in (180.0, -180.0)])
    return F.concat(F.transform(F.sequence(F.lit(-180), F.lit(180), F.lit(step)), place), ends)
