"""Labels as a page shows them: types, flags, clocks, durations, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config


def long_type(description: Column, code: Column) -> Column:
    """The description, else the type code; null if both are."""
    return F.coalesce(description, code)


def short_type(code: Column, description: Column) -> Column:
    """The type code, else the description, empty ones counting as missing, else ``Unknown``."""
    return F.coalesce(F.nullif(code, F.lit("")), F.nullif(description, F.lit("")), F.lit("Unknown"))


def military(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(1)) != 0


def new_leg(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(2)) != 0


def clock(at: Column) -> Column:
    """``Sat Jul 25, 6:59 PM``."""
    return F.date_format(at, "EEE MMM d, h:mm a")


def _half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def hours(seconds: Column) -> Column:
    """``3h 7m``; minutes are rounded by themselves, so an hour may show as ``1h 60m``."""
    whole = F.floor(seconds / 3600)
    return F.concat(whole.cast("string"), F.lit("h "), _half_up((seconds - 3600 * whole) / 60).cast("string"), F.lit("m"))


def minutes(seconds: Column) -> Column:
    """``12:05``."""
    s = _half_up(seconds)
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def file_name(name: Column) -> Column:
    """Lower case, everything but letters and digits an underscore."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "_")


def local_date(epoch: Column, cfg: Config = DEFAULT) -> Column:
    """The day of epoch seconds in the configured zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(cfg.zone), F.timestamp_seconds(epoch).cast("timestamp_ntz")))
