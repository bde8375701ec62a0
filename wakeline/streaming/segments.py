"""Segments of a live stream as the batch operator gives them: gaps, teleports and new-leg flags, points out of order.

An entity's points wait in its state until the watermark has passed them, then they are
taken in order of time: near-repeated instants go, and a cut raises the segment's number. What is waiting
is bounded by the allowed lateness; points later than that are dropped by the watermark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from wakeline.config import DEFAULT, Config

_POINT = "ts double, lat double, lon double, flags int"
_OUT = "hex string, ts double, lat double, lon double, flags int, seg long"


class SegmentProcessor(StatefulProcessor):
    """Numbers the segments of one entity's points; timers fire when the watermark reaches a waiting point."""

    def __init__(self, cfg: Config = DEFAULT) -> None:
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _POINT)
        #: The last raw instant, the last kept point and the segment's number.
        self.last = handle.getValueState("last", "raw double, ts double, lat double, lon double, seg long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(float(r.ts), r.lat, r.lon, int(r.flags)) for part in rows for r in part[["ts", "lat", "lon", "flags"]].itertuples(index=False)]
        yield from self._advance(key, new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, new: list[tuple], watermark_ms: int) -> Iterator[pd.DataFrame]:
        waiting = sorted([*(tuple(p) for p in self.waiting.get()), *new], key=lambda p: p[0])
        due = [p for p in waiting if p[0] * 1000 <= watermark_ms]
        rest = waiting[len(due) :]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(math.ceil(rest[0][0] * 1000))
        else:
            self.waiting.clear()
        if due:
            yield pd.DataFrame(self._numbered(key[0], due), columns=["hex", "ts", "lat", "lon", "flags", "seg"])

    def _numbered(self, hex_: str, due: list[tuple]) -> list[tuple]:
        cfg, out = self.cfg, []
        held = self.last.get() if self.last.exists() else None
        raw, ts, lat, lon, seg = tuple(held) if held else (None, None, None, None, 0)
        for p in due:
            repeated = raw is not None and p[0] - raw <= cfg.same_instant_s
            raw = p[0]
            if repeated:
                continue
            if ts is not None:
                dt, y, x = p[0] - ts, (p[1] - lat) * 60.0, (p[2] - lon) * 60.0 * cfg.cos_anchor
                dnm = math.sqrt(y * y + x * x)
                speed = dnm * 3600 / dt if dt > 0 else 0.0
                seg += dt > cfg.gap_s or (speed > cfg.teleport_kt and dnm > cfg.teleport_nm) or bool(p[3] & 2)
            else:
                seg += bool(p[3] & 2)
            ts, lat, lon = p[:3]
            out.append((hex_, *p, int(seg)))
        self.last.update((raw, ts, lat, lon, int(seg)))
        return out

    def close(self) -> None:
        pass


def stream_tracks(points: DataFrame, late: str = "10 minutes", cfg: Config = DEFAULT) -> DataFrame:
    """(hex, ts, lat, lon, flags, seg) of a stream (hex, ts, lat, lon, flags), ts in epoch seconds; append mode.

    Needs Spark's RocksDB state store. Points without an id, an instant or a place are left out; a null flag is none. A
    point comes out once the watermark, the latest instant seen less ``late``, has reached it.
    """
    kept = points.where("hex is not null and ts is not null and lat is not null and lon is not null")
    rows = kept.select(F.col("hex").cast("string").alias("hex"), "ts", "lat", "lon", F.coalesce("flags", F.lit(0)).alias("flags"), F.timestamp_seconds("ts").alias("time")).withWatermark("time", late)
    return rows.groupBy("hex").transformWithStateInPandas(SegmentProcessor(cfg), StructType.fromDDL(_OUT), outputMode="Append", timeMode="EventTime")
