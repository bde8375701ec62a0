"""Raw archives and documents: split tar source, point decoding, airport files."""

from __future__ import annotations

import gzip
import io
import json
import os
import re
import tarfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains

#: Name of an entity's document in an archive. Fixed value.
DOCUMENT = re.compile(r"(?:^|/)trace_full_(?P<code>[^/]*?)(?:\.json)?$")
AIRPORT_SCHEMA = "id string, ident string, type string, name string, latitude_deg string, longitude_deg string, elevation_ft string, continent string, iso_country string, iso_region string, municipality string, scheduled_service string, gps_code string, icao_code string"


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """The airport file with all columns as text; ``places.airport_dimension`` casts what it needs."""
    return spark.read.csv(path, header=True, schema=AIRPORT_SCHEMA, enforceSchema=False)


def decode_points(docs: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """A row for each point of JSON documents (timestamp, trace); documents that don't parse give none.

    Points are mixed arrays: [offset, lat, lon, "ground" | number | null, gs, track, flags, .., .., .., geometric altitude].
    """
    got = docs.withColumn("_d", F.from_json(column, "timestamp double, trace array<array<string>>")).where("_d.trace is not null")
    rows = got.select(*keep, F.col("_d.timestamp").alias("t0"), F.explode("_d.trace").alias("p"))
    at = lambda i, kind: F.get("p", F.lit(i)).try_cast(kind)
    alt = F.when(F.get("p", F.lit(3)) == "ground", -1).otherwise(at(3, "double").cast("int"))
    return rows.select(
        *keep, (F.col("t0") + at(0, "double")).alias("ts"), at(1, "double").alias("lat"), at(2, "double").alias("lon"), alt.alias("alt_ft"),
        at(4, "float").alias("gs"), at(5, "float").alias("track"), F.coalesce(at(6, "int"), F.lit(0)).alias("flags"), at(10, "double").cast("int").alias("geom_alt"),
    )


class _Parts:
    """The parts of a split file, read on as one; one part is open at a time."""

    def __init__(self, paths: list[str]) -> None:
        self.rest = iter(paths)
        self.part, self.part_is_file = io.BytesIO(), False

    def _next(self) -> bool:
        self.part.close()
        path = next(self.rest, None)
        if path is None:
            self.part, self.part_is_file = io.BytesIO(), False
            return False
        self.part, self.part_is_file = open(path, "rb", buffering=1 << 22), True  # noqa: SIM115
        return True

    def read(self, size: int) -> bytes:
        got = []
        while size:
            piece = self.part.read(size)
            if not piece:
                if not self._next():
                    break
                continue
            got.append(piece)
            size -= len(piece)
        return b"".join(got)

    def skip(self, size: int) -> None:
        """Pass over bytes without reading them, from part to part."""
        while size:
            left = os.fstat(self.part.fileno()).st_size - self.part.tell() if self.part_is_file else 0
            if left >= size:
                self.part.seek(size, os.SEEK_CUR)
                return
            size -= left
            if not self._next():
                return


#: Bytes of a block of a tar file.
BLOCK = 512


def tar_files(parts: _Parts, wanted: Callable[[str], bool] = lambda name: True) -> Iterator[tuple[str, bytes]]:
    """(name, bytes) of each regular file that is wanted: a header block, then the bytes filled up to whole blocks; an empty block ends it.

    The bytes of other files are passed over, not read.
    """
    name = None
    while (header := parts.read(BLOCK)).strip(b"\0"):
        info = tarfile.TarInfo.frombuf(header, "utf-8", "surrogateescape")
        filled = -(-info.size // BLOCK) * BLOCK
        if info.isreg() and not wanted(name or info.name):
            parts.skip(filled)
            name = None
            continue
        data = parts.read(filled)[: info.size]
        if info.type == tarfile.GNUTYPE_LONGNAME:
            name = data.rstrip(b"\0").decode("utf-8", "surrogateescape")
        elif info.type == tarfile.XHDTYPE:
            paths = re.findall(rb"\d+ path=([^\n]*)\n", data)
            name = paths[-1].decode("utf-8", "surrogateescape") if paths else None
        else:
            if info.isreg():
                yield name or info.name, data
            name = None


def unpacked(data: bytes) -> bytes | None:
    """A document's bytes; gzip is told by its first two bytes, None if it is broken."""
    if not data.startswith(b"\x1f\x8b"):
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return None


def may_hold(doc: Column, *tokens: list[str]) -> Column:
    """Whether a raw document holds one of each list of tokens: a test on its bytes, before any parsing.

    Sound for fields that are always written with one of these prefixes.
    """
    test = F.lit(True)
    for choice in tokens:
        some = F.lit(False)
        for token in choice:
            some = some | doc.contains(token)
        test = test & some
    return test


class _Day(InputPartition):
    def __init__(self, day: str, paths: list[str]) -> None:
        super().__init__(day)
        self.day, self.paths = day, paths


class _Reader(DataSourceReader):
    """Reads documents by day. Codes narrow down what is read; words that a document must hold are looked for in its bytes."""

    def __init__(self, options: dict) -> None:
        self.root = options["path"]
        hexes = [h for h in options.get("hexes", "").split(",") if h]
        self.hexes: set[str] | None = set(hexes) if hexes else None
        self.days: set[str] | None = None
        #: A document must hold one of each list.
        self.tokens: list[list[bytes]] = [[t.encode() for t in choice] for choice in json.loads(options.get("tokens", "[]"))]
        self.unread = self.undecoded = 0

    def partitions(self) -> list[InputPartition]:
        folders = [d for d in sorted(Path(self.root).iterdir()) if d.is_dir() and (self.days is None or d.name in self.days)]
        days = [_Day(d.name, sorted(map(str, d.glob("*.tar.a?")))) for d in folders]
        if empty := [d.day for d in days if not d.paths]:
            raise FileNotFoundError(f"no archive parts for {', '.join(empty)}")
        return list(days)

    def _wanted(self, path: str) -> bool:
        found = DOCUMENT.search(path)
        wanted = bool(found) and (self.hexes is None or found["code"] in self.hexes)
        self.unread += not wanted
        return wanted

    def read(self, partition: _Day) -> Iterator[tuple]:
        for path, data in tar_files(_Parts(partition.paths), self._wanted):
            doc = unpacked(data)
            if doc is None:
                continue
            if not all(any(t in doc for t in choice) for choice in self.tokens):
                self.undecoded += 1
                continue
            yield partition.day, DOCUMENT.search(path)["code"], doc.decode("utf-8", "replace")


class _PushingReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes day and hex (= and in) as a whole, ``doc.contains(...)`` as a test of the bytes; gives back the rest."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in ("day", "hex") and values is not None:
                name = "days" if column == "day" else "hexes"
                held = getattr(self, name)
                setattr(self, name, values if held is None else held & values)
            elif isinstance(f, StringContains) and column == "doc":
                self.tokens.append([f.value.encode()])
            else:
                yield f


class TraceArchive(DataSource):
    """``format("trace_archive")``: (day, hex, doc) of split tar archives, a folder and a partition for each day.

    With the option ``pushdown`` (and ``spark.sql.python.filterPushdown.enabled``, see ``read_archive``) filters on day and hex are pushed
    into the source: other days are not opened and other entities' bytes not read. ``hexes`` (comma-joined) and ``tokens``
    (JSON lists; a document must hold one of each) do it without.
    Python reads the files, so they lie in a file system that driver and executors mount at one path.
    """

    @classmethod
    def name(cls) -> str:
        return "trace_archive"

    def schema(self) -> str:
        return "day string, hex string, doc string"

    def reader(self, schema) -> DataSourceReader:
        return (_PushingReader if self.options.get("pushdown") == "true" else _Reader)(self.options)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(day, hex, doc) with filters pushed into the source; switches the session's pushdown to Python sources on."""
    spark.dataSource.register(TraceArchive)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("trace_archive").option("pushdown", "true").load(path)


def read_points(spark: SparkSession, path: str, hexes: Sequence[str] = (), tokens: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Points (day, hex, ts, lat, ...) of an archive: entities are told by file name, documents by the words in their bytes, before any parsing."""
    spark.dataSource.register(TraceArchive)
    reader = spark.read.format("trace_archive").option("hexes", ",".join(hexes)).option("tokens", json.dumps([list(t) for t in tokens]))
    return decode_points(reader.load(path), "doc", ["day", "hex"])


def near_tokens(lats: Sequence[int], lons: Sequence[int]) -> list[list[str]]:
    """Words of which a document with a point in one of the whole degrees has one of each list: how such numbers begin."""
    return [[f",{v}." for v in lats], [f",{v}." for v in lons]]
