"""Archives, packed files and documents by key, written and read back."""

import gzip
import io
import json
import struct
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.operators import segments, tracks
from wakeline.sources import sinks, traces
from wakeline.sources.documents import KeyedDocuments, write_documents
from wakeline.sources.packed import PackedRecords, _Reader

TRACK = "hex string, seg long, ts double, lon double, lat double"


@pytest.fixture
def tracks_of(spark):
    rng = np.random.default_rng(7)
    rows = []
    for h in ("a835af", "~2c9", "ünï", "000001"):
        for seg in range(5):
            n = int(rng.integers(1, 60))
            start = float(rng.integers(0, 400_000))
            rows += [(h, seg, start + 7.0 * i, float(rng.uniform(-180, 180)), float(rng.uniform(-90, 90))) for i in range(n)]
    rows += [(None, 0, 5.0, 1.0, 2.0), (None, 0, 6.0, 1.0, 2.0)]
    return rows, spark.createDataFrame(rows, TRACK).repartition(5)


def expected(rows, t0, least=2):
    by = {}
    for h, s, ts, lon, lat in rows:
        by.setdefault((h, s), []).append((ts, lon, lat))
    order = sorted((min(p)[0], h, s) for (h, s), p in by.items() if h is not None and len(p) >= least)
    data, offsets, at = b"", {}, 0
    for _, h, s in order:
        own = sorted(by[h, s])
        data += b"".join(struct.pack("<4f", ts - t0, lon, lat, 0.0) for ts, lon, lat in own)
        offsets[h, s] = (at, len(own))
        at += len(own)
    return data, offsets


def test_packed_file_round_trip(spark, tracks_of, tmp_path):
    rows, df = tracks_of
    df = df.where("hex is not null")
    sinks.write_packed(df, str(tmp_path), 3.0)
    data, offsets = expected(rows, 3.0)
    assert (tmp_path / "points.bin").read_bytes() == data
    assert not list(tmp_path.glob("*.tmp"))
    assert {(r.hex, r.seg): (r.start, r.n) for r in spark.read.parquet(str(tmp_path / "offsets")).collect()} == offsets
    back = sinks.read_packed(spark, str(tmp_path), points=64)
    got = {}
    for r in back.collect():
        got.setdefault((r.hex, r.seg), []).append((r.i, r.t, r.lon, r.lat, r.alt))
    assert {k: len(v) for k, v in got.items()} == {k: n for k, (_, n) in offsets.items()}
    for key, (start, n) in offsets.items():
        quads = list(struct.iter_unpack("<4f", data[16 * start : 16 * (start + n)]))
        assert sorted(got[key]) == [(i, *q) for i, q in enumerate(quads)]


def test_packed_partitions_are_ranges(spark, tracks_of, tmp_path):
    _, df = tracks_of
    sinks.write_packed(df.where("hex is not null"), str(tmp_path), 0.0)
    options = {"path": str(tmp_path / "points.bin"), "index": str(tmp_path / "points.idx"), "points": "64"}
    reader = _Reader(options)
    parts = reader.partitions()
    total = (tmp_path / "points.bin").stat().st_size // 16
    read = [sum(b.num_rows for b in reader.read(p)) for p in parts]
    assert len(parts) > 3 and sum(read) == total and max(read) < 64 + 60
    assert [p.first for p in parts[1:]] == [p.last for p in parts[:-1]]
    (tmp_path / "points.bin").write_bytes((tmp_path / "points.bin").read_bytes()[:-16])
    with pytest.raises(EOFError):
        list(reader.read(parts[-1]))


def test_packed_writer_checks_positions(spark, tmp_path):
    spark.dataSource.register(PackedRecords)
    out = str(tmp_path / "x.bin")
    for bad in ([(0, 1.0), (2, 1.0)], [(0, 1.0), (0, 2.0), (1, 2.0)]):
        with pytest.raises(Exception, match="positions"):
            spark.createDataFrame(bad, "pos long, v float").write.format("packed_records").mode("overwrite").save(out)
        assert list(tmp_path.iterdir()) == []
    spark.range(100_000).selectExpr("99999 - id as pos", "double(id) as v").repartition(7).write.format("packed_records").mode("append").save(out)
    assert np.fromfile(out, "<f8").tolist() == list(range(99_999, -1, -1))
    with pytest.raises(Exception, match="x.bin"):
        spark.range(1).selectExpr("id as pos", "double(id) as v").write.format("packed_records").mode("append").save(out)
    spark.range(0).selectExpr("id as pos", "double(id) as v").write.format("packed_records").mode("overwrite").save(out)
    assert (tmp_path / "x.bin").read_bytes() == b""


def archive(folder, members, cut):
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    raw = data.getvalue()
    folder.mkdir()
    for i, at in enumerate(range(0, len(raw), cut)):
        (folder / f"d.tar.a{chr(97 + i)}").write_bytes(raw[at : at + cut])


def document(t0, n, lat=44.0):
    return json.dumps({"timestamp": t0, "trace": [[i * 20, round(lat + i * 1e-3, 4), -88.5, 1500, 90, (i * 7) % 360, 0] for i in range(n)]}, separators=(",", ":")).encode()


@pytest.fixture
def two_days(tmp_path):
    tmp_path = tmp_path / "archive"
    tmp_path.mkdir()
    for day, t0 in (("2026.07.14", 1000.0), ("2026.07.15", 90_000.0)):
        members = [(f"x/trace_full_{h}.json", gzip.compress(document(t0, 40, lat))) for h, lat in (("a835af", 44.0), ("bb", 10.0), ("~c1", 44.2))]
        archive(tmp_path / day, [*members, ("x/other.json", b"{}" * 900)], 1_500)
    return str(tmp_path)


def test_filters_reach_the_archive(spark, two_days):
    spark.dataSource.register(traces.TraceArchive)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        docs = traces.read_archive(spark, two_days)
        one = docs.where((F.col("day") == "2026.07.15") & F.col("hex").isin("bb", "~c1") & (F.length("doc") > 10))
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "length" in plan.split("BatchScan")[0] and "2026.07.15" not in plan.split("BatchScan")[0]
        assert sorted((r.day, r.hex) for r in one.collect()) == [("2026.07.15", "bb"), ("2026.07.15", "~c1")]
        assert one.rdd.getNumPartitions() == 1
        assert docs.where(F.col("doc").contains(",10.0")).select("hex").distinct().collect() == [("bb",)]
        assert docs.where("day = '2026.07.15' and day = '2026.07.14'").count() == 0
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_members_are_passed_over(two_days):
    reader = traces._Reader({"path": two_days, "hexes": "bb"})
    got = [row[:2] for p in reader.partitions() for row in reader.read(p)]
    assert got == [("2026.07.14", "bb"), ("2026.07.15", "bb")] and reader.unread == 6
    reader = traces._Reader({"path": two_days, "tokens": json.dumps(traces.near_tokens([44], [-88]))})
    got = [row[1] for p in reader.partitions() for row in reader.read(p)]
    assert got == ["a835af", "~c1"] * 2 and reader.undecoded == 2 and reader.unread == 2


def test_archive_to_packed_file(spark, two_days, tmp_path):
    """Text ids all the way: archive, segments, downsampling, packed file."""
    points = traces.read_points(spark, two_days, hexes=["a835af", "~c1"], tokens=traces.near_tokens([44], [-88]))
    cut = segments.with_segments(points)
    kept = tracks.downsample(cut, 12)
    assert dict(kept.dtypes)["hex"] == "string"
    out = tmp_path / "out"
    out.mkdir()
    sinks.write_packed(cut.join(kept, ["hex", "seg", "ts"]), str(out), 1000.0)
    back = sinks.read_packed(spark, str(out)).groupBy("hex", "seg").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).collect()
    assert sorted((r.hex, r.seg, r.n, r.a, r.b) for r in back) == [(h, s, 12, s * 89_000.0, s * 89_000.0 + 780) for h in ("a835af", "~c1") for s in (0, 1)]


def test_downsample_over_batches(spark):
    """A segment over many batches, null and text ids: as numbers give it."""
    rows = [(h, i // 3000, float(i * 10), 44.0, -88.5, float((i * 5) % 360) if i % 4 else None) for h in (0, 1, 2) for i in range(6000)]
    name = {0: None, 1: "a835af", 2: "ff"}
    schema = "seg long, ts double, lat double, lon double, track double"
    by_number = spark.createDataFrame(rows, "hex long, " + schema)
    by_text = spark.createDataFrame([(name[r[0]], *r[1:]) for r in rows], "hex string, " + schema)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        one = sorted((name[r.hex] or "", r.seg, r.ts) for r in tracks.downsample(by_number, 500).collect())
        two = sorted((r.hex or "", r.seg, r.ts) for r in tracks.downsample(by_text, 500).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert one == two and len(one) == 3000


def test_documents_by_key(spark, tmp_path):
    head = lambda k: json.dumps({"ident": k}, separators=(",", ":"))
    rows = [(k, p, head(k), json.dumps([{"n": 10 * p + i} for i in range(p)])) for k in ("KOSH", "A-1", "b_2") for p in range(5)]
    rows += [("../x", 0, "{}", "[]"), (None, 0, "{}", "[]"), ("E", 0, "{}", None), ("a b", 0, "{}", "[1]")]
    df = spark.createDataFrame(rows, "key string, part long, head string, items string").repartition(6)
    (tmp_path / "OLD.json").write_text("{}")
    write_documents(df, str(tmp_path), "touches", 3)
    got = {p.name: json.loads(p.read_text()) for p in tmp_path.iterdir()}
    touches = [{"n": 10 * p + i} for p in range(5) for i in range(p)]
    assert got == {**{f"{k}.json": {"ident": k, "touches": touches} for k in ("KOSH", "A-1", "b_2")}, "E.json": {"touches": []}}


def test_failed_documents_leave_nothing(spark, tmp_path):
    spark.dataSource.register(KeyedDocuments)
    fail = F.when(F.col("id") == 90, F.raise_error(F.lit("broken"))).otherwise(F.lit("[]"))
    df = spark.range(100).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(0).cast("long").alias("part"), F.lit("{}").alias("head"), fail.cast("string").alias("items"))
    with pytest.raises(Exception, match="broken"):
        write_documents(df, str(tmp_path), "x")
    assert list(tmp_path.iterdir()) == []
