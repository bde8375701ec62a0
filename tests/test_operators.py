import math
"""Hand-made cases for the trajectory operators."""

import gzip
import io
import json
import tarfile
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.config import DEFAULT
from wakeline.functions import geo
from wakeline.operators import corridor, journeys, places, segments, tracks
from wakeline.sources import sinks, traces
from wakeline.streaming import sessions

POINT = "hex long, ts double, lat double, lon double, alt_ft int, gs double, track double, flags int"


def points(spark, rows):
    full = [(h, float(ts), float(lat), float(lon), alt, 100.0, 0.0, flags) for h, ts, lat, lon, alt, flags in rows]
    return spark.createDataFrame(full, POINT)


def line(n, step=10, t0=0, alt=1500, lat=44.0):
    return [(1, t0 + i * step, lat, -88.5 + i * 0.001, alt, 0) for i in range(n)]


def test_instants_compare_with_the_raw_row(spark):
    rows = [(1, t, 44.0, -88.0, 0, 0) for t in (0.0, 0.3, 0.6, 0.9, 1.9)]
    assert [r.ts for r in segments.distinct_instants(points(spark, rows)).orderBy("ts").collect()] == [0.0, 1.9]


@pytest.mark.parametrize(("step", "dlon", "cut"), [(900, 0.0, 0), (900.1, 0.0, 1), (1, 0.11, 0), (1, 0.14, 1), (0, 0.14, 0)])
def test_breaks(spark, step, dlon, cut):
    rows = [(1, 0, 44.0, -88.0, 0, 0), (1, step, 44.0, -88.0 + dlon, 0, 0)]
    assert segments.with_segments(points(spark, rows)).agg(F.max("seg")).first()[0] == cut


@pytest.mark.parametrize(("rows", "n"), [(line(14, 20), 0), (line(15, 20), 1), (line(15, 8.5), 0), (line(15, 8.6), 1), (line(20, alt=-1), 0), (line(20, alt=None), 1), (line(10) + line(10, t0=100, alt=-1), 1)])
def test_leg_acceptance(spark, rows, n):
    assert segments.legs(points(spark, rows)).count() == n


def test_new_leg_flag_and_index(spark):
    rows = line(40)
    rows[20] = (*rows[20][:5], 2)
    got = segments.legs(points(spark, rows)).orderBy("leg_idx").collect()
    assert [(r.leg_idx, r.n_points) for r in got] == [(0, 20), (1, 20)]


def chain_of(legs):
    return [(1, i, float(a), float(b), f, t, 10.0) for i, (a, b, f, t) in enumerate(legs)]


LEG = "hex long, leg_idx int, t_start double, t_end double, from_apt string, to_apt string, path_nm double"
H = 3600


@pytest.mark.parametrize(("gap", "n", "origin"), [(48 * H, 2, "X"), (48 * H + 1, 1, None)])
def test_inbound_ground_stop(spark, gap, n, origin):
    df = spark.createDataFrame(chain_of([(0, 10, "X", None), (10 + gap, 20 + gap, None, "KOSH"), (30 + gap, 40 + gap, "Y", "KOSH")]), LEG)
    r = journeys.journeys(df, "inbound").first()
    assert (r.n_legs, r.origin, r.destination) == (n, origin, "KOSH")


def test_outbound_and_round_trip(spark):
    df = spark.createDataFrame(chain_of([(0, 1, "KOSH", "KOSH"), (2, 3, "KOSH", "B"), (4, 5, "B", "C"), (6 + 49 * H, 7 + 49 * H, "C", "D")]), LEG)
    r = journeys.journeys(df, "outbound").first()
    assert (r.origin, r.destination, r.n_legs, r.leg_t_starts, r.total_nm) == ("KOSH", "C", 2, [2.0, 4.0], 20.0)
    assert journeys.journeys(df, "inbound").count() == 0


def brute_nearest(lat, lon, alt, airports):
    def xyz(p, q):
        p, q = np.radians(p), np.radians(q)
        return np.array([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)])

    d = [2 * DEFAULT.earth_nm * np.arcsin(min(1, np.linalg.norm(xyz(lat, lon) - xyz(a[1], a[2])) / 2)) for a in airports]
    i = int(np.argmin(d))
    return None if d[i] > 3 or (alt is not None and alt >= 0 and alt > airports[i][3] + 2000) else airports[i][0]


def test_nearest_airport_against_brute_force(spark):
    rng = np.random.default_rng(1)
    airports = [(f"A{i}", float(la), float(lo), float(e)) for i, (la, lo, e) in enumerate(zip(rng.uniform(-80, 80, 300), rng.uniform(-180, 180, 300), rng.uniform(0, 900, 300)))]
    airports += [("W", 10.0, 179.99, 0.0), ("E", 50.0, -179.99, 0.0)]
    probes = [(k, a[1] + float(rng.normal(0, 0.03)), a[2] + float(rng.normal(0, 0.03)), int(rng.integers(-1, 4000))) for k, a in enumerate(airports * 2)]
    probes += [(9001, 10.0, -179.99, None), (9002, 50.0, 179.995, None), (9003, 0.0, 0.0, None)]
    probes = [(k, la, (lo + 180) % 360 - 180, al) for k, la, lo, al in probes]
    dim = spark.createDataFrame(airports, "ident string, lat double, lon double, elev double")
    got = places.nearest_airport(spark.createDataFrame(probes, "id long, lat double, lon double, alt_ft int"), dim).collect()
    assert {r.id: r.ident for r in got} == {k: brute_nearest(la, lo, al, airports) for k, la, lo, al in probes}


def test_anchor_wins_and_no_second_choice(spark):
    dim = spark.createDataFrame([("LOW", 40.0, -80.0, 0.0), ("HIGH", 40.02, -80.0, 5000.0)], "ident string, lat double, lon double, elev double")
    probes = [(1, 40.001, -80.0, 2001), (2, 40.001, -80.0, 2000), (3, DEFAULT.anchor_lat, DEFAULT.anchor_lon, 3500), (4, DEFAULT.anchor_lat, DEFAULT.anchor_lon, 3501)]
    got = {r.id: r.ident for r in places.nearest_airport(spark.createDataFrame(probes, "id long, lat double, lon double, alt_ft int"), dim).collect()}
    assert got == {1: None, 2: "LOW", 3: "KOSH", 4: None}


def test_airport_dimension(spark):
    rows = [("1", "small_airport", "A", "1.5", "2", "", "", "GP"), ("2", "heliport", "B", "1", "2", "3", "", ""), ("3", "large_airport", "C", "bad", "2", "3", "IC", "GP"), ("4", "seaplane_base", "D", "1", "2", "7", "", "")]
    df = spark.createDataFrame(rows, "ident string, type string, name string, latitude_deg string, longitude_deg string, elevation_ft string, icao_code string, gps_code string")
    assert {(r.ident, r.elev) for r in places.airport_dimension(df).collect()} == {("GP", 0.0), ("4", 7.0)}


def test_projection_tie_and_order(spark):
    way = DEFAULT.waypoint_nm
    df = spark.createDataFrame([(la, lo) for _, la, lo in DEFAULT.corridor], "lat double, lon double")
    got = [r[0] for r in df.select(geo.projection(F.col("lat"), F.col("lon"))).collect()]
    assert [round(p.along, 9) for p in got] == [round(d, 9) for d in way.values()]
    assert [p.i for p in got] == [0, 0, 1, 2, 3]


def test_heading_wrap_and_region(spark):
    df = spark.range(1)
    assert df.select(geo.heading_change(F.lit(5.0 - 359.0))).first()[0] == 6.0
    got = df.select(*[geo.region(F.lit(a), F.lit(b)).alias(f"r{i}") for i, (a, b) in enumerate([(44.0, -88.0), (60.0, -60.0), (20.0, -60.0), (20.0, -120.0), (60.0, -120.0), (None, 1.0)])]).first()
    assert list(got) == ["Local", "Northeast", "Southeast", "Southwest", "Northwest", "Unknown"]
    sun = df.select(geo.subsolar(F.lit(1750420800.0)).alias("s")).first().s  # 2025-06-20 12:00 UTC
    assert abs(sun.lat - 23.4) < 0.1 and abs(sun.lon) < 1.0


def is_kept(i, before, ts, near, track):
    """The rule for one place, given the places kept before it."""
    if i in (0, len(ts) - 1):
        return True
    headings = [track[k] for k in before if k == 0 or not math.isnan(track[k])]
    off = abs((track[i] - headings[-1] + 540) % 360 - 180)
    return ts[i] - ts[before[-1]] >= (15 if near[i] else 60) or off >= 12


def test_downsample(spark):
    rng = np.random.default_rng(2)
    ts, near = np.cumsum(rng.integers(1, 30, 400)).astype(float), rng.random(400) < 0.5
    track = np.where(rng.random(400) < 0.1, np.nan, np.cumsum(rng.normal(0, 5, 400)) % 360)
    wait = np.where(near, 15.0, 60.0)
    kept = tracks.kept_places(ts, wait, track, 12.0)
    assert kept == [i for i in range(400) if is_kept(i, [k for k in kept if k < i], ts, near, track)]
    assert tracks.kept_places(ts[:2], wait[:2], track[:2], 12.0) == [0, 1] and tracks.kept_places(ts[:1], wait[:1], track[:1], 12.0) == [0]
    rows = [(1, i * 20, 44.0, -88.5, 0, 0) for i in range(300)] + [(1, 100_000 + i * 20, 44.0, -88.5, 0, 0) for i in range(30)]
    cut = segments.with_segments(points(spark, rows))
    got = [r.ts for r in tracks.downsample(cut, 50).where("seg = 0").orderBy("ts").collect()]
    assert got == [20.0 * int(i) for i in np.linspace(0, 299, 50)]
    shares = {r.seg: r.n for r in tracks.downsample(cut, 110, share=True).groupBy("seg").agg(F.count("*").alias("n")).collect()}
    assert shares == {0: 100, 1: 10}


def test_day_partitions_are_pruned(spark, tmp_path):
    spark.range(30).selectExpr("id", "id % 3 as day").write.partitionBy("day").parquet(str(tmp_path / "p"))
    one = spark.read.parquet(str(tmp_path / "p")).where(F.col("day") == 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and one.count() == 10


def test_histogram_edges(spark):
    df = spark.createDataFrame([(39.9,), (40.0,), (190.0,), (190.1,), (None,), (44.999,)], "v double")
    got = {r.bin: r.n for r in corridor.histogram(df, "v", 40.0, 190.0, 30).collect()}
    assert got[0] == 2 and got[29] == 1 and sum(got.values()) == 3 and len(got) == 30


def test_concurrency_counts_entry_first(spark):
    rows = [(1, 0, 0, "RIPON", 10.0), (1, 0, 0, "FISK", 20.0), (2, 0, 0, "RIPON", 20.0), (2, 0, 0, "FISK", 30.0), (3, 0, 0, "RIPON", 5000.0), (3, 0, 0, "FISK", 9000.0)]
    df = spark.createDataFrame(rows, "hex long, day long, seg long, code string, t double")
    assert tuple(corridor.peak_concurrency(df, "RIPON", "FISK").first()) == (2, 20.0)


def test_waypoints_against_numpy(spark):
    rng = np.random.default_rng(5)
    lats, lons = [w[1] for w in DEFAULT.corridor], [w[2] for w in DEFAULT.corridor]
    rows = []
    for h in range(6):
        f = np.clip(np.linspace(0.05 * h, 4, 60) + rng.normal(0, 0.01, 60), 0, 4)
        rows += [(h, i * 20, float(np.interp(x, range(5), lats)), float(np.interp(x, range(5), lons)), 1800 + i, 0) for i, x in enumerate(f)]
    got = corridor.transit_points(points(spark, rows).withColumn("day", F.lit(0)))
    ways = {(r.hex, r.code): r.t for r in corridor.waypoints(got).collect()}
    seen = 0
    for h in range(6):
        part = got.where(f"hex = {h}").orderBy("ts").toPandas()
        mono = np.maximum.accumulate(part.along) + np.arange(len(part)) * 1e-9
        for code, at in DEFAULT.waypoint_nm.items():
            inside = mono.iloc[0] <= at <= mono.iloc[-1]
            assert ((h, code) in ways) == inside
            if inside:
                seen += 1
                assert abs(ways[h, code] - np.interp(at, mono, part.ts)) < 1e-6
    assert seen > 15


def test_visit_rules(spark):
    c = replace(DEFAULT)
    here = (c.anchor_lat, c.anchor_lon)
    rows = [(1, 0, *here, 100, 0), (1, 1, here[0] + 0.15, here[1] + 0.2, 50, 0), (1, 2, *here, -1, 0), (1, 3, *here, None, 0), (1, 4, *here, 3501, 0), (2, 0, *here, 100, 0)]
    got = tracks.visits(points(spark, rows).withColumn("day", F.lit("d"))).collect()
    assert [(r.hex, r.n_hits, r.min_alt_ft, r.saw_ground, r.min_dist_nm) for r in got] == [(1, 2, -1, True, 0.0)]


def test_archive_source(spark, tmp_path):
    doc = {"timestamp": 100.0, "trace": [[0, 1.5, 2.5, "ground", 1.5, 90, None, 0, 0, 0, 77.9], [5, 1, 2, 1234.9, 3, 4, 2], [6, 1, 2, None, 3, 4]]}
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w") as tar:
        for name, body in (("x/trace_full_aa.json", gzip.compress(json.dumps(doc).encode())), ("x/trace_full_bb.json", b'{"timestamp": 1}'), ("x/trace_full_cc.json", b"\x1f\x8bbroken"), ("x/other.json", b"{}")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    raw = data.getvalue()
    (tmp_path / "2026.07.14").mkdir()
    (tmp_path / "2026.07.14" / "d.tar.aa").write_bytes(raw[:700])
    (tmp_path / "2026.07.14" / "d.tar.ab").write_bytes(raw[700:])
    spark.dataSource.register(traces.TraceArchive)
    docs = spark.read.format("trace_archive").load(str(tmp_path))
    assert {r.hex for r in docs.collect()} == {"aa", "bb"}
    got = traces.decode_points(docs, "doc", ["day", "hex"]).orderBy("ts").collect()
    assert [(r.hex, r.ts, r.alt_ft, r.flags, r.geom_alt) for r in got] == [("aa", 100.0, -1, 0, 77), ("aa", 105.0, 1234, 2, None), ("aa", 106.0, None, 0, None)]
    assert spark.read.format("trace_archive").option("hexes", "bb").load(str(tmp_path)).count() == 1


def test_sinks(spark, tmp_path):
    df = points(spark, line(30)).withColumn("day", F.lit("2026-07-14"))
    sinks.write_traces(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("day = '2026-07-14'").count() == 30


def test_streams(spark, tmp_path):
    rows = [(1, f"2026-01-01 00:00:{i:02d}") for i in range(20)] + [(1, "2026-01-01 03:00:00"), (2, "2026-01-01 05:00:00")]
    df = spark.createDataFrame(rows, "hex long, t string").select("hex", F.to_timestamp("t").alias("time"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, out in (("legs", sessions.stream_segments(stream)), ("buckets", sessions.stream_buckets(stream))):
        q = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(60)
    assert [r.n_points for r in spark.table("legs").collect()] == [20]
    assert spark.table("buckets").where("n = 20").count() == 1


def test_points_in_spans_as_plain_join(spark):
    rng = np.random.default_rng(3)
    pts = [(int(h), float(t)) for h, t in zip(rng.integers(0, 3, 900), rng.integers(0, 400_000, 900))] + [(None, 5.0), (1, None)] + [(9, float(i)) for i in range(1000)]
    legs = [(int(h), i, float(a), float(a + n)) for i, (h, a, n) in enumerate(zip(rng.integers(0, 4, 200), rng.integers(0, 400_000, 200), rng.integers(0, 90_000, 200)))]
    legs += [(9, 1000 + i, float(i), float(i + 3)) for i in range(1000)]
    got = tracks.points_in_spans(spark.createDataFrame(pts, "hex long, ts double"), spark.createDataFrame(legs, "hex long, leg_idx long, t_start double, t_end double")).collect()
    want = {(h, i): n for h, i, a, b in legs if (n := sum(1 for p, t in pts if p == h and t is not None and a - 1 <= t <= b + 1)) >= 2}
    assert {(r.hex, r.leg_idx): r.n for r in got} == want


def test_stab_counts(spark):
    spans = [(0.0, 10.0), (10.0, 20.0), (9.9, 9.95), (-50.0, -1.0), (35.0, 500.0), (95.0, 400.0), (5.0, 5.0)]
    got = tracks.stab_counts(spark.createDataFrame(spans, "t_start double, t_end double"), 0.0, 5.0, 20).collect()
    assert {r.t: r.n for r in got} == {5.0 * i: sum(a <= 5.0 * i <= b for a, b in spans) for i in range(20)}


def test_spacing_over_hours(spark):
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(0, 50)), d, i, "FISK", float(d * 86400 + int(rng.integers(0, 86400)) // 7 * 7), float(rng.integers(60, 120))) for d in (0, 1) for i in range(60)]
    got = corridor.spacing(spark.createDataFrame(rows, "hex long, day long, seg long, code string, t double, gs double"), "FISK").collect()
    want = []
    for day in (0, 1):
        own = sorted((t, h, s, g) for h, d, s, _, t, g in rows if d == day)
        want += [(h, day, s, t - t0, h0, g0) for (t0, h0, _, g0), (t, h, s, _) in zip(own, own[1:])]
    assert sorted((r.hex, r.day, r.seg, r.gap_s, r.lead_hex, r.lead_gs) for r in got) == sorted(want)


def test_quantiles_by_counting(spark):
    from wakeline.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(6)
    values = {0: rng.normal(0, 1e6, 500), 1: np.array([1.5]), 2: np.repeat([3.0, 7.0], 200), 3: np.concatenate([rng.normal(1e-9, 1e-12, 300), [1e12, -1e300]]), None: np.array([2.0, 4.0])}
    rows = [(g, float(v), int(i)) for g, vs in values.items() for i, v in enumerate(vs)] + [(0, None, None), (0, float("nan"), None), (7, None, None)]
    df = spark.createDataFrame(rows, "g int, a double, b int")
    for cells in (2, 256):
        got = {(r.g, r.column, r.i): r.value for r in exact_quantiles(df, "g", ["a", "b"], [0.0, 0.25, 0.5, 0.98, 1.0], cells).collect()}
        assert {k[0] for k in got} == set(values)
        for g, vs in values.items():
            for i, q in enumerate((0.0, 0.25, 0.5, 0.98, 1.0)):
                assert math.isclose(got[g, "a", i], float(np.quantile(vs, q)), rel_tol=1e-12)
                assert got[g, "b", i] == float(np.quantile(np.arange(len(vs)), q))


def test_quantiles_of_extremes(spark):
    """Infinite values, and finite ones whose difference is infinite, end the counting like any other."""
    from wakeline.operators.quantiles import exact_quantiles

    inf, most = float("inf"), 1.7976931348623157e308
    groups = {0: [-inf, -most, 0.0, most, inf], 1: [-most, most, most], 2: [inf, inf, 1.0], 3: [-inf, inf], 4: [-5e-324, 0.0, 5e-324]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, a double")
    got = {(r.g, r.i): r.value for r in exact_quantiles(df, "g", ["a"], [0.0, 0.5, 1.0]).collect()}
    for g, vs in groups.items():
        ends, middle = sorted(vs), sorted(vs)[len(vs) // 2]
        assert (got[g, 0], got[g, 2]) == (ends[0], ends[-1])
        assert math.isnan(got[g, 1]) if g == 3 else got[g, 1] == middle


def test_rounding_as_python(spark):
    from wakeline.functions.rounding import round_half_even

    rng = np.random.default_rng(8)
    values = [2.675, 0.5, 1.5, 2.5, -2.5, 1.005, 0.125, 0.375, 2.5e15 + 0.5, 1e300, -0.045, 0.045, 1e-320, 0.05, 0.15, 0.25, 0.35, 4503599627370497.5]
    values += [float(v) for v in rng.normal(0, 1000, 300)] + [i / 8 for i in range(-40, 40)] + [i / 1000 for i in range(995, 1030)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3, 9):
        got = df.select("v", round_half_even(F.col("v"), digits).alias("r")).collect()
        assert [(r.v, r.r) for r in got] == [(v, round(v, digits)) for v in values]
    odd = spark.createDataFrame([(None,), (float("inf"),), (float("nan"),)], "v double").select(round_half_even(F.col("v"), 1).alias("r")).collect()
    assert odd[0].r is None and odd[1].r == float("inf") and math.isnan(odd[2].r)


def test_shared_clock_from_manifest(spark, tmp_path):
    from wakeline.operators import reports

    legs = spark.createDataFrame([(1, 1000.7, 1010.2), (2, 1500.0, 1600.0)], "hex long, t_start double, t_end double")
    starts = lambda m: sorted(r.start_s for r in reports.on_shared_clock(legs, m).collect())
    path = str(tmp_path / "manifest.json")
    assert reports.window_start(spark, path) is None and starts(None) == [0, 500]
    (tmp_path / "manifest.json").write_text('{"window_start": 900,\n "journeys": [{"id": 0}]}')
    assert starts(reports.window_start(spark, path)) == [100, 600]
    (tmp_path / "manifest.json").write_text('{"journeys": []}')
    assert starts(reports.window_start(spark, path)) == [0, 500]


def test_neighbours_at_one_instant(spark):
    rows = [(0, h, 0, 100.0 + 300 * i, 10.0 * h + i) for h in (1, 2) for i in range(4)] + [(0, 3, 0, 5000.0, 1.0), (1, 4, 0, 250.0, 1.0)]
    df = spark.createDataFrame(rows, "day long, hex long, seg long, ts double, alt double")
    asked = spark.createDataFrame([(0, 250.0), (0, 1000.0), (0, 1001.0), (0, 5000.0)], "day long, q double")
    got = tracks.neighbours_at(df, asked, ["hex", "seg"], ["alt"]).collect()
    assert sorted((r.q, r.hex, r.alt) for r in got) == [(250.0, 1, 10.5), (250.0, 2, 20.5), (1000.0, 1, 13.0), (1000.0, 2, 23.0), (5000.0, 3, 1.0)]


def test_stream_segments_as_batch(spark, tmp_path):
    """Gaps, teleports, flags and repeated instants, points out of order over several files: as the batch operator cuts them."""
    from wakeline.streaming.segments import stream_tracks

    rng = np.random.default_rng(9)
    rows = []
    for h in ("aa", "bb", "cc"):
        ts, lat = 1_000_000.0, 44.0
        for i in range(120):
            ts += float(rng.choice([0.2, 5, 20, 20, 20, 950]))
            lat += float(rng.choice([0, 0.001, 0.001, 0.4]))
            rows.append((h, ts, lat, -88.5, 2 if i % 37 == 36 else None if i % 10 == 3 else 0))
    schema = "hex string, ts double, lat double, lon double, flags int"
    late = sorted(rows, key=lambda r: r[1] + float(rng.uniform(0, 300)))
    late = [*late, (None, 5.0, 1.0, 1.0, 0), ("zz", 9_000_000.0, 44.0, -88.5, 0)]
    folder = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for i in range(4):
            spark.createDataFrame(late[i * 91 : (i + 1) * 91], schema).coalesce(1).write.mode("append").parquet(folder)
        out = stream_tracks(stream, "10 minutes").writeStream.format("memory").queryName("tracks_out").outputMode("append")
        query = out.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(240)
    finally:
        spark.conf.unset(provider)
    got = sorted((r.hex, r.ts, r.seg) for r in spark.table("tracks_out").collect())
    batch = segments.with_segments(segments.distinct_instants(spark.createDataFrame(rows, schema)), flags=True)
    want = sorted((r.hex, r.ts, r.seg) for r in batch.collect())
    assert len({s for _, _, s in want}) > 20
    assert got == want


def test_airport_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,ident,type,name,latitude_deg,longitude_deg,elevation_ft,continent,iso_country,iso_region,municipality,scheduled_service,gps_code,icao_code\n'
        '1,K1,small_airport,"One, old",44.0,-88.0,800,NA,US,US-WI,Town,no,,KONE\n2,K2,heliport,Two,1,2,,NA,US,US-IL,,no,KTWO,\n3,A0,closed,Three,9,9,,NA,US,US-XX,Other,no,,KONE\n'
    )
    raw = traces.read_airports(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in places.airport_dimension(raw).collect()] == [("KONE", "One, old", 44.0, -88.0, 800.0)]
    names = {r.ident: tuple(r)[1:] for r in places.airport_names(raw).collect()}
    assert names == {"KONE": ("Three", "Other", "US-XX", 9.0, 9.0), "KTWO": ("Two", None, "US-IL", 1.0, 2.0)}


def test_airport_files_have_all_fields(spark, tmp_path):
    from wakeline.sources.documents import write_documents

    legs = spark.createDataFrame([("a1", "KOSH", "KX", 10.0, 20.0), ("b2", None, "KOSH", 5.0, 8.0), ("a1", "../x", "KOSH", 30.0, 40.0), ("a1", None, "KY\n", 1.0, 2.0)], "hex string, from_apt string, to_apt string, t_start double, t_end double")
    airports = spark.createDataFrame([("KOSH", "Wittman", "Oshkosh", "US-WI", 43.98, None)], "ident string, name string, city string, iso_region string, lat double, lon double")
    craft = spark.createDataFrame([("a1", "N1", "C172", None)], "hex string, reg string, type string, desc string")
    write_documents(places.airport_documents(places.airport_parts(places.touches(legs), airports, craft, 2)), str(tmp_path), "touches")
    got = {p.stem: json.loads(p.read_text()) for p in tmp_path.iterdir()}
    touch = lambda h, d, o, a, b: {"hex": h, "reg": "N1" if h == "a1" else None, "type": "C172" if h == "a1" else None, "desc": None, "dir": d, "other": o, "t_start": a, "t_end": b}
    assert got == {
        "KOSH": {"ident": "KOSH", "name": "Wittman", "city": "Oshkosh", "iso_region": "US-WI", "lat": 43.98, "lon": None, "arrivals": 2, "departures": 1, "touches": [touch("b2", "arrival", None, 5.0, 8.0), touch("a1", "departure", "KX", 10.0, 20.0), touch("a1", "arrival", "../x", 30.0, 40.0)]},
        "KX": {"ident": "KX", "arrivals": 1, "departures": 0, "touches": [touch("a1", "arrival", "KOSH", 10.0, 20.0)]},
    }


def test_parts_of_a_hub_are_dealt_to_many_tasks(spark):
    """The hub's rows must not meet in one task, whatever the planner knows about sizes."""
    rows = [("KHUB", "KX", "arrival", f"h{i % 7}", None if i < 5 else float(i * 5_000), float(i * 5_000 + 60)) for i in range(1_995)]
    rows += [("KONE", None, "departure", "h1", 9.0, 10.0), (None, "KX", "arrival", "h1", 9.0, 10.0)]
    traffic = spark.createDataFrame(rows, "ident string, other string, dir string, hex string, t_start double, t_end double")
    airports = spark.createDataFrame([("KHUB", "Hub", "Town", "US-WI", 44.0, -88.0)], "ident string, name string, city string, iso_region string, lat double, lon double")
    craft = spark.createDataFrame([("h1", "N1", "C172", None)], "hex string, reg string, type string, desc string")
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        got = places.airport_parts(traffic, airports, craft, 10).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hub = sorted((r for r in got if r.ident == "KHUB"), key=lambda r: r.part)
    assert [(r.part, len(r.touches)) for r in hub] == [(p, 10) for p in range(199)] + [(199, 5)]
    assert {(r.known, r.name, r.arrivals, r.departures) for r in hub} == {(True, "Hub", 1_995, 0)}
    assert [t.t_end for r in hub for t in r.touches] == [float(i * 5_000 + 60) for i in range(1_995)]
    assert [(r.ident, r.part, r.known, r.name, r.arrivals, r.departures, len(r.touches)) for r in got if r.ident != "KHUB"] == [("KONE", 0, False, None, 0, 1, 1)]
    tasks = [r.task for r in hub]
    assert max(map(tasks.count, tasks)) < len(tasks) / 2
