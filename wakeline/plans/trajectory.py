"""Queries over the trajectory operators, each with plain SQL that must give the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT
from wakeline.functions import geo, labels
from wakeline.operators import corridor, journeys, places, reports, segments, tracks
from wakeline.plans.adapters import CHAIN, PTS, chain, epoch, pts, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
C = DEFAULT
#: Journeys of the order table turn around place A, with stops of up to 180 days.
ORDERS = replace(DEFAULT, anchor="A", ground_stop_s=180 * 86400.0)


def query(sql: str | None = None, name: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return register


def num(x: float) -> str:
    return f"cast({x!r} as double)"


def flat(lat: str, lon: str) -> str:
    y, x = f"(({lat}) * 60)", f"(({lon}) * 60 * {num(C.cos_anchor)})"
    return f"sqrt({y} * {y} + {x} * {x})"


def arc(a: str, b: str, c: str, d: str) -> str:
    xyz = lambda p, q: (f"cos(radians({p})) * cos(radians({q}))", f"cos(radians({p})) * sin(radians({q}))", f"sin(radians({p}))")
    squares = " + ".join(f"pow({u} - {v}, 2)" for u, v in zip(xyz(a, b), xyz(c, d)))
    return f"({num(2 * C.earth_nm)} * asin(least(sqrt({squares}) / 2, 1)))"


def _cut(source: str, out: str, by: str = "hex", flags: bool = False) -> str:
    """CTE text that numbers segments of ``source``."""
    flag = " or (flags & 2) <> 0" if flags else ""
    return f"""
{out}_d as (select *, ts - lag(ts) over w as dt, {flat('lat - lag(lat) over w', 'lon - lag(lon) over w')} as dnm
  from {source} window w as (partition by {by} order by ts)),
{out} as (select *, sum(case when dt > 900 or (dt > 0 and dnm * 3600 / dt > 700 and dnm > 5){flag} then 1 else 0 end)
  over (partition by {by} order by ts rows unbounded preceding) as seg from {out}_d)"""


LEGS = f"""{PTS},
dd as (select * from (select *, ts - lag(ts) over (partition by hex order by ts) as step from pts) where step is null or step > 0.5),
{_cut('dd', 'cut', flags=True)},
hops as (select *, case when lag(lat) over w is not null then {arc('lag(lat) over w', 'lag(lon) over w', 'lat', 'lon')} end as hop from cut window w as (partition by hex, seg order by ts)),
legs0 as (select hex, seg, min(ts) as t_start, max(ts) as t_end, count(*) as n_points, arg_min(lat, ts) as from_lat, arg_min(lon, ts) as from_lon,
    arg_min_null(alt_ft, ts) as from_alt, arg_max(lat, ts) as to_lat, arg_max(lon, ts) as to_lon, arg_max_null(alt_ft, ts) as to_alt,
    max(alt_ft) as top, round(coalesce(sum(hop), 0), 1) as path_nm from hops group by hex, seg),
legs as (select hex, row_number() over (partition by hex order by t_start) - 1 as leg_idx, * exclude (hex, seg, top) from legs0
  where n_points >= 15 and t_end - t_start >= 120 and (top is null or top > 0))"""


@query(f"""with e as (select user_id, cast(epoch(ts) as double) as ts from events),
n as (select *, sum(case when gap > 21600 then 1 else 0 end) over (partition by user_id order by ts rows unbounded preceding) as seg
  from (select *, ts - lag(ts) over (partition by user_id order by ts) as gap from e)),
l as (select user_id, seg, count(*) as n_points, min(ts) as t_start, max(ts) as t_end from n group by user_id, seg)
select user_id, seg, n_points, t_start, t_end from l where n_points >= 3 and t_end - t_start >= 120""")
def leg_segments(spark, d):
    events = table(spark, d, "events").select("user_id", F.expr(epoch("ts")).alias("ts"))
    return segments.event_segments(events, "user_id", 21600, 3, 120)


@query(f"""with {PTS}, dd as (select * from (select *, ts - lag(ts) over (partition by hex order by ts) as step from pts) where step is null or step > 0.5),
{_cut('dd', 'cut', flags=True)} select hex, seg, count(*) as n_points, cast(sum(case when (flags & 2) <> 0 then 1 else 0 end) as bigint) as n_flags from cut group by hex, seg""")
def leg_dedupe_flags(spark, d):
    cut = segments.with_segments(segments.distinct_instants(pts(spark, d)), flags=True)
    return cut.groupBy("hex", "seg").agg(F.count("*").alias("n_points"), F.sum((F.col("flags").bitwiseAND(F.lit(2)) != 0).cast("int")).alias("n_flags"))


#: Every 97th point thrown 30 degrees off, to have teleports.
@query(f"""with {PTS}, far as (select * replace (case when event_id % 97 = 0 then lat + 30 else lat end as lat) from pts),
{_cut('far', 'cut')} select hex, seg, count(*) as n_points, min(ts) as t_start from cut group by hex, seg""")
def leg_teleport_split(spark, d):
    far = pts(spark, d).withColumn("lat", F.when(F.col("event_id") % 97 == 0, F.col("lat") + 30).otherwise(F.col("lat")))
    return segments.with_segments(far).groupBy("hex", "seg").agg(F.count("*").alias("n_points"), F.min("ts").alias("t_start"))


@query(f"with {LEGS} select * replace (cast(from_alt as double) as from_alt, cast(to_alt as double) as to_alt) from legs")
def leg_endpoints_path(spark, d):
    return segments.legs(pts(spark, d)).withColumns({c: F.col(c).cast("double") for c in ("from_alt", "to_alt")})


@query(f"""with {PTS}, shifted as (select *, lat + 0.0285 as la, lon + 0.1243 as lo from pts),
box as (select *, alt_ft = -1 as g, {flat(f'la - {num(C.anchor_lat)}', f'lo - {num(C.anchor_lon)}')} as dist from shifted
  where la between {num(C.anchor_lat)} - 0.16 and {num(C.anchor_lat)} + 0.16 and lo between {num(C.anchor_lon)} - 0.23 and {num(C.anchor_lon)} + 0.23 and alt_ft <= 3500)
select day, hex, min(ts) filter (where dist <= 8) as first_ts, max(ts) filter (where dist <= 8) as last_ts, round(min(dist), 2) as min_dist_nm,
  min(alt_ft) as min_alt_ft, bool_or(g) filter (where dist <= 8) as saw_ground, count(*) filter (where dist <= 8) as n_hits
from box group by day, hex having count(*) filter (where dist <= 8) >= 2""")
def visits_per_entity_day(spark, d):
    near = pts(spark, d).withColumn("lat", F.col("lat") + 0.0285).withColumn("lon", F.col("lon") + 0.1243)
    return tracks.visits(near)


@query("select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1")
def latest_per_key(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    rows = table(spark, d, "events").withColumn("r", F.row_number().over(w)).where("r = 1")
    return rows.select("user_id", "event_id", "event_type", "value")


@query("""with docs as (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events)
select event_id, k, case k % 3 when 0 then -1 when 1 then cast(trunc(k * 10.7) as double) end as alt_ft, 0 as dt, coalesce(case when k % 2 = 0 then 2 end, 0) as flags
from docs where k is not null""")
def raw_doc_decode(spark, d):
    from wakeline.sources.traces import decode_points

    k = F.get_json_object("props", "$.k").cast("long")
    alt = F.when(k % 3 == 0, '"ground"').when(k % 3 == 1, F.format_number(k * 10.7, 2)).otherwise("null")
    alt = F.regexp_replace(alt, ",", "")
    doc = F.concat(F.lit('{"timestamp":0,"trace":[[0,43.5,-88.5,'), alt, F.lit(",90.5,10.0,"), F.when(k % 2 == 0, "2").otherwise("null"), F.lit("]]}"))
    rows = table(spark, d, "events").select("event_id", k.alias("k"), doc.alias("doc")).where("k is not null")
    got = decode_points(rows, "doc", ["event_id", "k"])
    return got.select("event_id", "k", F.col("alt_ft").cast("double").alias("alt_ft"), F.col("ts").cast("int").alias("dt"), "flags")


@query("""select coalesce(nullif(case when p_partkey % 3 = 0 then '' else p_brand end, ''), nullif(case when p_partkey % 2 = 0 then '' else p_type end, ''), p_name) as ident,
  min(p_name) as name, count(*) as n from part group by 1""")
def fallback_ident(spark, d):
    brand, kind = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_brand")), F.when(F.col("p_partkey") % 2 == 0, "").otherwise(F.col("p_type"))
    ident = F.coalesce(F.nullif(brand, F.lit("")), F.nullif(kind, F.lit("")), F.col("p_name"))
    return table(spark, d, "part").groupBy(ident.alias("ident")).agg(F.min("p_name").alias("name"), F.count("*").alias("n"))


@query("""select c_mktsegment, count(*) as n, count(distinct c_nationkey) as nations from customer
where c_custkey in (select distinct o_custkey from orders where o_totalprice > 200000) group by 1""")
def semi_join_reduce(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(big, "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations"))


@query("""select o_orderkey, c_name, n_name from orders left join customer on o_custkey = c_custkey and c_acctbal > 0 left join nation on c_nationkey = n_nationkey""")
def left_join_dim(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").select("o_orderkey", "c_name", "n_name")


@query(f"with {LEGS} select p.hex, leg_idx, count(*) as n from pts p join legs l on p.hex = l.hex and p.ts between t_start - 1 and t_end + 1 group by 1, 2 having count(*) >= 2")
def interval_contain_join(spark, d):
    return tracks.points_in_spans(pts(spark, d), segments.legs(pts(spark, d)))


#: A made-up grid of airports over the corridor.
GRID = [(f"G{i}_{j}", 43.70 + i * 0.06, -89.60 + j * 0.11, float((i * 37 + j * 11) % 900)) for i in range(8) for j in range(12)]
GRID_SQL = "airports(ident, alat, alon, elev) as (values " + ", ".join(f"('{a}', {num(b)}, {num(c)}, {num(e)})" for a, b, c, e in GRID) + ")"


@query(f"""with {PTS}, {GRID_SQL},
near as (select event_id, lat, lon, alt_ft, ident, elev, {arc('lat', 'lon', 'alat', 'alon')} as dist from pts, airports where abs(lat - alat) < 0.06 and abs(lon - alon) < 0.09),
best as (select event_id, arg_min({{'ident': ident, 'elev': elev, 'd': dist}}, {{'d': dist, 'ident': ident}}) as b from near where dist <= 3 group by event_id)
select p.event_id as id, case when {arc('lat', 'lon', num(C.anchor_lat), num(C.anchor_lon))} <= 8 and (alt_ft is null or alt_ft < 0 or alt_ft <= 3500) then 'KOSH'
  when alt_ft >= 0 and alt_ft > b.elev + 2000 then null else b.ident end as ident, round(b.d, 6) as dist_nm from pts p left join best using (event_id)""")
def nearest_airport_grid(spark, d):
    grid = spark.createDataFrame(GRID, "ident string, lat double, lon double, elev double")
    probes = pts(spark, d).select(F.col("event_id").alias("id"), "lat", "lon", "alt_ft")
    return places.nearest_airport(probes, grid).select("id", "ident", F.round("dist_nm", 6).alias("dist_nm"))


def _journey_sql(direction: str) -> str:
    at = lambda c: f"({c} is not distinct from 'A')"
    stop = 180 * 86400
    if direction == "inbound":
        pivot, edge = f"min(case when {at('to_apt')} and not {at('from_apt')} then leg_idx end)", f"max(case when leg_idx < turn and gap_next > {stop} then leg_idx end)"
        keep, origin, dest = "leg_idx <= turn and (edge is null or leg_idx > edge)", "arg_min_null(from_apt, leg_idx)", "'A'"
    else:
        pivot, edge = f"max(case when {at('from_apt')} and not {at('to_apt')} then leg_idx end)", f"min(case when leg_idx > turn and gap_prev > {stop} then leg_idx end)"
        keep, origin, dest = "leg_idx >= turn and (edge is null or leg_idx < edge)", "'A'", "arg_max_null(to_apt, leg_idx)"
    return f"""{CHAIN},
g as (select *, lead(t_start) over w - t_end as gap_next, t_start - lag(t_end) over w as gap_prev from chain window w as (partition by hex order by leg_idx)),
p as (select *, {pivot} over (partition by hex) as turn from g), q as (select *, {edge} over (partition by hex) as edge from p),
{direction} as (select hex, '{direction}' as direction, {origin} as origin, {dest} as destination, min(t_start) as t_start, arg_max(t_end, leg_idx) as t_end,
  count(*) as n_legs, round(sum(path_nm), 1) as total_nm, list_sort(list(t_start)) as leg_t_starts from q where {keep} group by hex)"""


@query(f"with {_journey_sql('inbound')} select * exclude (leg_t_starts), array_to_string(leg_t_starts, ',') as starts from inbound")
def journeys_inbound(spark, d):
    return _flat_starts(journeys.journeys(chain(spark, d), "inbound", ORDERS))


@query(f"with {_journey_sql('outbound')} select * exclude (leg_t_starts), array_to_string(leg_t_starts, ',') as starts from outbound")
def journeys_outbound(spark, d):
    return _flat_starts(journeys.journeys(chain(spark, d), "outbound", ORDERS))


def _flat_starts(found: DataFrame) -> DataFrame:
    # Epoch seconds of whole days: written like DuckDB writes a double.
    text = F.array_join(F.transform("leg_t_starts", lambda x: F.concat(x.cast("long").cast("string"), F.lit(".0"))), ",")
    return found.withColumn("starts", text).drop("leg_t_starts")


@query(f"with {_journey_sql('inbound')} select direction, count(*) as n, round(avg(n_legs), 2) as avg_legs, round(avg(total_nm), 2) as avg_nm from inbound group by direction")
def direction_summary(spark, d):
    found = journeys.journeys(chain(spark, d), "inbound", ORDERS)
    return found.groupBy("direction").agg(F.count("*").alias("n"), F.round(F.avg("n_legs"), 2).alias("avg_legs"), F.round(F.avg("total_nm"), 2).alias("avg_nm"))


_BEARING = f"fmod(degrees(atan2((lon2 - {num(C.anchor_lon)}) * 60 * {num(C.cos_anchor)}, (lat2 - {num(C.anchor_lat)}) * 60)) + 360, 360)"


@query(f"""with {PTS}, far as (select event_id, case when event_id % 41 = 0 then null else lat + (event_id % 9 - 4) end as lat2, lon + (event_id % 7 - 3) as lon2 from pts)
select region, count(*) as n from (select case when lat2 is null then 'Unknown' when {flat(f'lat2 - {num(C.anchor_lat)}', f'lon2 - {num(C.anchor_lon)}')} <= 100 then 'Local'
  else list_element(['Northeast', 'Southeast', 'Southwest', 'Northwest'], cast(floor({_BEARING} / 90) as int) + 1) end as region from far) group by region""")
def region_quadrants(spark, d):
    far = pts(spark, d).select(F.when(F.col("event_id") % 41 != 0, F.col("lat") + (F.col("event_id") % 9 - 4)).alias("lat"), (F.col("lon") + (F.col("event_id") % 7 - 3)).alias("lon"))
    return far.groupBy(geo.region(F.col("lat"), F.col("lon")).alias("region")).agg(F.count("*").alias("n"))


@query("""select strftime((ts at time zone 'UTC') at time zone 'America/Chicago', '%Y-%m-%d') as day, count(*) filter (where event_type = 'click') as clicks, count(*) as n
from events group by 1""")
def daily_local_counts(spark, d):
    day = labels.local_date(F.expr(epoch("ts")))
    return table(spark, d, "events").groupBy(day.cast("string").alias("day")).agg(F.count_if(F.col("event_type") == "click").alias("clicks"), F.count("*").alias("n"))


@query(f"with {_journey_sql('inbound')} select origin, count(*) as n from inbound where origin is not null and origin <> 'A' group by 1 order by n desc, origin limit 12")
def top_k_origins(spark, d):
    found = journeys.journeys(chain(spark, d), "inbound", ORDERS).where("origin is not null and origin <> 'A'")
    return found.groupBy("origin").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "origin").limit(12)


@query("select p_type, count(*) as n, count(distinct l_orderkey) as orders from lineitem join part on l_partkey = p_partkey group by 1 order by n desc, p_type limit 12")
def top_k_types(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type")
    items = table(spark, d, "lineitem").select("l_partkey", "l_orderkey")
    return items.join(part, items.l_partkey == part.p_partkey).groupBy("p_type").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders")).orderBy(F.desc("n"), "p_type").limit(12)


@query(f"""with {CHAIN} select hex, count(*) as n_legs, min(t_start) as first_ts, max(t_end) as last_ts, sum(t_end - t_start) as time_aloft_s,
  min(case when to_apt = 'A' then t_end end) as arrival_ts, max(case when from_apt = 'A' then t_start end) as departure_ts from chain group by hex""")
def entity_rollup(spark, d):
    return chain(spark, d).groupBy("hex").agg(
        F.count("*").alias("n_legs"), F.min("t_start").alias("first_ts"), F.max("t_end").alias("last_ts"), F.sum(F.col("t_end") - F.col("t_start")).alias("time_aloft_s"),
        F.min(F.when(F.col("to_apt") == "A", F.col("t_end"))).alias("arrival_ts"), F.max(F.when(F.col("from_apt") == "A", F.col("t_start"))).alias("departure_ts"),
    )


TOUCHES = f"""{CHAIN}, touches as (select to_apt as ident, from_apt as other, 'arrival' as dir, hex, t_start, t_end from chain where to_apt is not null
union all select from_apt, to_apt, 'departure', hex, t_start, t_end from chain where from_apt is not null)"""


@query(f"with {TOUCHES} select * from touches")
def airport_touches(spark, d):
    return places.touches(chain(spark, d))


@query(f"with {TOUCHES} select ident, count(*) filter (where dir = 'arrival') as arrivals, count(*) filter (where dir = 'departure') as departures from touches group by ident")
def airport_index(spark, d):
    return places.airport_index(places.touches(chain(spark, d)))


def _projection_sql() -> str:
    x, y = f"(lon * 60 * {num(C.cos_corridor)})", "(lat * 60)"
    parts = []
    for i, p in enumerate(C.legs_of_corridor):
        px, py = f"({x} - {num(p['ax'])})", f"({y} - {num(p['ay'])})"
        t = f"least(greatest(({px} * {num(p['vx'])} + {py} * {num(p['vy'])}) / ({num(p['len'])} * {num(p['len'])}), 0.0), 1.0)"
        dx, dy = f"({x} - ({num(p['ax'])} + {t} * {num(p['vx'])}))", f"({y} - ({num(p['ay'])} + {t} * {num(p['vy'])}))"
        dist = f"sqrt({dx} * {dx} + {dy} * {dy})"
        side = f"case when {num(p['vx'])} * {py} - {num(p['vy'])} * {px} >= 0 then 1.0 else -1.0 end"
        parts.append(f"{{'dist': {dist}, 'i': {i}, 'along': {num(p['cum'])} + {t} * {num(p['len'])}, 'side': {side}}}")
    return f"list_aggregate([{', '.join(parts)}], 'min')"


_LATS, _LONS = [w[1] for w in C.corridor], [w[2] for w in C.corridor]
CORRIDOR = f"""{PTS},
proj as (select *, {_projection_sql()} as p from pts
  where lat between {num(min(_LATS) - 5 / 60)} and {num(max(_LATS) + 5 / 60)} and lon between {num(min(_LONS) - 5 / (60 * C.cos_corridor))} and {num(max(_LONS) + 5 / (60 * C.cos_corridor))}
  and gs >= 40 and alt_ft between 0 and 4000),
inside as (select *, p.along as along, p.side * p.dist as cr from proj)"""
TRANSITS = f"""{CORRIDOR}, {_cut('inside', 'runs', by='hex, day')},
good as (select hex, day, seg from runs group by hex, day, seg having count(*) >= 5 and max(along) - min(along) >= 15 and regr_slope(along, ts - 1784160000) > 0),
tp as (select * from runs join good using (hex, day, seg))"""
WAYS = f"""{TRANSITS},
mono as (select *, max(along) over (partition by hex, day, seg order by ts rows unbounded preceding) + (row_number() over (partition by hex, day, seg order by ts) - 1) * cast(1e-9 as double) as m from tp),
br as (select *, lead(m) over w as m2, lead(ts) over w as t2, lead(alt_ft) over w as a2, lead(gs) over w as g2 from mono window w as (partition by hex, day, seg order by ts)),
wps(wp, code, at_nm) as (values {', '.join(f"({i}, '{c}', {num(x)})" for i, (c, x) in enumerate(C.waypoint_nm.items()))}),
ways as (select hex, day, seg, code, wp, coalesce(ts + (t2 - ts) * ((at_nm - m) / (m2 - m)), ts) as t, coalesce(alt_ft + (a2 - alt_ft) * ((at_nm - m) / (m2 - m)), alt_ft) as alt_ft,
  coalesce(gs + (g2 - gs) * ((at_nm - m) / (m2 - m)), gs) as gs from br, wps where m <= at_nm and (at_nm < m2 or (m2 is null and at_nm = m)))"""


@query(f"with {CORRIDOR} select event_id, round(along, 6) as along, round(cr, 6) + 0.0 as cross_nm from inside")
def corridor_projection(spark, d):
    return corridor.in_corridor(pts(spark, d)).select("event_id", F.round("along", 6).alias("along"), (F.round("cross", 6) + 0.0).alias("cross_nm"))


@query(f"with {TRANSITS} select hex, day, seg, count(*) as n, min(ts) as t_enter, max(ts) as t_exit, round(max(along) - min(along), 6) as span from tp group by 1, 2, 3")
def corridor_transits(spark, d):
    rows = corridor.transit_points(pts(spark, d)).groupBy("hex", "day", "seg")
    return rows.agg(F.count("*").alias("n"), F.min("ts").alias("t_enter"), F.max("ts").alias("t_exit"), F.round(F.max("along") - F.min("along"), 6).alias("span"))


def _ways(spark, d) -> DataFrame:
    return corridor.waypoints(corridor.transit_points(pts(spark, d)))


@query(f"with {WAYS} select hex, day, seg, code, round(t, 4) as t, round(alt_ft, 4) as alt_ft, round(gs, 4) as gs from ways")
def corridor_waypoints(spark, d):
    return _ways(spark, d).select("hex", "day", "seg", "code", F.round("t", 4).alias("t"), F.round("alt_ft", 4).alias("alt_ft"), F.round("gs", 4).alias("gs"))


@query(f"""with {WAYS}, nx as (select w.*, lead(wp) over v as nw, lead(t) over v as nt, lead(code) over v as nc from ways w window v as (partition by hex, day, seg order by wp))
select hex, day, seg, code || '_' || nc as part, round((b.at_nm - a.at_nm) / (nt - t) * 3600, 1) as gs from nx join wps a using (wp, code) join wps b on b.wp = nw where nw = nx.wp + 1 and nt > t""")
def corridor_seg_speed(spark, d):
    return corridor.segment_speeds(_ways(spark, d))


def _spacing_sql(code: str) -> str:
    return f"""sp as (select hex, day, seg, round(t, 1) as t, round(gs, 1) as gs from ways where code = '{code}'),
sl as (select *, lag(t) over v as t0, lag(gs) over v as lead_gs, lag(hex) over v as lead_hex from sp window v as (partition by day order by t, hex, seg)),
gaps as (select hex, day, seg, round(t - t0, 1) as gap_s, round((t - t0) * (gs + lead_gs) / 2 / 3600, 3) as gap_nm, lead_hex, lead_gs from sl where t0 is not null)"""


@query(f"with {WAYS}, {_spacing_sql('FISK')} select * from gaps")
def corridor_spacing(spark, d):
    return corridor.spacing(_ways(spark, d), "FISK")


@query(f"""with {WAYS}, ab as (select hex, day, seg, max(case when code = 'RIPON' then round(t, 1) end) as a, max(case when code = 'FISK' then round(t, 1) end) as b from ways group by 1, 2, 3),
st as (select a as t, 1 as dl from ab where a is not null and b is not null union all select b, -1 from ab where a is not null and b is not null),
lv as (select t, cast(sum(dl) over (order by t, dl desc rows unbounded preceding) as bigint) as level from st)
select max(level) as peak, (select min(t) from lv where level = (select max(level) from lv)) as peak_t from lv""")
def corridor_peak_concurrency(spark, d):
    return corridor.peak_concurrency(_ways(spark, d), "RIPON", "FISK")


@query(f"""with {CORRIDOR}, v as (select case when gs = 190 then 29 else cast(floor((gs - 40) / 5) as int) end as bin from inside where gs between 40 and 190)
select cast(r.range as int) as bin, cast(40 + r.range * 5.0 as double) as edge, count(v.bin) as n from range(30) r left join v on v.bin = r.range group by r.range""")
def corridor_histograms(spark, d):
    return corridor.histogram(corridor.in_corridor(pts(spark, d)), "gs", 40.0, 190.0, 30)


_BINS = math.ceil(max(C.waypoint_nm.values()))


@query(f"""with {TRANSITS}, b as (select least(greatest(cast(trunc(along) as int), 0), {_BINS - 1}) as bin, gs, alt_ft from tp)
select bin, bin + cast(0.5 as double) as centre, count(*) as n, {', '.join(f"case when count(*) >= 3 then round(quantile_cont({c}, {q}), {r}) end as {n}_{s}" for c, n, r in (('gs', 'gs', 1), ('alt_ft', 'alt', 0)) for q, s in ((0.25, 'p25'), (0.5, 'median'), (0.75, 'p75')))}
from b group by bin""")
def corridor_profile(spark, d):
    return corridor.along_profile(corridor.transit_points(pts(spark, d)))


@query(f"""with {WAYS}, f as (select round(alt_ft, 0) as alt, gs from ways where code = 'FISK')
select count(*) as n, round(avg(case when abs(alt - 1800) <= 200 then 1.0 else 0.0 end) * 100, 4) as pct_low, round(avg(case when abs(alt - 2300) <= 200 then 1.0 else 0.0 end) * 100, 4) as pct_high,
  round(avg(case when abs(alt - 1800) <= 200 or abs(alt - 2300) <= 200 then 1.0 else 0.0 end) * 100, 4) as pct_either, round(quantile_cont(gs, 0.5), 4) as median_gs from f""")
def corridor_on_profile_pct(spark, d):
    return corridor.on_profile(_ways(spark, d))


@query(f"""with {WAYS}, lab as (select w.*, n_name as type from ways w join customer on c_custkey = hex join nation on n_nationkey = c_nationkey),
g as (select type, count(*) filter (where code = 'FISK') as n_fisk, round(avg(gs) filter (where code = 'FISK'), 1) as fisk_avg, round(min(gs) filter (where code = 'FISK'), 1) as fisk_min,
  round(max(gs) filter (where code = 'FISK'), 1) as fisk_max, round(avg(gs) filter (where code = 'RIPON'), 1) as ripon_avg from lab group by type)
select * from g where n_fisk >= 5""")
def corridor_type_stats(spark, d):
    types = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("hex"), F.col("n_name").alias("type"))
    at = lambda f, c: F.round(f(F.when(F.col("code") == c, F.col("gs"))), 1)
    rows = _ways(spark, d).join(types, "hex").groupBy("type").agg(
        F.count_if(F.col("code") == "FISK").alias("n_fisk"), at(F.avg, "FISK").alias("fisk_avg"), at(F.min, "FISK").alias("fisk_min"), at(F.max, "FISK").alias("fisk_max"), at(F.avg, "RIPON").alias("ripon_avg"),
    )
    return rows.where("n_fisk >= 5").orderBy(F.desc("fisk_avg"), "type")


@query(f"with {TRANSITS}, t as (select day, count(distinct (hex, seg)) as n from tp group by day) select day, n from t order by n desc, day limit 1")
def corridor_busiest_day(spark, d):
    runs = corridor.transit_points(pts(spark, d)).select("day", "hex", "seg").distinct()
    return runs.groupBy("day").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "day").limit(1)


@query(f"""with {WAYS}, {_spacing_sql('FISK')} select hex, gap_nm, lead_gs from (select *, row_number() over (partition by hex order by gap_nm, day, seg) as r from gaps where lead_gs < 120 and gap_nm < 3)
where r = 1 order by gap_nm, hex limit 3""")
def corridor_examples(spark, d):
    gaps = corridor.spacing(_ways(spark, d), "FISK").where("lead_gs < 120 and gap_nm < 3")
    w = Window.partitionBy("hex").orderBy("gap_nm", "day", "seg")
    return gaps.withColumn("r", F.row_number().over(w)).where("r = 1").orderBy("gap_nm", "hex").limit(3).select("hex", "gap_nm", "lead_gs")


@query(f"""with {TRANSITS}, s as (select hex * 1000 + seg as id, day, min(ts) as a, max(ts) as b from tp group by hex, day, seg)
select x.day, x.id, y.id as other from s x join s y on x.day = y.day and x.id <> y.id and x.a < y.b and x.b > y.a""")
def transit_overlaps(spark, d):
    spans = corridor.transit_points(pts(spark, d)).groupBy("hex", "day", "seg").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return tracks.overlaps(spans.select((F.col("hex") * 1000 + F.col("seg")).alias("id"), "day", "a", "b"), "day")


@query(f"""with {TRANSITS}, l as (select *, lead(ts) over w as ts2, lead(along) over w as along2 from tp window w as (partition by day, hex, seg order by ts)),
m as (select o.day, o.hex, o.seg, o.ts, b.along + (b.along2 - b.along) * (o.ts - b.ts) / (b.ts2 - b.ts) - o.along as diff, b.hex as o_hex, b.seg as o_seg
  from tp o join l b on o.day = b.day and (o.hex <> b.hex or o.seg <> b.seg) and o.ts >= b.ts and o.ts < b.ts2)
select day, hex, seg, ts, round(min(case when diff > 0 then diff end), 6) as ahead_nm, round(min(case when diff < 0 then -diff end), 6) as behind_nm,
  (arg_min(o_hex, {{'d': diff, 'h': o_hex, 's': o_seg}}) filter (where diff > 0))::bigint as ahead_hex, (arg_min(o_hex, {{'d': -diff, 'h': o_hex, 's': o_seg}}) filter (where diff < 0))::bigint as behind_hex,
  count(*) as n_near from m group by 1, 2, 3, 4""")
def follow_neighbours(spark, d):
    found = tracks.followers(corridor.transit_points(pts(spark, d)), ["hex", "seg"])
    return found.select("day", "id.hex", "id.seg", "ts", F.round("ahead_nm", 6).alias("ahead_nm"), F.round("behind_nm", 6).alias("behind_nm"), F.col("ahead.hex").cast("long").alias("ahead_hex"), F.col("behind.hex").cast("long").alias("behind_hex"), "n_near")


@query(f"""with {PTS}, q as (select hex, min(ts) + 1000 as q from pts group by hex), l as (select *, lead(ts) over w as ts2, lead(lat) over w as lat2, lead(alt_ft) over w as alt2 from pts window w as (partition by hex order by ts))
select l.hex, q, round(case when ts2 is null then lat else lat + (lat2 - lat) * ((q - ts) / (ts2 - ts)) end, 9) as lat,
  round(case when ts2 is null then alt_ft else alt_ft + (alt2 - alt_ft) * ((q - ts) / (ts2 - ts)) end, 6) as alt_ft from l join q on l.hex = q.hex and q >= ts and (q < ts2 or (ts2 is null and q = ts))""")
def interpolate_at_time(spark, d):
    points = pts(spark, d)
    q = points.groupBy("hex").agg((F.min("ts") + 1000).alias("q"))
    got = tracks.at_times(points, ["hex"], "ts", ["lat", "alt_ft"], q, "q")
    return got.select("hex", "q", F.round("lat", 9).alias("lat"), F.round("alt_ft", 6).alias("alt_ft"))


@query(f"with {LEGS}, g as (select cast(1784160000 + range * 600 as double) as t from range(60)) select t, count(hex) as n from g left join legs on t between t_start and t_end group by t")
def stab_counts(spark, d):
    return tracks.stab_counts(segments.legs(pts(spark, d)), 1784160000, 600, 60)


@query("select c_custkey, c_name from customer where length('00') >= 2 and contains(lower(c_name), '00') order by c_custkey limit 40")
def search_entities(spark, d):
    found = table(spark, d, "customer").where(F.lower("c_name").contains("00")).select("c_custkey", "c_name")
    return found.orderBy("c_custkey").limit(40)


@query("select count(*) as n from customer where not regexp_matches(c_mktsegment, '^[bB]')")
def prefix_filter(spark, d):
    return table(spark, d, "customer").where(~F.col("c_mktsegment").rlike("(?i)^B")).agg(F.count("*").alias("n"))


@query("select p_brand, count(*) as n from part where contains(upper(p_brand), 'A') group by 1 order by n desc, p_brand limit 15 offset 5")
def type_grid_page(spark, d):
    rows = table(spark, d, "part").where(F.upper("p_brand").contains("A")).groupBy("p_brand").agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "p_brand").offset(5).limit(15)


@query(f"with {LEGS} select hex, leg_idx, t_start - lag(t_end) over w as gap_s, (t_start - lag(t_end) over w) > 3600 as is_long from legs window w as (partition by hex order by leg_idx) qualify lag(t_end) over w is not null")
def gap_connectors(spark, d):
    w = Window.partitionBy("hex").orderBy("leg_idx")
    rows = segments.legs(pts(spark, d)).select("hex", "leg_idx", (F.col("t_start") - F.lag("t_end").over(w)).alias("gap_s"))
    return rows.where("gap_s is not null").withColumn("is_long", F.col("gap_s") > 3600)


@query(f"with {LEGS} select hex, leg_idx, n_points, cast(coalesce(sum(n_points) over (partition by hex order by leg_idx rows between unbounded preceding and 1 preceding), 0) as bigint) as start from legs")
def prefix_offsets(spark, d):
    w = Window.partitionBy("hex").orderBy("leg_idx").rowsBetween(Window.unboundedPreceding, -1)
    return segments.legs(pts(spark, d)).select("hex", "leg_idx", F.col("n_points").cast("long").alias("n_points"), F.coalesce(F.sum("n_points").over(w), F.lit(0)).alias("start"))


@query(f"with {CHAIN} select hex, min(path_nm) as least_nm, max(path_nm) as most_nm, sum(path_nm) as nm, sum(t_end - t_start) as s from chain group by hex")
def card_totals(spark, d):
    return chain(spark, d).groupBy("hex").agg(F.min("path_nm").alias("least_nm"), F.max("path_nm").alias("most_nm"), F.sum("path_nm").alias("nm"), F.sum(F.col("t_end") - F.col("t_start")).alias("s"))


@query("select n_name as label, count(*) as n, count(distinct c_mktsegment) as segments, arg_max(c_name, c_custkey) as last_name from customer join nation on c_nationkey = n_nationkey group by 1")
def label_counts(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("label")).agg(F.count("*").alias("n"), F.count_distinct("c_mktsegment").alias("segments"), F.max_by("c_name", "c_custkey").alias("last_name"))


@query("select strftime(ts, '%Y-%m-%d') as day, min(value) as low, max(value) as high from events group by 1")
def day_bounds(spark, d):
    return table(spark, d, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.min("value").alias("low"), F.max("value").alias("high"))


_CRAFT = "select c_custkey as hex, case when c_custkey % 7 = 0 then 'N' else 'c-' end || cast(c_custkey as varchar) as reg, case when c_custkey % 31 = 3 then 'T' || cast(c_custkey as varchar) else c_mktsegment end as label from customer"


@query(f"""with {_journey_sql('inbound')}, craft as ({_CRAFT}), best as (select i.hex, total_nm as nm, t_start as first, reg, label from inbound i join craft using (hex)),
alone as (select label from best group by label having count(*) = 1),
pick as (select 1 as rank, hex, nm from (select * from best where nm < 600 order by nm desc, first, hex limit 4) union all select 2, hex, nm from (select * from best where hex % 10 = 1 order by first, hex limit 3)
  union all select 3, hex, nm from (select * from best where not regexp_matches(reg, '^[Nn]') order by first, hex limit 4) union all select 4, hex, nm from (select * from best where label in (select label from alone) order by first, hex limit 3))
select hex, min(rank) as rank, min(nm) as nm from pick group by hex""")
def guided_tour(spark, d):
    craft = table(spark, d, "customer").selectExpr(
        "c_custkey as hex", "concat(if(c_custkey % 7 = 0, 'N', 'c-'), c_custkey) as reg", "if(c_custkey % 31 = 3, concat('T', c_custkey), c_mktsegment) as label"
    )
    # Inbound journeys are one an entity, so each is its entity's longest and first.
    rows = journeys.journeys(chain(spark, d), "inbound", ORDERS).select("hex", F.col("total_nm").alias("nm"), F.col("t_start").alias("first")).join(craft, "hex")
    return reports.guided_tour(rows.withColumn("military", F.col("hex") % 10 == 1), 600.0)


@query("select event_id, epoch_us(ts) // 300000000 * 300 as bucket, strftime(ts, '%a %b ') || cast(day(ts) as varchar) as label from events")
def time_buckets(spark, d):
    return table(spark, d, "events").select("event_id", F.expr("bigint(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)) div 300 * 300").alias("bucket"), F.date_format("ts", "EEE MMM d").alias("label"))


@query(f"""with {WAYS}, {_spacing_sql('FISK')}, near as (select * from gaps where gap_nm < 15), p as (select quantile_cont(gap_nm, 0.98) as p98 from near)
select hex, day, seg, gap_nm, lead_gs, lead_hex from near, p where gap_nm <= p98""")
def corridor_gap_scatter(spark, d):
    near = corridor.spacing(_ways(spark, d), "FISK").where("gap_nm < 15")
    p98 = near.agg(F.percentile("gap_nm", F.lit(0.98)).alias("p98"))
    return near.join(F.broadcast(p98), F.col("gap_nm") <= F.col("p98")).select("hex", "day", "seg", "gap_nm", "lead_gs", "lead_hex")


@query(f"""with {TRANSITS}, s as (select day, hex, seg, min(ts) as a from tp group by 1, 2, 3),
o as (select t.*, a from tp t join s using (day, hex, seg)) select hex, day, seg, list_aggregate(list(round(ts - a, 1) order by ts), 'max') as last_t, count(*) as n_pts from o group by hex, day, seg""")
def corridor_point_series(spark, d):
    rows = corridor.transit_points(pts(spark, d))
    point = F.struct("ts", "lon", "lat", "along", "cross", "alt_ft", "gs")
    series = rows.groupBy("hex", "day", "seg").agg(F.sort_array(F.collect_list(point)).alias("p"))
    times = F.transform("p", lambda q: F.round(q["ts"] - F.get("p", F.lit(0))["ts"], 1))
    return series.select("hex", "day", "seg", F.array_max(times).alias("last_t"), F.size("p").alias("n_pts"))


SUN = """t as (select distinct floor(epoch(ts) / 21600) * 21600 as t from events), a as (select t, t / 86400 + 2440587.5 - 2451545.0 as d from t),
b as (select t, d, radians(fmod(fmod(cast(357.528 as double) + d * cast(0.9856003 as double), 360) + 360, 360)) as g from a),
c as (select t, d, radians(fmod(fmod(280.46 + d * cast(0.9856474 as double), 360) + 360, 360) + 1.915 * sin(g) + 0.02 * sin(2 * g)) as l, radians(23.439 - d * 0.0000004) as e from b),
f as (select t, degrees(asin(sin(e) * sin(l))) as la, degrees(atan2(cos(e) * sin(l), cos(l))) as ra, fmod(fmod(cast(280.46061837 as double) + d * cast(360.98564736629 as double), 360) + 360, 360) as st from c),
sun as (select t, la, fmod(fmod(ra - st + 180, 360) + 360, 360) - 180 as lo from f)"""


@query(f"with {SUN} select t, round(la, 4) as lat, round(lo, 4) as lon from sun")
def subsolar_points(spark, d):
    return _sun(spark, d).select("t", F.round("s.lat", 4).alias("lat"), F.round("s.lon", 4).alias("lon"))


def _sun(spark, d) -> DataFrame:
    """Every six hours in which there are events."""
    times = table(spark, d, "events").select((F.floor(F.expr(epoch("ts")) / 21600) * 21600).cast("double").alias("t")).distinct()
    return times.withColumn("s", geo.subsolar(F.col("t")))


@query(f"""with {SUN} select t, cast(x as double) as lon, round(greatest(least(degrees(atan(-cos(radians(x - lo)) / tan(radians(la)))), 89.9), -89.9), 3) as lat
from sun, (select -180 + range * 3 as x from range(121)) union all select t, x, case when la >= 0 then -90.0 else 90.0 end from sun, (values (180.0), (-180.0)) v(x)""")
def night_rings(spark, d):
    rings = _sun(spark, d).select("t", F.explode(geo.night_ring(F.col("s.lat"), F.col("s.lon"))).alias("p"))
    return rings.select("t", "p.lon", F.round("p.lat", 3).alias("lat"))


def _downsample_sql(most: int, share: bool) -> str:
    """The rule point by point: a recursive walk along each segment, then the ranks that stay."""
    cap = f"case when n > {most} and k > 4 then least(k, greatest(4, cast(floor(k * {num(most)} / n) as bigint))) else k end" if share else f"least(k, {most})"
    return f"""with recursive {PTS}, {_cut('pts', 'seg0')},
p as (select hex, seg, ts, track, {flat(f'lat - {num(C.anchor_lat)}', f'lon - {num(C.anchor_lon)}')} <= {num(C.near_nm)} as near,
  row_number() over (partition by hex, seg order by ts) as i, count(*) over (partition by hex, seg) as m from seg0),
walk as (select hex, seg, i, ts, ts as last_ts, track as head, true as kept from p where i = 1
  union all select hex, seg, i, ts, case when due then ts else last_ts end, case when due then track else head end, due from (
    select p.hex, p.seg, p.i, p.ts, p.track, w.last_ts, w.head, (p.i = p.m or p.ts - w.last_ts >= case when p.near then 15 else 60 end
      or abs((p.track - w.head + 540) - 360 * floor((p.track - w.head + 540) / 360) - 180) >= 12) as due
    from walk w join p on p.hex = w.hex and p.seg = w.seg and p.i = w.i + 1)),
held as (select hex, seg, ts, count(*) over (partition by hex, seg) as k, count(*) over (partition by hex) as n, row_number() over (partition by hex, seg order by ts) - 1 as r from walk where kept),
capped as (select *, {cap} as cap from held)
select hex, seg, ts from capped c where cap = k or r = k - 1 or exists (select 1 from range({most}) j where j.range < c.cap and cast(floor(j.range * ((c.k - 1) / cast(nullif(c.cap - 1, 0) as double))) as bigint) = c.r)"""


@query(_downsample_sql(40, False))
def downsample_capped(spark, d):
    return tracks.downsample(segments.with_segments(pts(spark, d)), 40)


@query(_downsample_sql(60, True))
def downsample_budget(spark, d):
    return tracks.downsample(segments.with_segments(pts(spark, d)), 60, share=True)
