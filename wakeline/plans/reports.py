"""Queries for labels, clocks, filters and small reports, each with plain SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT
from wakeline.functions import geo, labels
from wakeline.functions.rounding import round_half_even
from wakeline.operators import corridor, journeys, places, reports, segments, tracks
from wakeline.plans.adapters import CHAIN, PTS, chain, pts, table
from wakeline.plans.trajectory import LEGS, ORDERS, TRANSITS, WAYS, _cut, _journey_sql, _spacing_sql, _ways, num, query
from wakeline.sources import sinks
from wakeline.sources.traces import may_hold

C = DEFAULT
#: Documents that hold one word of each list, told before anything is parsed.
TOKENS = (["a", "the "], ["lorem", "er "])


@query("select doc_id from documents where (contains(text, 'a') or contains(text, 'the ')) and (contains(text, 'lorem') or contains(text, 'er '))")
def byte_prefilter(spark, d):
    return table(spark, d, "documents").where(may_hold(F.col("text"), *TOKENS)).select("doc_id")


#: Journeys of both directions; a CTE named both.
BOTH = f"both_ as (select * from (with {_journey_sql('inbound')} select * from inbound) union all by name select * from (with {_journey_sql('outbound')} select * from outbound))"


def _both(spark, d) -> DataFrame:
    legs = chain(spark, d)
    return journeys.journeys(legs, "inbound", ORDERS).unionByName(journeys.journeys(legs, "outbound", ORDERS))


_LOCAL = lambda t: f"strftime((make_timestamp(cast({t} * 1000000 as bigint)) at time zone 'UTC') at time zone 'America/Chicago', '%Y-%m-%d')"


@query(f"with {BOTH} select {_LOCAL('t_start')} as day, count(*) as n, sum(total_nm) as nm from both_ where direction = 'outbound' and {_LOCAL('t_start')} >= '1995-01-01' group by 1")
def journeys_by_direction(spark, d):
    day = labels.local_date(F.col("t_start")).cast("string")
    return _both(spark, d).where("direction = 'outbound'").groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.sum("total_nm").alias("nm")).where("day >= '1995-01-01'")


@query(f"with {TRANSITS}, t as (select hex, day, seg, count(*) as n_points from tp group by 1, 2, 3) select * from t where contains(cast(hex as varchar), '1') order by hex, day, seg limit 8")
def search_transits(spark, d):
    runs = corridor.transit_points(pts(spark, d)).groupBy("hex", "day", "seg").agg(F.count("*").alias("n_points"))
    return runs.where(F.col("hex").cast("string").contains("1")).orderBy("hex", "day", "seg").limit(8)


@query(f"with {PTS}, days as (select distinct day from pts) select day, row_number() over (order by day) - 1 as idx from days")
def distinct_days(spark, d):
    days = pts(spark, d).select("day").distinct()  # a row for each day: few
    return days.select("day", (F.row_number().over(Window.orderBy("day")) - 1).cast("long").alias("idx"))


@query(f"with {PTS} select hex, count(*) as n, min(ts) as first_ts from pts where day = 20650 group by hex")
def points_of_day(spark, d):
    return spark.sql("select hex, count(*) as n, min(ts) as first_ts from {points} where day = :day group by hex", args={"day": 20650}, points=pts(spark, d))


_TYPES = "select c_custkey as hex, nullif(c_mktsegment, 'BUILDING') as desc_, case when c_custkey % 4 = 0 then '' when c_custkey % 4 = 1 then null else 'T' || cast(c_nationkey as varchar) end as type_ from customer"


@query(f"""with t as ({_TYPES}) select hex, coalesce(desc_, type_) as long_first, coalesce(desc_, type_, '') as shown,
  case when type_ is not null and type_ <> '' then type_ when desc_ is not null and desc_ <> '' then desc_ else 'Unknown' end as short_first from t""")
def type_labels(spark, d):
    rows = table(spark, d, "customer").selectExpr(
        "c_custkey as hex", "nullif(c_mktsegment, 'BUILDING') as desc", "case when c_custkey % 4 = 0 then '' when c_custkey % 4 = 1 then null else concat('T', c_nationkey) end as type"
    )
    long_first = labels.long_type(F.col("desc"), F.col("type"))
    return rows.select("hex", long_first.alias("long_first"), F.coalesce(long_first, F.lit("")).alias("shown"), labels.short_type(F.col("type"), F.col("desc")).alias("short_first"))


@query("select event_id, (event_id % 16 & 1) <> 0 as military, (event_id % 16 & 2) <> 0 as new_leg from events")
def flag_bits(spark, d):
    flags = F.col("event_id") % 16
    return table(spark, d, "events").select("event_id", labels.military(flags).alias("military"), labels.new_leg(flags).alias("new_leg"))


@query(f"with {CHAIN} select cast(trunc(min(t_start)) as bigint) as t0, cast(trunc(max(t_end)) as bigint) as t1, count(distinct hex) as n_hex, count(*) as n_legs, sum(path_nm) as nm from chain")
def manifest(spark, d):
    return reports.manifest(chain(spark, d))


@query(f"with {CHAIN} select hex, leg_idx, t_start, row_number() over (order by t_start, hex, leg_idx) - 1 as id from chain")
def surrogate_ids(spark, d):
    return reports.numbered(chain(spark, d), "t_start", ["hex", "leg_idx"]).select("hex", "leg_idx", "t_start", "id")


@query(f"with {CHAIN}, m as (select trunc(min(t_start)) as t0 from chain) select hex, leg_idx, cast(t_start - t0 as bigint) as start_s, cast(t_end - t0 as bigint) as end_s from chain, m")
def shared_clock(spark, d):
    return reports.on_shared_clock(chain(spark, d)).select("hex", "leg_idx", "start_s", "end_s")


@query("""select o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%a %b ') || cast(day(o_orderdate + to_seconds(o_orderkey % 86400)) as varchar) || ', '
  || cast((hour(o_orderdate + to_seconds(o_orderkey % 86400)) + 11) % 12 + 1 as varchar) || strftime(o_orderdate + to_seconds(o_orderkey % 86400), ':%M %p') as label from orders""")
def clock_labels(spark, d):
    at = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    return table(spark, d, "orders").select("o_orderkey", labels.clock(at).alias("label"))


@query("""select event_id, cast(floor(value * 97 / 3600) as bigint) || 'h ' || cast(floor((value * 97 - 3600 * floor(value * 97 / 3600)) / 60 + 0.5) as bigint) || 'm' as hours,
  cast(floor(floor(value * 97 + 0.5) / 60) as bigint) || ':' || lpad(cast(cast(floor(value * 97 + 0.5) as bigint) % 60 as varchar), 2, '0') as minutes from events""")
def durations(spark, d):
    s = F.col("value") * 97
    return table(spark, d, "events").select("event_id", labels.hours(s).alias("hours"), labels.minutes(s).alias("minutes"))


@query("select strftime(day, '%Y-%m-%d') as day from (select unnest(generate_series((select cast(min(ts) as date) from events), (select cast(max(ts) as date) from events), interval 1 day)) as day)")
def day_list(spark, d):
    return reports.day_list(table(spark, d, "events"), "ts")


@query("select c_custkey, regexp_replace(lower(c_name || ' / ' || c_mktsegment), '[^a-z0-9]', '_', 'g') as name from customer")
def file_names(spark, d):
    return table(spark, d, "customer").select("c_custkey", labels.file_name(F.concat("c_name", F.lit(" / "), "c_mktsegment")).alias("name"))


@query(f"""with {BOTH}, x as (select direction, case when direction = 'inbound' then {_LOCAL('t_end')} else {_LOCAL('t_start')} end as day from both_)
select day, count(*) filter (where direction = 'inbound') as inbound, count(*) filter (where direction <> 'inbound') as outbound from x group by day""")
def daily_in_out(spark, d):
    return reports.daily_in_out(_both(spark, d))


#: Facts of places A, B and C from the regions, with a city; nothing is known of D.
PLACES = f"""places as (select chr(cast(65 + r_regionkey as int)) as ident, r_name as name, (select min(n_name) from nation where n_regionkey = r_regionkey) as city, 'R' || cast(r_regionkey as varchar) as iso_region,
  {num(C.anchor_lat)} + r_regionkey * 4 - 3 as lat, {num(C.anchor_lon)} + r_regionkey * 5 - 4 as lon from region where r_regionkey < 3)"""
CRAFT = """craft as (select c_custkey as hex, case when c_custkey % 9 <> 0 then c_name end as reg, case when c_custkey % 4 <> 0 then 'T' || cast(c_nationkey as varchar) end as type,
  nullif(c_mktsegment, 'BUILDING') as "desc" from customer where c_custkey % 11 <> 0)"""


def _places(spark, d) -> DataFrame:
    city = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.min("n_name").alias("city"))
    key = F.col("r_regionkey")
    rows = table(spark, d, "region").where(key < 3).join(city, "r_regionkey", "left")
    return rows.select(F.char(65 + key).alias("ident"), F.col("r_name").alias("name"), "city", F.concat(F.lit("R"), key.cast("string")).alias("iso_region"), (C.anchor_lat + key * 4 - 3).alias("lat"), (C.anchor_lon + key * 5 - 4).alias("lon"))


def _craft(spark, d) -> DataFrame:
    return table(spark, d, "customer").where("c_custkey % 11 <> 0").selectExpr(
        "c_custkey as hex", "if(c_custkey % 9 <> 0, c_name, null) as reg", "if(c_custkey % 4 <> 0, concat('T', c_nationkey), null) as type", "nullif(c_mktsegment, 'BUILDING') as desc"
    )


_BEARING = f"fmod(degrees(atan2((lon - {num(C.anchor_lon)}) * 60 * {num(C.cos_anchor)}, (lat - {num(C.anchor_lat)}) * 60)) + 360, 360)"
_NM = f"sqrt(pow((lat - {num(C.anchor_lat)}) * 60, 2) + pow((lon - {num(C.anchor_lon)}) * 60 * {num(C.cos_anchor)}, 2))"
REGIONED = f"""{BOTH}, {PLACES}, regioned as (select b.*, case when lat is null then 'Unknown' when {_NM} <= 100 then 'Local'
  else list_element(['Northeast', 'Southeast', 'Southwest', 'Northwest'], cast(floor({_BEARING} / 90) as int) + 1) end as region
  from both_ b left join places p on p.ident = case when direction = 'inbound' then origin else destination end)"""


def _regioned(spark, d) -> DataFrame:
    far = F.when(F.col("direction") == "inbound", F.col("origin")).otherwise(F.col("destination"))
    rows = _both(spark, d).withColumn("ident", far).join(F.broadcast(_places(spark, d).select("ident", "lat", "lon")), "ident", "left")  # three places
    return rows.withColumn("region", geo.region(F.col("lat"), F.col("lon"))).drop("ident", "lat", "lon")


@query(f"""with {REGIONED}, r(place, region) as (values {', '.join(f"({i}, '{r}')" for i, r in enumerate(reports.REGIONS))})
select cast(place as int) as place, region, count(*) filter (where direction = 'inbound') as inbound, count(*) filter (where direction = 'outbound') as outbound from r left join regioned using (region) group by all""")
def region_counts(spark, d):
    return reports.region_counts(_regioned(spark, d))


@query(f"with {BOTH}, {PLACES} select destination as ident, name, city, iso_region, count(*) as n from both_ left join places on ident = destination where direction = 'outbound' and destination <> 'A' group by all order by n desc, destination limit 12")
def top_k_destinations(spark, d):
    return reports.busiest_far_ends(_both(spark, d).where("direction = 'outbound'"), _places(spark, d), "destination", "A")


@query(f"""with {REGIONED}, {CRAFT}, day as (select case when direction = 'inbound' then {_LOCAL('t_end')} else {_LOCAL('t_start')} end as day from regioned)
select 'aircraft' as part, cast(count(distinct hex) as varchar) as value from regioned union all
select direction, cast(count(*) as varchar) from regioned group by 1 union all
select 'days', cast(count(distinct day) as varchar) from day union all
select 'region ' || region, cast(count(*) as varchar) from regioned group by 1 union all
select 'origins', string_agg(ident || ' ' || coalesce(name, '-') || ' ' || n, ';' order by n desc, ident) from (select origin as ident, name, count(*) as n from regioned left join places on ident = origin where direction = 'inbound' and origin <> 'A' group by all) union all
select 'types', string_agg(label || ' ' || n, ';' order by n desc, label) from (select coalesce("desc", type) as label, count(distinct hex) as n from craft where hex in (select hex from regioned) and coalesce("desc", type) is not null group by 1 order by n desc, 1 limit 12)""")
def statistics_document(spark, d):
    doc = reports.statistics_document(_regioned(spark, d), _places(spark, d), _craft(spark, d), "A")
    end = "ident string, name string, city string, iso_region string, n long"
    shape = f"totals struct<aircraft: long, inbound: long, outbound: long>, daily array<struct<day: string, inbound: long, outbound: long>>, regions array<struct<region: string, inbound: long, outbound: long>>, top_origins array<struct<{end}>>, top_dests array<struct<{end}>>, top_types array<struct<label: string, n: long>>"
    got = doc.select(F.from_json("doc", shape).alias("x")).select("x.*")
    pair = lambda k, v: F.struct(F.lit(k).alias("part") if isinstance(k, str) else k.alias("part"), v.cast("string").alias("value"))
    listed = lambda c, f: F.array_join(F.transform(c, f), ";")
    name = lambda x: F.concat_ws(" ", x["ident"], F.coalesce(x["name"], F.lit("-")), x["n"].cast("string"))
    parts = F.array(
        pair("aircraft", F.col("totals.aircraft")), pair("inbound", F.col("totals.inbound")), pair("outbound", F.col("totals.outbound")), pair("days", F.size("daily")),
        pair("origins", listed("top_origins", name)), pair("types", listed("top_types", lambda x: F.concat_ws(" ", x["label"], x["n"].cast("string")))),
    )
    regions = F.transform(F.filter("regions", lambda r: r["inbound"] + r["outbound"] > 0), lambda r: pair(F.concat(F.lit("region "), r["region"]), r["inbound"] + r["outbound"]))
    return got.select(F.explode(F.concat(parts, regions)).alias("p")).select("p.part", "p.value")


@query(f"with {WAYS}, v as (select case when alt_ft = 4000 then 39 else cast(floor(alt_ft / 100.0) as int) end as bin from ways where code = 'FISK' and alt_ft between 0 and 4000) select cast(r.range as int) as bin, cast(r.range * 100.0 as double) as edge, count(v.bin) as n from range(40) r left join v on v.bin = r.range group by r.range")
def altitude_histogram(spark, d):
    return corridor.histogram(_ways(spark, d).where("code = 'FISK'"), "alt_ft", 0.0, 4000.0, 40)


@query(f"with {WAYS}, v as (select case when gs = 190 then 29 else cast(floor((gs - 40) / 5) as int) end as bin from ways where code = 'FISK' and gs between 40 and 190) select cast(r.range as int) as bin, cast(40 + r.range * 5.0 as double) as edge, count(v.bin) as n from range(30) r left join v on v.bin = r.range group by r.range")
def crossing_speed_histogram(spark, d):
    return corridor.histogram(_ways(spark, d).where("code = 'FISK'"), "gs", 40.0, 190.0, 30)


@query(f"with {WAYS}, {_spacing_sql('FISK')} select count(*) as n_gaps, round(avg(case when gap_nm < 0.5 then 1.0 else 0.0 end) * 100, 4) as pct_short from gaps")
def short_gap_share(spark, d):
    return corridor.spacing(_ways(spark, d), "FISK").agg(F.count("*").alias("n_gaps"), F.round(F.avg((F.col("gap_nm") < 0.5).cast("double")) * 100, 4).alias("pct_short"))


@query(f"with {WAYS}, {_spacing_sql('RIPON')} select * from gaps")
def corridor_spacing_ripon(spark, d):
    return corridor.spacing(_ways(spark, d), "RIPON")


@query(f"with {WAYS}, {_spacing_sql('FISK')} select hex, day, seg, gap_nm, lead_gs from gaps where gap_nm <= 2 ")
def close_gaps_by_lead_speed(spark, d):
    near = corridor.spacing(_ways(spark, d), "FISK").where("gap_nm <= 2")
    return near.orderBy("lead_gs", "hex", "day", "seg").select("hex", "day", "seg", "gap_nm", "lead_gs")


_AT = ("GRN", "RIPON", "FISK")


@query(f"""with {WAYS}, lab as (select w.*, n_name as type from ways w join customer on c_custkey = hex join nation on n_nationkey = c_nationkey)
select type, {', '.join(f"count(*) filter (where code = '{c}') as {c.lower()}_n, " + ', '.join(f"round({f}(gs) filter (where code = '{c}'), 1) as {c.lower()}_{f}" for f in ('avg', 'min', 'max')) for c in _AT)}
from lab group by type having count(*) filter (where code = 'FISK') >= 5""")
def type_statistics(spark, d):
    types = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("hex"), F.col("n_name").alias("type"))
    return reports.type_statistics(_ways(spark, d).join(types, "hex"), _AT).where("fisk_n >= 5").orderBy(F.desc("fisk_avg"), "type")


@query(f"with {PTS} select hex, min(lat) as south, max(lat) as north, min(lon) as west, max(lon) as east, max(ts) - min(ts) as s from pts group by hex")
def bounding_boxes(spark, d):
    return reports.bounding_boxes(pts(spark, d))


@query(f"""with {PTS}, q as (select hex, min(ts) + 1010 as q from pts group by hex), l as (select *, lead(ts) over w as ts2, lead(lat) over w as lat2, lead(track) over w as track2 from pts window w as (partition by hex order by ts)),
m as (select l.*, q, (q - ts) / (ts2 - ts) as f, (track2 - track + 540) - 360 * floor((track2 - track + 540) / 360) - 180 as turn from l join q on l.hex = q.hex and q >= ts and q < ts2)
select hex, q, round(lat + (lat2 - lat) * f, 9) as lat, round((track + turn * f + 360) - 360 * floor((track + turn * f + 360) / 360), 6) as heading from m""")
def position_and_heading(spark, d):
    points = pts(spark, d)
    return tracks.headings_at(points, points.groupBy("hex").agg((F.min("ts") + 1010).alias("q"))).select("hex", "q", F.round("lat", 9).alias("lat"), F.round("heading", 6).alias("heading"))


_SCALED = "cast(value * 4611686018427387904 as hugeint)"  # by 2**62: exact for values of this size


def _rounded_sql(digits: int) -> str:
    """Half to even in whole numbers."""
    x = f"({_SCALED} * {10 ** digits})"
    low, rest = f"({x} // 4611686018427387904)", f"({x} % 4611686018427387904 * 2)"
    return f"cast({low} + case when {rest} > 4611686018427387904 or ({rest} = 4611686018427387904 and {low} % 2 = 1) then 1 else 0 end as double) / {10 ** digits}"


@query(f"select event_id, {_rounded_sql(1)} as one, {_rounded_sql(2)} as two, cast({_rounded_sql(0)} as bigint) as whole from events")
def rounded(spark, d):
    at = lambda digits: round_half_even(F.col("value"), digits)
    return table(spark, d, "events").select("event_id", at(1).alias("one"), at(2).alias("two"), at(0).cast("long").alias("whole"))


@query(f"""with {CHAIN}, {PLACES}, {CRAFT}, t as (select to_apt as ident, from_apt as other, 'arrival' as dir, hex, t_start, t_end from chain where to_apt is not null
  union all select from_apt, to_apt, 'departure', hex, t_start, t_end from chain where from_apt is not null),
n as (select t.*, reg, type, "desc", (row_number() over (partition by ident order by t_start, t_end, hex, dir) - 1) // 100 as part from t left join craft using (hex)),
c as (select ident, count(*) filter (where dir = 'arrival') as arrivals, count(*) filter (where dir = 'departure') as departures from t group by ident)
select ident, part, name, city, iso_region, lat, lon, arrivals, departures,
  string_agg(cast(hex as varchar) || ' ' || coalesce(reg, '-') || ' ' || coalesce(type, '-') || ' ' || coalesce("desc", '-') || ' ' || dir || ' ' || coalesce(other, '-') || ' ' || cast(cast(t_start as bigint) as varchar) || ' ' || cast(cast(t_end as bigint) as varchar), ';' order by t_start, t_end, hex, dir) as touches
  from n join c using (ident) left join places using (ident) group by all""")
def airport_documents(spark, d):
    docs = places.airport_documents(places.airport_parts(places.touches(chain(spark, d)), _places(spark, d), _craft(spark, d), 100))
    head = F.from_json("head", "ident string, name string, city string, iso_region string, lat double, lon double, arrivals long, departures long")
    touch = "array<struct<hex: string, reg: string, type: string, desc: string, dir: string, other: string, t_start: double, t_end: double>>"
    filled = lambda x: F.coalesce(x, F.lit("-"))
    text = lambda t: F.concat_ws(" ", t["hex"], filled(t["reg"]), filled(t["type"]), filled(t["desc"]), t["dir"], filled(t["other"]), t["t_start"].cast("long").cast("string"), t["t_end"].cast("long").cast("string"))
    got = docs.select("part", head.alias("h"), F.array_join(F.transform(F.from_json("items", touch), text), ";").alias("touches"))
    return got.select("h.ident", "part", "h.name", "h.city", "h.iso_region", "h.lat", "h.lon", "h.arrivals", "h.departures", "touches")


@query(f"""with {CHAIN}, {PLACES}, t as (select to_apt as ident, 1 as a from chain where to_apt is not null union all select from_apt, 0 from chain where from_apt is not null)
select ident, name, city, iso_region, lat, lon, sum(a)::bigint as arrivals, sum(1 - a)::bigint as departures from t left join places using (ident) group by all""")
def airport_list(spark, d):
    return places.airport_list(places.touches(chain(spark, d)), _places(spark, d))


_SEGMENTS = f"""{PTS}, {_cut('pts', 'cut')}, sizes as (select hex, seg, count(*) as n, min(ts) as t_start from cut group by hex, seg having count(*) >= 2),
offs as (select hex, seg, row_number() over (order by t_start, hex, seg) - 1 as segment, (coalesce(sum(n) over (order by t_start, hex, seg rows between unbounded preceding and 1 preceding), 0))::bigint as start, n from sizes)"""


@query(f"with {_SEGMENTS} select * from offs")
def packed_offsets(spark, d):
    return sinks.segment_offsets(segments.with_segments(pts(spark, d)))


@query(f"""with {_SEGMENTS} select start + row_number() over (partition by c.hex, c.seg order by ts, lon, lat) - 1 as pos, cast(cast(ts - 1784160000 as float) as double) as t, cast(cast(lon as float) as double) as lon, cast(cast(lat as float) as double) as lat
from cut c join offs o on o.hex = c.hex and o.seg = c.seg""")
def packed_points(spark, d):
    cut = segments.with_segments(pts(spark, d))
    rows = sinks.packed_rows(cut, sinks.segment_offsets(cut), 1784160000.0)
    return rows.select("pos", *[F.col(c).cast("double").alias(c) for c in ("t", "lon", "lat")])


@query(f"""with {TRANSITS}, q as (select day, min(ts) + 3000.5 as q from tp group by day),
l as (select *, lead(ts) over w as ts2, lead(alt_ft) over w as alt2, lead(gs) over w as gs2 from tp window w as (partition by day, hex, seg order by ts))
select day, q, hex, seg, round(coalesce(alt_ft + (alt2 - alt_ft) * ((q - ts) / (ts2 - ts)), case when q = ts then alt_ft end), 6) as alt_ft,
  round(coalesce(gs + (gs2 - gs) * ((q - ts) / (ts2 - ts)), case when q = ts then gs end), 6) as gs from l join q using (day) where q >= ts and (q < ts2 or (ts2 is null and q = ts))""")
def neighbours_at_instant(spark, d):
    points = corridor.transit_points(pts(spark, d))
    asked = points.groupBy("day").agg((F.min("ts") + 3000.5).alias("q"))
    got = tracks.neighbours_at(points, asked, ["hex", "seg"], ["alt_ft", "gs"])
    return got.select("day", "q", "hex", "seg", F.round("alt_ft", 6).alias("alt_ft"), F.round("gs", 6).alias("gs"))


@query(f"with {LEGS}, {CHAIN} select hex, leg_idx, n_points from legs where hex in (select hex from chain where to_apt = 'B' and path_nm > 240)")
def legs_of_selection(spark, d):
    chosen = places.touches(chain(spark, d).where("path_nm > 240")).where("ident = 'B' and dir = 'arrival'").select("hex")
    return segments.legs(pts(spark, d)).join(chosen, "hex", "left_semi").select("hex", "leg_idx", F.col("n_points").cast("long").alias("n_points"))
