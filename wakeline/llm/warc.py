"""Operator 9, WARC captures: reading records and resolving not-modified revisits.

A ``revisit`` record (HTTP 304) has no body; its body is that of an earlier
full response for the same page. Each revisit is joined as of its time with
the latest earlier full response of its canonical URL; the join counts only if the
validators agree (ETag by weak comparison, else Last-Modified), and the
answer is the stored response's headers with those that a 304 may update.

The as-of join is two windows instead of one per URL: rows are cut into time
buckets, a window looks back inside (url, bucket), and a second one over one
row for each (url, bucket) gives what the earlier buckets left. A URL with a third of
all captures is thus spread over its buckets. Bodies take no part: they are
fetched at the end by record number.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import without

#: Seconds of a time bucket.
BUCKET = 6 * 3600
#: Headers that a 304 may bring up to date; other headers of it are dropped. Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary", "age", "warning")
#: Query parameters that name no other page. Fixed values.
TRACKING = ("utm_[a-z]+", "ref", "fbclid", "gclid")

COLUMNS = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, body binary"


def canonical_url(url: Column) -> Column:
    """The key under which captures of a page meet.

    Scheme, a leading ``www.``, default ports, fragments, tracking parameters, a
    trailing slash and the order of parameters don't count; the host's case neither.
    Null stays null.
    """
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(whole, r"(?i)^[a-z][a-z0-9+.-]*://", "")
    address = F.substring_index(bare, "?", 1)
    query = F.when(F.instr(bare, "?") > 0, F.substring(bare, F.instr(bare, "?") + F.lit(1), F.length(bare))).otherwise("")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.substring_index(address, "/", 1)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(address, "^[^/]*", ""), "/+$", "")
    drop = "^(" + "|".join(TRACKING) + ")(=|$)"
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(drop)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


#: Bytes of a WARC file, packed or unpacked, that a task may hold; files are about 1 GB by convention.
LARGEST = 1 << 31


def _inflated(data: bytes) -> Iterator[bytes]:
    """The bytes of a plain file, or of the members of a gzip file one after the other, in pieces."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    rest = memoryview(data)
    while len(rest):
        member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        at = 0
        while not member.eof and at < len(rest):
            yield member.decompress(rest[at : at + (1 << 20)])
            at += 1 << 20
        rest = rest[min(at, len(rest)) - len(member.unused_data) :] if member.eof else rest[len(rest) :]
        while len(rest) and rest[0] == 0:  # padding between members
            rest = rest[1:]


def _fields(block: bytes) -> tuple[bytes, dict[str, str]]:
    """First line and header fields, names in lower case; a name that comes twice keeps its last value."""
    first, *lines = block.split(b"\n")
    pairs = (line.rstrip(b"\r").partition(b":") for line in lines)
    return first.rstrip(b"\r"), {k.decode("utf-8", "replace").strip().lower(): v.decode("utf-8", "replace").strip() for k, colon, v in pairs if colon}


def _split_head(data: bytes) -> tuple[bytes, bytes]:
    """A head and what follows the empty line that ends it."""
    end = re.search(rb"\r?\n\r?\n", data)
    return (data[: end.start()], data[end.end() :]) if end else (data, b"")


def parse_warc(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content block of each record of a WARC file of any version.

    A record's block is as long as its Content-Length says, whatever it holds.
    Bytes before a version line are passed over; a record that is cut off, or has no valid length, ends the file.
    """
    pieces, held = iter(pieces), bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while (head := re.search(rb"(?:^|\n)(WARC/\d+\.\d+\r?\n(?:[^\r\n]+\r?\n)*)\r?\n", bytes(held[:65_536]))) is None:
            if len(held) > 65_536 or not more():
                return
        _, fields = _fields(head.group(1))
        if not fields.get("content-length", "").isdigit():
            return
        start, size = head.end(), int(fields["content-length"])
        while len(held) < start + size:
            if not more():
                return
        yield fields, bytes(held[start : start + size])
        del held[: start + size]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records of WARC files (plain or gzip members, versions 1.0 and 1.1) as COLUMNS.

    Spark's binary reader finds and opens the files, so any store that Spark reads will
    do; a file is a task's unit and holds at most LARGEST bytes (a larger one fails).
    Blocks are cut by Content-Length and bodies are bytes, so no content can be taken for a border.
    Other kinds of records are left out. ``record_id`` is a hash of the
    WARC-Record-ID. Header names are lower-cased; a name that comes twice keeps
    its last value. A revisit's body is null; a file that is no WARC gives no rows.
    """
    names = "id string, url string, date string, kind string, status int, headers map<string,string>, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 4 + [pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for warc, block in parse_warc(_inflated(content.as_py())):
                    kind = warc.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    head, body = _split_head(block)
                    line, headers = _fields(head)
                    status = re.match(rb"HTTP/[0-9.]+ (\d{3})", line)
                    rows.append((warc.get("warc-record-id"), warc.get("warc-target-uri"), warc.get("warc-date"), kind, int(status.group(1)) if status else None, list(headers.items()), body if kind == "response" else None))
                    size += len(block)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[n.split()[0] for n in names.split(", ")])
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[n.split()[0] for n in names.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = F.when(F.col("length") < LARGEST, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("too large a WARC file: "), "path")).cast("binary"))
    got = files.select(small.alias("content")).mapInArrow(run, names)
    return got.select(
        F.xxhash64("id").alias("record_id"), "url", F.unix_timestamp(F.try_to_timestamp("date")).alias("ts"), "kind", "status", "headers", "body",
    )


def write_warc(captures: DataFrame, path: str) -> None:
    """Captures of COLUMNS as WARC 1.0 records, a folder of part files. Bodies must be UTF-8: Spark's text writer holds text."""
    warc_text(captures).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def warc_text(captures: DataFrame) -> DataFrame:
    """Records as WARC 1.0 text, one ``value`` each, but for the line end that closes a record."""
    fields = F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    head = F.array_join(F.transform(fields, lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")
    http = F.concat(F.lit("HTTP/1.1 "), F.coalesce(F.col("status").cast("string"), F.lit("200")), F.lit("\r\n"), head, F.lit("\r\n"), F.coalesce(F.col("body").cast("string"), F.lit("")))
    return captures.select(
        F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: "), "kind",
            F.lit("\r\nWARC-Record-ID: <urn:record:"), F.col("record_id").cast("string"),
            F.lit(">\r\nWARC-Target-URI: "), "url",
            F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.lit("\r\nContent-Length: "), F.octet_length(http).cast("string"),
            F.lit("\r\n\r\n"), http, F.lit("\r\n"),
        ).alias("value")
    )


def _opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(captures: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row for each revisit of ``captures`` (COLUMNS; other columns are ignored).

    Columns: record_id, url_key, ts, source_id (the latest response, status
    200, of the same canonical URL that is earlier; of several at one time the
    largest record_id), outcome, headers, body. A revisit at a response's own
    second is not later than it. outcome is ``resolved``,
    ``no_response`` (none earlier, or a null URL or time), ``mismatch`` (a
    validator present on both sides differs) or ``no_validator`` (neither side
    shares one). Only a resolved row has merged headers and a body. Repeated
    revisits are answered one for one; responses that share a record_id are one.
    Header names count in any case; of one name in two cases the last holds.
    """
    lower = F.transform(F.map_entries("headers"), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = lambda i: F.transform(F.slice("_h", i + 2, F.size("_h")), lambda e: e["key"])
    last = F.filter("_h", lambda e, i: ~F.array_contains(later(i), e["key"]))  # of one name in two cases
    captures = captures.withColumn("_h", lower).withColumn("headers", F.map_from_entries(last)).drop("_h")
    head = F.col("headers")
    rows = captures.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "status",
        head.alias("headers"), _opaque(head["etag"]).alias("etag"), head["last-modified"].alias("modified"),
    )
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("record_id").isNotNull()
    usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    # Everything a revisit needs of its response, but for the body; ordered by time, then number.
    offer = F.when(full, F.struct("ts", "record_id", "etag", "modified", "headers"))
    rows = rows.where(full | (F.col("kind") == "revisit"))
    rows = rows.withColumn("slot", F.floor(F.col("ts") / bucket)).withColumn("offer", offer)
    rows = rows.where(usable)
    lone = captures.where((F.col("kind") == "revisit") & (canonical_url(F.col("url")).isNull() | F.col("ts").isNull()))
    revisits_first = F.when(F.col("kind") == "revisit", 0).otherwise(1)  # a revisit is not later than a response of its own second
    so_far = Window.partitionBy("url_key", "slot").orderBy("ts", revisits_first, "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("near", F.last("offer", ignorenulls=True).over(so_far)).where(F.col("kind") == "revisit")
    inside = inside.select("record_id", "url_key", "ts", "slot", "headers", "etag", "modified", "near")
    lasts = rows.groupBy("url_key", "slot").agg(F.max_by("offer", F.when(F.col("offer").isNotNull(), F.struct("ts", "record_id"))).alias("last_offer"))
    buckets_before = Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = lasts.select("url_key", "slot", F.last("last_offer", ignorenulls=True).over(buckets_before).alias("far"))
    joined = inside.join(before, ["url_key", "slot"], "left").withColumn("source", F.coalesce("near", "far"))
    tags = F.col("etag").isNotNull() & F.col("source.etag").isNotNull()
    dates = F.col("modified").isNotNull() & F.col("source.modified").isNotNull()
    outcome = (
        F.when(F.col("source").isNull(), "no_response")
        .when(tags, F.when(F.col("etag") == F.col("source.etag"), "resolved").otherwise("mismatch"))
        .when(dates, F.when(F.col("modified") == F.col("source.modified"), "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    fresh = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED))
    old = F.map_filter("source.headers", lambda k, v: ~F.map_contains_key(fresh, k))
    joined = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    joined = joined.select(
        "record_id", "url_key", "ts", F.col("source.record_id").alias("source_id"), "outcome",
        F.when(resolved, F.map_concat(old, fresh)).alias("headers"),
        F.when(resolved, F.concat(F.lit("body "), F.col("source.record_id"))).otherwise(F.concat(F.lit("none "), F.coalesce("record_id", F.lit(0)))).alias("body_of"),
    )
    none = lone.select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), "ts", F.lit(None).cast("long").alias("source_id"),
        F.lit("no_response").alias("outcome"), F.lit(None).cast("map<string,string>").alias("headers"), F.concat(F.lit("none "), F.coalesce("record_id", F.lit(0))).alias("body_of"),
    )
    # Rows without a body have keys of their own, so that they don't all meet in one task.
    bodies = captures.where(full).groupBy(F.concat(F.lit("body "), F.col("record_id")).alias("body_of")).agg(F.max("body").alias("body"))
    return joined.unionByName(none).join(bodies, "body_of", "left").drop("body_of")


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages`` (page_id, url, html): a response for each, and a later revisit of its canonical URL.

    Page p is fetched in full p minutes after 2024-01-01 and asked for again
    (with another scheme, and a fragment) 12 hours and p mod 11 hours later. Every
    seventh revisit carries a stale entity tag, every fifth none but a date,
    and every 35th neither. A page without a page_id has captures without number and time.
    """
    base = without(pages, "etag", "modified", "at")
    base = base.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        (F.lit(1704067200) + F.col("page_id") * 60).cast("long").alias("at"),
    )
    base = base.withColumn("etag", F.concat(F.lit('"'), F.md5("html"), F.lit('"'))).withColumn("modified", F.concat(F.lit("day "), F.col("page_id").cast("string")))
    text = lambda *pairs: F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    page = F.col("page_id")
    response = base.select(
        (page * 2).alias("record_id"), "url", F.col("at").alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        text(("content-type", F.lit("text/html")), ("etag", F.col("etag")), ("last-modified", F.col("modified")), ("date", F.col("at").cast("string"))).alias("headers"),
        F.col("html").cast("binary").alias("body"),
    )
    later = (F.col("at") + 43200 + F.pmod("page_id", F.lit(11)) * 3600).cast("long")
    tag = F.when(page % 5 == 0, None).when(page % 7 == 0, '"stale"').otherwise(F.concat(F.lit("W/"), F.col("etag")))
    revisit = base.select(
        (page * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace(F.regexp_replace("url", "^https?:", "HTTP:"), "#.*$", ""), F.lit("#again")).alias("url"),
        later.alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        text(("content-type", F.lit("none")), ("etag", tag), ("last-modified", F.when(page % 35 == 0, None).otherwise(F.col("modified"))), ("date", later.cast("string"))).alias("headers"),
        F.lit(None).cast("binary").alias("body"),
    )
    return response.unionByName(revisit)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    captures = page_captures(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    found = resolve_revisits(captures)
    return found.select(
        (F.col("record_id") - 1).cast("long").alias("revisit_of"), "record_id", "url_key", "ts", "source_id", "outcome",
        F.col("headers")["date"].alias("header_date"), F.col("headers")["content-type"].alias("header_type"),
        F.md5("body").alias("body_md5"), F.when(F.col("headers").isNotNull(), F.size("headers")).otherwise(0).alias("n_headers"),
    )


#: A plain as-of rendering for DuckDB: the latest earlier response by ASOF over sorted keys.
OP9_SQL = r"""
with base as (
  select page_id, url, coalesce(html, '') as html, 1704067200 + page_id * 60 as fetched,
    md5(coalesce(html, '')) as tag, 'day ' || cast(page_id as varchar) as modified
  from pages
),
bare as (
  select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as rest from base
),
parts as (
  select *, split_part(rest, '?', 1) as address,
    case when instr(rest, '?') > 0 then substr(rest, instr(rest, '?') + 1) else '' end as query
  from bare
),
keyed as (
  select *,
    list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) as kept,
    regexp_replace(regexp_replace(lower(split_part(address, '/', 1)), ':(80|443)$', ''), '^www\.', '')
      || regexp_replace(regexp_replace(address, '^[^/]*', ''), '/+$', '') as place
  from parts
),
rows as (
  select *, place || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end as url_key,
    fetched + 43200 + (page_id % 11) * 3600 as later
  from keyed
),
picked as (
  select v.page_id, v.url_key, v.later, v.tag, v.modified,
    (select max(struct_pack(fetched := r.fetched, id := r.page_id)) from rows r where r.url_key = v.url_key and r.fetched < v.later) as s
  from rows v
),
judged as (
  select p.*, r.tag as r_tag, r.modified as r_modified, r.html as r_html,
    case when s is null then 'no_response'
      when p.page_id % 5 <> 0 then case when p.page_id % 7 <> 0 and p.tag = r.tag then 'resolved' else 'mismatch' end
      when p.page_id % 35 <> 0 then case when p.modified = r.modified then 'resolved' else 'mismatch' end
      else 'no_validator' end as outcome
  from picked p left join rows r on r.page_id = s.id
)
select page_id * 2 as revisit_of, page_id * 2 + 1 as record_id, url_key, cast(later as bigint) as ts, s.id * 2 as source_id, outcome,
  case when outcome = 'resolved' then cast(later as varchar) end as header_date,
  case when outcome = 'resolved' then 'text/html' end as header_type,
  case when outcome = 'resolved' then md5(r_html) end as body_md5,
  case when outcome = 'resolved' then 4 else 0 end as n_headers
from judged
"""
