"""Operator 11, mixing sources to target weights by Sainte-Laguë apportionment.

The mix is dealt in blocks of equal numbers of words. A source that has
``s`` blocks so far has the quotient ``target / (2 s + 1)``; blocks go one after another to the source with
the highest quotient, and runs of blocks are the shards, so each
shard has integer quotas of its own and together they stay as near to the targets as
blocks can. A source's blocks follow each other in a seeded order of its documents,
from the start again once all are used, so what a document gives follows from its place there.

Nothing is dealt block by block: the seats of a shard's edge that are in
doubt lie around each source's share of them, and only those are
ranked by quotient. Places in a source are summed within buckets of the seeded
order, so no source has to fit a task. Sources are few (a row each); their ranking is the only window over all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import cut_lineage, documents, text_or_empty

WEIGHTS = (5, 2, 1)
#: Words of the mix for each word of the input.
SHARE = 1.5
#: Times that a document may be taken.
REPEATS = 2
SHARDS = 16
SEED = 11
#: Words of the largest block; a block is a hundredth of the smallest target, or less.
BLOCK = 1_024
PARTS_OF_LEAST = 100
BUCKET_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """(key, missing, source_size) with cap, weight, target and the block of the mix.

    A source is at its cap if it would be above it even were all sources with
    fewer words by weight at theirs; the others share what is left by weight.
    """
    everything, named = Window.partitionBy(), Window.orderBy("missing", "key")
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(named) - 1) % len(weights) + 1))
    rows = rows.withColumns({"cap": F.col("source_size") * REPEATS, "mix": F.sum("source_size").over(everything) * F.lit(float(share)), "sources": F.count("*").over(everything)})
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "missing", "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("mix") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumns({"left": left, "open": F.sum("weight").over(rest)})
    rows = rows.withColumn("full", F.col("cap") * F.col("open") <= F.col("left") * F.col("weight"))
    free = F.when(~F.col("full"), F.struct("open", "left"))
    rows = rows.withColumn("free", F.max(free).over(everything))  # of the open sources the first has all others' weights
    rows = rows.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("free.left") * F.col("weight") / F.col("free.open")))
    least = F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything) / PARTS_OF_LEAST)
    rows = rows.withColumn("block", F.coalesce(F.least(F.greatest(least, F.lit(1)), F.lit(BLOCK)), F.lit(1)).cast("long"))
    return rows.select("key", "missing", "source_size", "cap", "target", "block", "mix", "sources")


def _quotas(targets: DataFrame, shards: int) -> DataFrame:
    """(key, missing, upto): for each source the blocks that it has before shards 0, 1, ... and after the last.

    The seats before a shard's edge are those with the highest quotients. A source's part of them is within two
    blocks for each source of its exact share, so lower seats are in and higher ones out without ranking.
    """
    rows = targets.withColumn("seats", F.floor(F.col("mix") / F.col("block")))
    rows = rows.withColumn("edge", F.explode(F.sequence(F.lit(0), F.lit(shards))))
    rows = rows.withColumn("wanted", F.ceil(F.col("seats") * F.col("edge") / shards))
    most = F.floor(F.col("cap") / F.col("block"))
    share = F.round(F.coalesce(F.try_divide(F.col("wanted") * F.col("target"), "mix"), F.lit(0.0))).cast("long")
    doubt = 2 * F.col("sources") + 2
    rows = rows.withColumns({"sure": F.least(F.greatest(share - doubt, F.lit(0)), most), "end": F.least(share + doubt, most)})
    by_edge = Window.partitionBy("edge")
    rows = rows.withColumn("to_rank", F.col("wanted") - F.sum("sure").over(by_edge))
    seats = rows.where("end > sure").withColumn("seat", F.explode(F.sequence(F.col("sure"), F.col("end") - 1)))
    ranked = seats.withColumn("rank", F.row_number().over(by_edge.orderBy(F.desc(F.col("target") / (2 * F.col("seat") + 1)), "missing", "key")))
    won = ranked.where(F.col("rank") <= F.col("to_rank")).groupBy("key", "missing", "edge").agg(F.count("*").alias("won"))
    got = rows.join(won, ["key", "missing", "edge"], "left").withColumn("got", F.col("sure") + F.coalesce("won", F.lit(0)))
    upto = F.transform(F.array_sort(F.collect_list(F.struct("edge", "got"))), lambda e: e["got"])
    return got.groupBy("key", "missing").agg(upto.alias("upto"))


def _overlap(start: Column, end: Column, upto: Column) -> Column:
    return F.greatest(F.least(end, upto) - start, F.lit(0))


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, block, taken, shard): words that the mix takes of each row.

    Sources are ordered by code point, null last, and ``weights`` repeat over
    them. ``shard`` is the one that gets the row's first word, null if none takes it. A null or empty text has size 0 and
    gives nothing; a source without words has target 0; an empty table gives no rows. A long text may be cut between blocks.
    Rows with one doc_id and one text share a bucket; they and null doc_ids have each a place of their own.
    Only doc_id, text and source are read.
    """
    text = text_or_empty()
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"))
    rows = df.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("key"), F.col("source").isNull().alias("missing"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), place.alias("place"), F.xxhash64(text).alias("tie"),
    )
    rows = cut_lineage(rows)
    digits = max(1, math.ceil(math.log(max(1, rows.count() / BUCKET_ROWS), 16)) + 1)
    # Rows without doc_id have one place; they are dealt by their text.
    bucket = F.when(F.col("doc_id").isNull(), F.concat(F.lit("~"), F.substring(F.lpad(F.hex("tie"), 16, "0"), 1, digits))).otherwise(F.substring("place", 1, digits))
    rows = rows.withColumn("bucket", bucket)
    sums = cut_lineage(rows.groupBy("key", "missing", "bucket").agg(F.sum("size").alias("words")))
    targets = cut_lineage(_targets(sums.groupBy("key", "missing").agg(F.sum("words").alias("source_size")), weights, share))
    facts = targets.join(_quotas(targets, shards), ["key", "missing"]).select("key", "missing", "source_size", "target", "block", "upto")
    earlier = Window.partitionBy("key", "missing").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words").join(facts, ["key", "missing"])
    own = Window.partitionBy("key", "missing", "bucket").orderBy("place", "doc_id", "tie", "size")
    start = F.col("before") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = rows.join(offsets, ["key", "missing", "bucket"]).withColumn("start", start)
    words = F.element_at("upto", -1) * F.col("block")
    rounds = F.coalesce(F.floor(F.try_divide(words, F.col("source_size"))), F.lit(0))
    taken = rounds * F.col("size") + _overlap(F.col("start"), F.col("start") + F.col("size"), words - rounds * F.col("source_size"))
    first = F.floor(F.col("start") / F.col("block"))
    shard = (F.size(F.filter("upto", lambda u: u <= first)) - 1).cast("int")
    placed = placed.withColumn("taken", taken.cast("long")).withColumn("shard", F.when(F.col("taken") > 0, shard))
    return placed.select("doc_id", F.when(~F.col("missing"), F.col("key")).alias("source"), "size", "source_size", "target", "block", "taken", "shard")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "shard")


#: The same mix with every seat of every source ranked by its quotient.
OP11_SQL = rf"""with r as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
  md5('{SEED}:' || cast(doc_id as varchar)) as place from documents),
s0 as (select source, sum(size)::bigint as source_size, list_extract([{', '.join(map(str, WEIGHTS))}], cast((row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1 as bigint)) as weight from r group by source),
s1 as (select *, source_size * {REPEATS} as cap, (sum(source_size) over ())::bigint * cast({SHARE} as double) as mix from s0),
s2 as (select *, mix - (coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::bigint as rest,
  (sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following))::bigint as free from s1),
s3 as (select *, cap * free <= rest * weight as is_full from s2),
s4 as (select *, max(case when not is_full then {{'free': free, 'rest': rest}} end) over () as o from s3),
s5 as (select *, case when is_full then cast(cap as double) else o.rest * weight / o.free end as target from s4),
s6 as (select *, cast(coalesce(least(greatest(floor(min(case when target > 0 then target end) over () / {PARTS_OF_LEAST}), 1), {BLOCK}), 1) as bigint) as block from s5),
seats as (select source, k.range as k, row_number() over (order by target / (2 * k.range + 1) desc, source nulls last) - 1 as rank, cast(floor(mix / block) as bigint) as n
  from s6, range(cast((select max(cap) from s6) as bigint)) k where k.range < cap // block),
won as (select source, k, cast(floor(rank * {SHARDS} / n) as int) as shard from seats where rank < n),
q as (select source, count(*) as blocks from won group by source),
p as (select r.*, sum(size) over (partition by source order by place, doc_id rows unbounded preceding) - size as a from r),
t as (select p.*, source_size, target, block, coalesce(blocks, 0) * block as words, coalesce(cast(floor(coalesce(blocks, 0) * block / nullif(source_size, 0)) as bigint), 0) as rounds
  from p join s6 on p.source is not distinct from s6.source left join q on p.source is not distinct from q.source),
u as (select *, cast(rounds * size + greatest(least(a + size, words - rounds * source_size) - a, 0) as bigint) as taken from t)
select doc_id, size, source_size, target, taken, case when taken > 0 then shard end as shard from u
left join won on u.source is not distinct from won.source and won.k = u.a // u.block"""
