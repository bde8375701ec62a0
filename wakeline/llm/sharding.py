"""Operator 8, sharding by histogram sort.

Rows are ordered by a key of 32 hexadecimal digits: a hash of the text, then
a hash of text and doc_id. The shards' splitters are places in that order
with near equal bytes between them. They are found by counting: each round
sums exact bytes under candidate boundaries (all ways to extend the prefixes
that still hold an unmet target by three digits) over all partitions, and
keeps refining where no boundary lies within tolerance. Then rows are
exchanged once. Equal texts share the first half of the key, so they stay
together unless their group alone is too heavy to meet the tolerance; then
the second half, which tells its rows apart, splits it.

The driver sees at most ``16**3`` counts for each splitter a round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import cut_lineage, documents, text_or_empty, without

SHARDS = 16
TOLERANCE = 0.002
DIGITS = 3
KEY_DIGITS = 32
GROUP_ROWS = 100_000


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def _probe(keys: DataFrame, prefixes: list[str], length: int) -> dict[str, list[tuple[str, int]]]:
    """Bytes below each extension of the prefixes, which have ``length`` digits, in key order."""
    longer = F.substring("_key", 1, length + DIGITS).alias("bucket")
    held = keys if not length else keys.where(F.substring("_key", 1, length).isin(prefixes))
    counts = held.groupBy(longer).agg(F.sum("_size").alias("bytes")).collect()
    found: dict[str, list[tuple[str, int]]] = {}
    for row in sorted(counts):
        found.setdefault(row["bucket"][:length], []).append((row["bucket"], row["bytes"]))
    return found


def splitters(keys: DataFrame, total: int, shards: int, tolerance: float) -> list[str]:
    """Ascending boundaries of ``shards`` runs of (_key, _size) with near equal bytes.

    A key lies in the run numbered by the boundaries not above it. Rounds end
    once each boundary has its target within ``tolerance`` shards, or when
    the key has no more digits.
    """
    chosen: dict[int, str] = {}
    open_at = {j: ("", 0) for j in range(1, shards)}  # target -> prefix, bytes below the prefix
    length = 0
    while open_at:
        buckets = _probe(keys, sorted({p for p, _ in open_at.values()}), length)
        length += DIGITS
        refine = {}
        for j, (prefix, below) in open_at.items():
            target = total * j / shards
            for bucket, size in buckets[prefix]:
                if below + size >= target:
                    break
                below += size
            # '~' sorts after every digit: the boundary behind the whole bucket
            error, edge = min((target - below, bucket), (below + size - target, bucket + "~"))
            if error <= tolerance * total / shards or length >= KEY_DIGITS:
                chosen[j] = edge
            else:
                refine[j] = (bucket, below)
        open_at = refine
    return sorted(chosen.values())


def shard(df: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``df`` with size, text_crc32, law, shard, slot and grown_shard (law ``bytes``).

    size is the text's UTF-8 bytes plus 1, a null text counting as empty. slot
    numbers a shard's rows from 0 without gaps, by a hash group and doc_id
    (nulls first) within it. Rows that agree in text and doc_id can't be told
    apart and share a shard. Columns of ``df`` with the new names are
    replaced; an empty table gives no rows.
    """
    text = text_or_empty()
    row_hash = F.xxhash64(text, F.col("doc_id"))
    base = without(df, "size", "text_crc32", "law", "shard", "slot", "grown_shard", "_key", "_size", "_part", "_group", "_before")
    named = base.select(
        "*",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(_hex(F.xxhash64(text)), _hex(row_hash)).alias("_key"),
        row_hash.alias("_part"),
    )
    keys = cut_lineage(named.select("_key", F.col("size").alias("_size"), "_part"))
    rows, total = keys.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    bounds = splitters(keys, total, shards, tolerance) if rows else []
    bits = max(4, math.ceil(math.log2(max(1, rows) / shards / GROUP_ROWS)))

    places = F.array(*[F.lit(b) for b in bounds]) if bounds else F.expr("cast(array() as array<string>)")
    shard_of = F.size(F.filter(places, lambda b: b <= F.col("_key"))).cast("int")
    group_of = F.shiftrightunsigned("_part", 64 - bits)
    counts = keys.select(shard_of.alias("shard"), group_of.alias("_group")).groupBy("shard", "_group").count()
    earlier = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_group", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    dealt = named.select("*", shard_of.alias("shard"), group_of.alias("_group")).join(offsets, ["shard", "_group"])
    place = F.row_number().over(Window.partitionBy("shard", "_group").orderBy("doc_id", "_key"))
    placed = dealt.withColumn("slot", F.col("_before") + place - 1)
    return placed.select(
        *[F.col(f"`{c}`") for c in base.columns],
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
