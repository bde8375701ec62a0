"""Operator 10, document fingerprints by Order MinHash.

A text's character k-mers are numbered by occurrence (the third "the "
differs from the first). For each of ``FUNCTIONS`` hash functions the
``TUPLE`` smallest numbered k-mers are selected, put back into text order and
hashed together; the fingerprint is the list of those hashes. Moving text
about changes the order inside the tuples, so likeness (the share of equal
places) follows edit distance and not only the set of k-mers.

Texts are numbered and hashed with numpy inside the tasks. Spark deals the
documents out into ranges of doc_id, so that each document meets the one
after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_rows, documents, shuffle_partitions, text_or_empty

KMER = 6
FUNCTIONS = 32
TUPLE = 2
#: Elements of a block of the (functions x k-mers) table that is hashed at once.
BLOCK = 1 << 17
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)

_ODD = np.random.default_rng(20250101).integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def numbered_kmers(points: np.ndarray, k: int = KMER) -> np.ndarray:
    """A 64-bit hash for each k-mer of code points together with its occurrence number.

    A text shorter than k is one k-mer; an empty text has none.
    """
    if not len(points):
        return np.zeros(0, np.uint64)
    width = min(k, len(points))
    x = points.astype(np.uint64)
    n = len(x) - width + 1
    rolled = np.zeros(n, np.uint64)
    for i in range(width):
        rolled = (rolled + x[i : i + n] + np.uint64(1)) * _MIX
    base = _mixed(rolled)
    order = np.argsort(base, kind="stable")
    value = base[order]
    new = np.concatenate(([True], value[1:] != value[:-1]))
    if new.all():
        return base
    at = np.arange(n)
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    again = number > 0
    base[order[again]] = _mixed(base[order[again]] + number[again].astype(np.uint64) * _MIX)
    return base


def order_minhash(text: str) -> np.ndarray:
    """The fingerprint's FUNCTIONS hashes of 32 bits; zeros for an empty text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    base = numbered_kmers(points)
    n = len(base)
    if not n:
        return np.zeros(FUNCTIONS, np.uint32)
    take = min(TUPLE, n)
    places = np.empty((FUNCTIONS, take), np.int64)
    step = max(1, BLOCK // n)
    for f in range(0, FUNCTIONS, step):
        table = base[None, :] * _ODD[f : f + step, None]
        row = np.arange(len(table))
        for t in range(take):
            places[f : f + step, t] = table.argmin(axis=1)
            table[row, places[f : f + step, t]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    places.sort(axis=1)
    tuples = np.zeros(FUNCTIONS, np.uint64)
    for t in range(take):
        tuples = _mixed(tuples * _MIX + base[places[:, t]] + np.uint64(t + 1))
    return (tuples >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / FUNCTIONS


def _hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``after``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, head, doc_id, text), sorted: each row that is no head, with the row after it.

    A head is the copy of the next range's first row, at the end of a range.
    """
    held = None  # range, doc_id, text, fingerprint of the row that waits for the next
    for batch in batches:
        rows = []
        for part, head, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is None and head:
                continue
            print_ = order_minhash(text)
            if held is not None:
                _, last_id, last, last_print = held
                new = edited(last, text)
                new_print = order_minhash(new)
                rows.append((
                    last_id, len(last), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                    _hex(last_print), _hex(new_print), likeness(last_print, new_print), likeness(last_print, print_),
                ))
            held = None if head else (part, doc_id, text, print_)
        yield arrow_rows(rows, SCHEMA)


def fingerprint_edits(df: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text of ``df`` and of its edited text, columns as ``SCHEMA``.

    The next document is the next by (doc_id, hash of text), null doc_ids
    first; after the last comes the first; a lone document follows itself. A
    null text counts as empty; the likeness of two empty texts is 1. Rows are
    answered one for one, repeated ones too; other columns are ignored; an
    empty table gives no rows.
    """
    spark = df.sparkSession
    ranges = ranges or shuffle_partitions(spark)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)]) if ranges > 1 else F.array(F.lit(0.5))
    cuts = sorted(set(df.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * ranges)).first()[0] or []))
    places = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.expr("cast(array() as array<bigint>)")
    part = F.coalesce(F.size(F.filter(places, lambda c: c <= F.col("doc_id"))), F.lit(0))
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), 0).otherwise(part))
    # First row of each range that has rows; as many rows as ranges, so few that their ids are literals.
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")).alias("first")).collect()
    firsts.sort(key=lambda r: r["part"])
    before = {(r["first"]["doc_id"], r["first"]["tie"]): firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    heads = spark.createDataFrame([(d, t, p) for (d, t), p in before.items()], "hid long, htie long, hpart int")
    on = rows["doc_id"].eqNullSafe(heads["hid"]) & (rows["tie"] == heads["htie"])
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("head"))
    ahead = F.struct(F.col("hpart").alias("part"), F.lit(1).alias("head"))
    copies = F.when(F.col("hpart").isNull(), F.array(own)).otherwise(F.array(own, ahead))
    dealt = rows.join(F.broadcast(heads), on, "left").select(F.explode(copies).alias("c"), "doc_id", "tie", "text")
    dealt = dealt.select("c.part", "c.head", "doc_id", "text", "tie")
    dealt = dealt.repartition(ranges, "part").sortWithinPartitions("part", "head", F.col("doc_id").asc_nulls_first(), "tie")
    return dealt.select("part", "head", "doc_id", "text").mapInArrow(_walk, SCHEMA)


def op10_ordermin(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))
