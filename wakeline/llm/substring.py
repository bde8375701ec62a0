"""Operator 5, near-duplicate passages by compact windows.

A text is a sequence of hashed five-word shingles. Under one hash function,
the Cartesian tree of the sequence's hashes groups all subsequences by the
place of their minimum: the node at c with span [l, r) stands for every
subsequence inside the span that contains c, and they all have c's hash as
min-hash. Only nodes at least as long as the shortest passage matter; they are
the minima of all runs of PASSAGE shingles, about 2 n / PASSAGE of them, and are
found for many texts at once (``run_minima``). Two passages with similarity s share
a node's hash under each of FUNCTIONS functions with probability s.

Nodes meet on (function, min-hash). A node is linked with one other document
of its hash, never with all: with the first for half of the hashes, for the other half (those that few documents have) with one that a seeded order
picks. So documents that hold parts of a passage don't stand between it and its copies: another hash picks
another document. Blocks of documents are first
reduced inside the task that read them, so a passage that a third of all
documents share comes to the shuffle once for each block.

The first document of a hash may hold the shingle in another context. So the
nodes whose hash several documents have meet again on keys of their context,
and link with the first document of each: every run of PASSAGE shingles whose minima
are such nodes under all functions, whose first document surely holds it (so each exact
repeat is found, whatever the other documents hold), and, for edited passages,
the smallest and next-smallest shingle of a run under every function.

The links of two documents are then joined as intervals: a link counts where
another lies within PASSAGE of it in both texts, and the windows around the
links that count make up the intervals of the earlier document. Their shingles are
fetched, and the later document's passages are verified against each interval:
at least PASSAGE shingles long, with SIMILARITY of them in it.

Documents with equal texts need no search: all but the first repeat it whole. A passage
that a document holds twice is found in the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import cut_lineage, documents, own_names, shuffle_partitions, without

SHINGLE = 5
#: Shortest passage in words, and in shingles.
WORDS = 50
PASSAGE = WORDS - SHINGLE + 1
SIMILARITY = 0.8
FUNCTIONS = 4
#: Shingles whose windows are reduced together in a task.
BLOCK = 1 << 21
#: Longer texts are worked in overlapping parts of so many shingles.
PART = 1 << 22
#: Shingles of the earlier text on either side of a link that are fetched.
HALF = 64
#: Links of a block's contexts are thinned to one in so many places.
THIN = 16
#: A seeded order picks the partner of a key that so many rows have; of more it would find a given one too seldom, and the first serves them all.
FEW = 32
#: How far a copy's place may move against the original's between neighbouring matches within one text.
DRIFT = 24

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(50505).integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(int(_MIX), -1, 1 << 64))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_PLACES = np.uint64((1 << 24) - 1)
#: Kinds of links: 0 to FUNCTIONS - 1 a node of that function, then contexts, then a repeat within a document.
RUN, PAIR, OWN = FUNCTIONS, FUNCTIONS + 1, FUNCTIONS + 2


def shingles(text: str) -> np.ndarray:
    """A hash for each five-word shingle of a text, words by ASCII white space, A-Z lower-cased."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out ^ (out >> np.uint64(31))) * _MIX + w[k : k + n]
    return out


def function_hashes(base: np.ndarray, j: int) -> np.ndarray:
    h = base * _ODD[j]
    h ^= h >> np.uint64(32)
    return h


def minima_levels(hashes: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4 ... 32 hashes by their start, each with its place in the low 24 bits (first of equals)."""
    levels = [(hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)]
    while (size := 1 << len(levels)) <= PASSAGE:
        last = levels[-1]
        levels.append(np.minimum(last[: max(0, len(last) - size // 2)], last[size // 2 :]))
    return levels


def run_minima(levels: list[np.ndarray]) -> np.ndarray:
    """Place of the minimum of each run of PASSAGE hashes, by its start.

    The places are the Cartesian tree's nodes of at least PASSAGE; the starts
    that a place has are those of the shortest subsequences in the node's span.
    """
    last, size = levels[-1], 1 << (len(levels) - 1)
    n = len(levels[0]) - PASSAGE + 1
    return (np.minimum(last[:n], last[PASSAGE - size : PASSAGE - size + n]) & _PLACES).astype(np.int64)


def run_hashes(base: np.ndarray) -> np.ndarray:
    """A hash for each run of PASSAGE shingles, by its start."""
    n = len(base)
    up = np.cumprod(np.full(n, _MIX, np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(base * up)))
    out = (total[PASSAGE:] - total[: n - PASSAGE + 1]) * np.cumprod(np.full(n - PASSAGE + 1, _INVERSE, np.uint64))
    return (out ^ (out >> np.uint64(29))) * _MIX


class Block:
    """The shingles of several texts in a row, parts of long ones overlapping by PASSAGE - 1."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray]]) -> None:
        self.base = np.concatenate([p[2] for p in parts])
        sizes = [len(p[2]) for p in parts]
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.part = np.repeat(np.arange(len(parts)), sizes)
        self.doc = np.array([p[0] for p in parts], np.int64)[self.part]
        #: Each place's place in its text.
        self.place = np.arange(len(self.base)) - (self.starts - np.array([p[1] for p in parts]))[self.part]
        n = max(0, len(self.base) - PASSAGE + 1)
        #: Starts of runs that lie within one text.
        self.runs = np.flatnonzero(self.part[:n] == self.part[PASSAGE - 1 : PASSAGE - 1 + n])

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, place in the block and kind of each compact window."""
        keys, places, kinds = [], [], []
        if len(self.runs):
            for j in range(FUNCTIONS):
                at = run_minima(minima_levels(function_hashes(self.base, j)))[self.runs]
                at = np.unique(at[np.concatenate(([True], at[1:] != at[:-1]))])
                keys.append(self.base[at] ^ np.uint64(j))
                places.append(at)
                kinds.append(np.full(len(at), j))
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) if x else empty.astype(t) for x, t in ((keys, np.uint64), (places, np.int64), (kinds, np.int64)))

    def contexts(self, shared: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, place and kind of each context; ``shared[j]`` marks places that are shared nodes of function j.

        A run that another document repeats has shared nodes under all functions,
        so no other runs are taken.
        """
        runs = self.runs
        whole = np.ones(len(runs), bool)
        keys, places, kinds = [], [], []
        for j in range(FUNCTIONS):
            if not len(runs):
                break
            levels = minima_levels(function_hashes(self.base, j))
            c = run_minima(levels)[runs]
            covered = shared[j][c]
            whole &= covered
            s, c = runs[covered], c[covered]
            # The next-smallest shingle of a run is the smaller of the minima before and behind c.
            size, table = np.array([(1 << k) for k in range(len(levels))]), levels
            second = np.full(len(s), np.iinfo(np.uint64).max, np.uint64)
            for low, high in ((s, c), (c + 1, s + PASSAGE)):
                for k in range(len(levels)):
                    of = np.flatnonzero((high - low >= size[k]) & (high - low < 2 * size[k]))
                    second[of] = np.minimum(second[of], np.minimum(table[k][low[of]], table[k][high[of] - size[k]]))
            d = (second & _PLACES).astype(np.int64)
            pair = np.unique((c << 24) | d)
            c, d = pair >> 24, pair & int(_PLACES)
            keys.append((self.base[c] * np.uint64(3) ^ self.base[d]) * _MIX + np.uint64(j))
            places.append(c)
            kinds.append(np.full(len(c), PAIR))
        at = runs[whole]
        keys.append(run_hashes(self.base)[at] if len(at) else np.zeros(0, np.uint64))
        places.append(at + PASSAGE // 2)
        kinds.append(np.full(len(at), RUN))
        return np.concatenate(keys), np.concatenate(places), np.concatenate(kinds)


_LINKS = "k long, b long, a long, at long"


def _reduced(block: Block, key: np.ndarray, at: np.ndarray, kind: np.ndarray, thin: bool) -> pa.RecordBatch:
    """A block's windows: those of the first document of each key (a null), the others linked with it.

    A linked row's partner is the key's first document, or for every other key (``seeded``) a seeded one of the documents before its own.
    Linked rows get a key of their own, so that the shuffle spreads them. ``at``
    holds the place in b, whether other documents of the block have the key,
    the kind and the place in a. A document's rows follow each other, which halves the
    shuffle's bytes. thin: one link for THIN places is enough.
    """
    doc, place = block.doc[at], block.place[at]
    order = np.lexsort((place, doc, key))
    key, doc, place, kind = key[order], doc[order], place[order], kind[order]
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    linked = doc != doc[head]
    new_doc = new | np.concatenate(([True], doc[1:] != doc[:-1]))[:n]
    before = np.maximum.accumulate(np.where(new_doc, np.arange(n), 0)) - head  # the key's rows of earlier documents
    draw = ((key ^ doc.astype(np.uint64)) * _MIX) >> np.uint64(33)
    picked = head + np.where(linked & _seeded(key, kind) & (before <= FEW), (draw % np.maximum(before, 1).astype(np.uint64)).astype(np.int64), 0)
    shared = np.zeros(n, bool)
    shared[head[linked]] = True
    shared = shared[head] & ~linked
    k = np.where(linked, (doc.astype(np.uint64) * _MIX) ^ (key >> np.uint64(8)), key)
    a, a_place = doc[picked], np.where(linked, place[picked], 0)
    order = np.lexsort((place, a_place // THIN, np.where(linked, a, -1), doc)) if thin else np.lexsort((place, doc))
    k, b, a, a_place, place, kind, linked, shared = (x[order] for x in (k, doc, a, a_place, place, kind, linked, shared))
    packed = (place << 32) | (shared.astype(np.int64) << 31) | (kind << 28) | a_place
    if thin and n:
        same = linked[1:] & linked[:-1] & (b[1:] == b[:-1]) & (a[1:] == a[:-1]) & (a_place[1:] // THIN == a_place[:-1] // THIN)
        keep = np.concatenate(([True], ~same))
        k, b, a, packed, linked = k[keep], b[keep], a[keep], packed[keep], linked[keep]
    arrays = [pa.array(k.view(np.int64)), pa.array(b), pa.array(a, mask=~linked), pa.array(packed)]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "b", "a", "at"])


def _seeded(key: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Keys whose partner a seeded order picks: every other one, but none of a whole run, which its first document surely has."""
    return (key & np.uint64(1) == 1) & (kind != RUN)


def own_repeats(mine: np.ndarray) -> list[tuple[int, int]]:
    """Runs [s, e) of a text's shingles that repeat an earlier part of the text, as ``matching_runs`` has them."""
    _, first, back = np.unique(mine, return_index=True, return_inverse=True)
    moved = np.arange(len(mine)) - first[back]
    at = np.flatnonzero(moved >= PASSAGE)
    if len(at) < SIMILARITY * PASSAGE:
        return []
    moved = moved[at]
    cuts = np.flatnonzero((np.abs(np.diff(moved)) > DRIFT) | (np.diff(at) > PASSAGE // 2)) + 1
    return [run for part in np.split(at, cuts) for run in runs_of(part)]


def _blocks(rows: Iterator[tuple], limit: int) -> Iterator[tuple[Block, list[tuple]]]:
    """Blocks of rows (doc_id, text, ...) with the rows; texts too short for a passage are left out."""
    parts: list[tuple[int, int, np.ndarray]] = []
    held: list[tuple] = []
    size = 0
    for row in rows:
        base = shingles(row[1])
        if len(base) < PASSAGE:
            continue
        step = PART - PASSAGE + 1
        for low in range(0, max(1, len(base) - PASSAGE + 1), step):
            part = base[low : low + PART]
            if parts and size + len(part) > limit:
                yield Block(parts), held
                parts, held, size = [], [], 0
            parts.append((row[0], low, part))
            held.append(row)
            size += len(part)
    if parts:
        yield Block(parts), held


def _rows(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(columns)))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, _ in _blocks(_rows(batches, 2), BLOCK):
        yield _reduced(block, *block.windows(), thin=False)
        # Texts that hold enough shingles twice are searched for repeats of their own.
        order = np.lexsort((block.base, block.doc))
        base, doc = block.base[order], block.doc[order]
        twice = doc[1:][(base[1:] == base[:-1]) & (doc[1:] == doc[:-1])]
        own, n = np.unique(twice, return_counts=True)
        own = own[n >= SIMILARITY * PASSAGE]
        if len(own):
            arrays = [pa.array((own.astype(np.uint64) * _MIX).view(np.int64)), pa.array(own), pa.array(own), pa.array(np.full(len(own), OWN << 28))]
            yield pa.RecordBatch.from_arrays(arrays, names=["k", "b", "a", "at"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, nodes); a node is its place, times 8, plus its function."""
    for block, rows in _blocks((r for r in _rows(batches, 3) if r[1] is not None), BLOCK // 2):
        shared = [np.zeros(len(block.base), bool) for _ in range(FUNCTIONS)]
        for number, (start, row) in enumerate(zip(block.starts.tolist(), rows)):
            nodes = np.array(row[2], np.int64)
            end = block.starts[number + 1] if number + 1 < len(rows) else len(block.base)
            at = start + (nodes >> 3) - block.place[start]
            fits = (at >= start) & (at < end)
            for j in range(FUNCTIONS):
                shared[j][at[fits & (nodes & 7 == j)]] = True
        yield _reduced(block, *block.contexts(shared), thin=True)


def _with_first(rows: DataFrame) -> DataFrame:
    """Rows whose key several documents have, with ``first`` (b, at), the key's first document and its place, or for a seeded key the one that a seeded order has first."""
    keyed = Window.partitionBy("k")
    seeded = (F.col("k").bitwiseAND(F.lit(1)) == 1) & (_kind(F.col("at")) != RUN)
    rows = rows.withColumn("rows", F.count("*").over(keyed))
    order = F.when(seeded & (F.col("rows") <= FEW), F.xxhash64("k", "b")).otherwise(F.lit(0))
    least = F.min(F.when(F.col("a").isNull(), F.struct(order.alias("order"), "b", "at"))).over(keyed)
    low, high = (f("b").over(keyed) for f in (F.min, F.max))
    rows = rows.withColumns({"first": least, "low": low, "high": high})
    held = F.col("at").bitwiseAND(F.lit(1 << 31)) != 0
    return rows.where(F.col("a").isNotNull() | held | (F.col("low") < F.col("high"))).drop("low", "high", "rows")


def _place(at: Column) -> Column:
    return F.shiftright(at, 32)


def _kind(at: Column) -> Column:
    return F.shiftright(at, 28).bitwiseAND(F.lit(7))


def _links(rows: DataFrame) -> DataFrame:
    """(b, a, cb, ca, kind) of the linked rows, and of the others with the document that their key picked; a is the earlier one."""
    linked = F.col("a").isNotNull()
    later = F.col("b") > F.col("first.b")
    side = lambda yes, no: F.when(linked | later, yes).otherwise(no)
    mine, its = _place(F.col("at")), F.when(linked, F.col("at").bitwiseAND(F.lit((1 << 28) - 1))).otherwise(_place(F.col("first.at")))
    other = F.coalesce("a", "first.b")
    return rows.where(linked | (F.col("b") != F.col("first.b"))).select(
        side(F.col("b"), other).alias("b"), side(other, F.col("b")).alias("a"), side(mine, its).alias("cb"), side(its, mine).alias("ca"), _kind(F.col("at")).alias("kind"),
    )


def joined_intervals(b: np.ndarray, a: np.ndarray, cb: np.ndarray, ca: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """(b, a, lo, hi): disjoint intervals of a around the links that count; links sorted by (b, a, cb).

    A context counts by itself, a node's link with another link within PASSAGE
    of it in b and not much further in a. A document's repeats of its own have
    one empty interval.
    """
    fine = kind >= FUNCTIONS
    for lag in range(1, 2 * FUNCTIONS + 1):
        near = (b[lag:] == b[:-lag]) & (a[lag:] == a[:-lag]) & (cb[lag:] - cb[:-lag] <= PASSAGE) & (np.abs(ca[lag:] - ca[:-lag]) <= PASSAGE + PASSAGE // 4)
        fine[lag:] |= near
        fine[:-lag] |= near
    b, a, ca, kind = b[fine], a[fine], ca[fine], kind[fine]
    order = np.lexsort((ca, a, b))
    b, a, ca, kind = b[order], a[order], ca[order], kind[order]
    lo, hi = np.maximum(ca - HALF, 0), ca + HALF
    lo, hi = np.where(kind == OWN, 0, lo), np.where(kind == OWN, 0, hi)
    if not len(b):
        return b, a, lo, hi
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (lo[1:] > hi[:-1])
    first = np.flatnonzero(new)
    return b[first], a[first], lo[first], np.append(hi[first[1:] - 1], hi[-1])


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (b, a, cb, ca, kind), sorted, to (b, a, lo, hi)."""

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in joined_intervals(*columns)], names=["b", "a", "lo", "hi"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if held is not None:
            columns = [np.concatenate(c) for c in zip(held, columns)]
        if not len(columns[0]):
            continue
        other = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
        cut = int(other[-1]) + 1 if len(other) else 0  # the last two documents' links may go on
        held = [c[cut:] for c in columns]
        if cut:
            yield out([c[:cut] for c in columns])
    if held is not None:
        yield out(held)


def runs_of(at: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs [s, e) of at least PASSAGE places, SIMILARITY of them among the ascending places ``at``.

    They start and end with such places and leave at most PASSAGE // 2
    places in a row out; runs may overlap, none lies within another.
    """
    if len(at) < SIMILARITY * PASSAGE:
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    starts, ends = at[np.concatenate(([0], cut + 1))].tolist(), (at[np.concatenate((cut, [len(at) - 1]))] + 1).tolist()
    s, e = np.array(starts), np.array(ends)
    before = np.concatenate(([0], np.cumsum(e - s)))  # matched places before each run
    share = round(100 * SIMILARITY)
    # From run i to run j is similar enough where last[j] >= first[i].
    first, last = 100 * before[:-1] - share * s, 100 * before[1:] - share * e
    parts = np.concatenate(([0], np.flatnonzero(s[1:] - e[:-1] > PASSAGE // 2) + 1, [len(s)])).tolist()
    out: list[tuple[int, int]] = []
    for i, j in zip(parts, parts[1:]):
        best = np.maximum.accumulate(last[i:j][::-1])  # of the runs from each one on, from the right
        far = j - 1 - np.searchsorted(best, first[i:j])  # the furthest run that is similar enough
        for x, y in zip(s[i:j].tolist(), e[far].tolist()):
            if y - x >= PASSAGE and (not out or y > out[-1][1]):
                out.append((x, y))
    return out


def matching_runs(mine: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """``runs_of`` the places of ``mine`` whose shingle is in ``other``."""
    return runs_of(np.flatnonzero(np.isin(mine, other)))


def matches(text: str, clips: list[tuple[int, bytes]], own: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, document) of each passage of the text that repeats one of a clip, in code points.

    A clip of the document ``own`` stands for the earlier parts of the text itself.
    """
    base = shingles(text)
    mine = base.astype(np.uint32)
    runs = {(s, e, of) for of, clip in clips for s, e in (own_repeats(base) if of == own else matching_runs(mine, np.frombuffer(clip, np.uint32)))}
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return sorted((places[s][0], places[e + SHINGLE - 2][1], of) for s, e, of in runs)


def whole(text: str, of: int) -> list[tuple[int, int, int]]:
    """The one match of a text that is an equal text's copy; none if it is too short."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[0][0], places[-1][1], of)] if len(places) >= WORDS else []


def joined(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the matches."""
    out: list[tuple[int, int]] = []
    for s, e, _ in found:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _copies(texts: DataFrame) -> DataFrame:
    """(doc_id, first, digest): documents whose text an earlier one has too, with the first that has it."""
    known = texts.select("doc_id", F.unhex(F.md5("text")).alias("digest")).where(F.col("digest").isNotNull())
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = known.join(firsts.drop("last"), "digest").where("doc_id > first")
    # A doc_id with several texts counts by one of them.
    return copies.groupBy("doc_id").agg(F.min(F.struct("first", "digest")).alias("c")).select("doc_id", "c.first", "c.digest")


def passage_links(texts: DataFrame, copies: DataFrame, others: list[str]) -> DataFrame:
    """(b, a, lo, hi): document b may repeat passages of the shingles [lo, hi) of document a <= b; ``copies`` are left out as b."""
    rows = texts.where(F.col("text").isNotNull()).select("doc_id", "text").mapInArrow(_windows, _LINKS)
    rows = _with_first(rows).join(copies.select("doc_id"), F.col("b") == F.col("doc_id"), "left_anti")
    # Written out, for the links and for the contexts.
    rows = cut_lineage(rows)
    nodes = rows.where(_kind(F.col("at")) < FUNCTIONS).groupBy("b").agg(F.collect_set(_place(F.col("at")) * 8 + _kind(F.col("at"))).alias("_nodes"))
    # The join deals the same rows and columns as those of _found do (_contexts reads the first three).
    met = texts.join(nodes, texts["doc_id"] == nodes["b"]).select("b", "text", "_nodes", *others).mapInArrow(_contexts, _LINKS)
    links = _links(rows).unionByName(_links(_with_first(met)))
    dealt = links.repartition(shuffle_partitions(texts.sparkSession), "b").sortWithinPartitions("b", "a", "cb")
    return dealt.mapInArrow(_intervals, "b long, a long, lo long, hi long")


_CUT = "struct<spans:array<int>,kept_text:string,start:array<int>,end:array<int>,of:array<long>>"


def _found(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` under names of its own with ``_cut``, and each old column by its new name."""
    base, own = own_names(df, "doc_id", "text")
    base = base.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    others = [n for n in base.columns if n not in ("doc_id", "text")]
    texts = base.where(F.col("doc_id").isNotNull())
    copies = cut_lineage(_copies(texts))
    links = passage_links(texts, copies, others)

    @F.pandas_udf("binary")
    def clip(texts: pd.Series, lo: pd.Series, hi: pd.Series, *others: pd.Series) -> pd.Series:
        out, last, hashed = [], None, None
        for text, a, b in zip(texts, lo, hi):
            if text != last:  # rows of one document come together after the join
                last, hashed = text, shingles(text or "").astype(np.uint32)
            out.append(hashed[a:b].tobytes())
        return pd.Series(out, dtype=object)

    @F.pandas_udf(_CUT)
    def cut(ids: pd.Series, texts: pd.Series, sources: pd.Series, clips: pd.Series, firsts: pd.Series) -> pd.DataFrame:
        rows = []
        for own, text, of, parts, first in zip(ids, texts, sources, clips, firsts):
            found = []
            if text is not None and not pd.isna(first):
                found = whole(text, int(first))
            elif text is not None and parts is not None:
                found = matches(text, list(zip(of.tolist(), parts)), own)
            spans = joined(found)
            for s, e in reversed(spans):
                text = text[:s] + text[e:]
            rows.append(([p for span in spans for p in span], text, *([m[i] for m in found] for i in range(3))))
        return pd.DataFrame(rows, columns=["spans", "kept_text", "start", "end", "of"], dtype=object)

    # Both joins deal the same rows and columns by doc_id (hence the columns that clip
    # doesn't use), so Spark shuffles the texts once and reads them twice.
    earlier = texts.join(links, texts["doc_id"] == links["a"])
    clips = earlier.select("b", F.struct("a", clip("text", "lo", "hi", *others).alias("clip")).alias("c"))
    clips = clips.groupBy("b").agg(F.collect_list("c").alias("_clips"))
    same = copies.select(F.col("doc_id").alias("_copy"), F.col("first").alias("_first"), F.col("digest").alias("_digest"))
    out = texts.join(clips, texts["doc_id"] == clips["b"], "left").join(same, texts["doc_id"] == same["_copy"], "left")
    # The number of the first equal text; null where there is none.
    first = F.when(F.col("_digest").isNotNull() & (F.unhex(F.md5("text")) == F.col("_digest")), F.col("_first"))
    out = out.select(*base.columns, cut("doc_id", "text", "_clips.a", "_clips.clip", first).alias("_cut"))
    none = F.struct(
        F.array().cast("array<int>").alias("spans"), F.col("text").alias("kept_text"), F.array().cast("array<int>").alias("start"),
        F.array().cast("array<int>").alias("end"), F.array().cast("array<long>").alias("of"),
    )
    unnamed = base.where(F.col("doc_id").isNull()).select(*base.columns, none.alias("_cut"))
    return out.unionByName(unnamed), own


def find_passages(df: DataFrame) -> DataFrame:
    """``df`` with ``spans``, ``kept_text`` and ``repeats``.

    spans: start and end code point of each repeated passage, in turn.
    repeats: arrays start, end and of, a place for each match with an earlier
    document, or with an earlier part of the document itself.

    A passage of at least WORDS words counts as repeated if a document with a
    smaller doc_id, or the text before it, holds one of SIMILARITY; the first keeps it. Rows
    that share a doc_id are one document and no repeats of each other. Rows
    with a null doc_id or text have no spans; a null text stays null. Columns
    of ``df`` with the new names are replaced, all others pass through; an empty table gives no rows.
    """
    found, own = _found(without(df, "spans", "kept_text", "repeats"))
    repeats = F.struct(*[F.col(f"_cut.{c}").alias(c) for c in ("start", "end", "of")]).alias("repeats")
    return found.select(*own.values(), F.col("_cut.spans").alias("spans"), F.col("_cut.kept_text").alias("kept_text"), repeats)


def drop_passages(df: DataFrame) -> DataFrame:
    """``df`` without its repeated passages; documents that are left without a word go.

    n_chars, where there is such a column, follows the new text; all other columns stay as they are.
    """
    found, own = _found(df)
    text = F.col("_cut.kept_text")
    some = F.size("_cut.spans") > 0
    found = found.where(~(some & (F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")) == 0)))
    own["text"] = text.alias("text")
    if "n_chars" in own:
        own["n_chars"] = F.when(some, F.length(text).cast("long")).otherwise(own["n_chars"]).alias("n_chars")
    return found.select(*own.values())


def op5_substring(spark, sf_dir: str) -> DataFrame:
    """A row for each passage of a document that repeats an earlier one (documents without one have no row)."""
    found = find_passages(documents(spark, sf_dir).select("doc_id", "text"))
    parts = F.arrays_zip(*[F.col(f"repeats.{c}").alias(c) for c in ("start", "end", "of")])
    rows = found.select("doc_id", "spans", F.explode(parts).alias("r"))
    return rows.select("doc_id", F.col("r.of").alias("earlier_doc_id"), F.col("r.start").alias("start"), F.col("r.end").alias("end"), F.size("spans").alias("n_bounds"))
