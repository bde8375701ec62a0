"""Operator 7, SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints within four differing bits are linked and the links' connected
components reported. All links come from the index: fingerprints are sorted
by Gray rank, and runs of FAN of them, runs of those runs and so on are nodes that
keep the bits all their members share. Two nodes whose shared bits already
differ in more than four places are dropped with everything below them; as a
node's shared bits are among its children's, differences accumulate on the way
down. Two nodes whose members are all connected already are dropped too, so a
group emits a spanning forest of its links and never all pairs.

The index is dealt to tasks by blocks of bits: four differing bits leave one
of five blocks untouched, two of six, three of seven. Equal blocks make a
group with a tree of its own; of each block so many bits are used that a group of
unrelated fingerprints has about GROUP members however many there are in all
(``key_columns``). Groups of over ``chunk`` members are cut into Gray-rank
ranges, and each pair of ranges whose shared bits are near enough goes to a task
of its own, so no task holds such a group whole.

``similar`` is for texts: five-word shingles, a Jaccard similarity. Four bits
are far less than similarity 0.8, so the index's links are joined by those of
a second sketch (bands of min-hashes), and every link is verified on the texts.
Texts of one template share bands without being similar, so a third sketch looks at the rarest quarter of a
text's shingles alone: two texts of 0.8 share over a third of those, which no template has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_rows, cut_lineage, documents, shuffle_partitions, text_or_empty, tree_sum
from wakeline.llm.components import connected

BITS = 4
SEED = 42
WORDS = 4
CHUNK = 20_000
#: Members of a group of unrelated fingerprints, about.
GROUP = 2_048
FAN = 4
#: Gray-rank ranges that a group can be cut into.
RANGES = 4_096
#: Fingerprints that a task searches at once, or one group or pair of ranges.
AT_ONCE = 1 << 16

#: For ``similar``: words of a shingle, similarity, and the bands of min-hashes.
SHINGLE = 5
SIMILARITY = 0.8
BANDS = 10
ROWS = 4
_ODD = np.random.default_rng(70707).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Single min-hashes over the rarest shingles, one in RAREST, and the counters that tell how rare a shingle is.
RARE, RAREST, COUNTERS = 24, 4, 1 << 20
_ODD_RARE = np.random.default_rng(70708).integers(0, 1 << 63, RARE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of each word shingle of a text, A-Z lower-cased; fewer words are one shingle, none none."""
    from xxhash import xxh64_intdigest

    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() touches A-Z alone, split() cuts on exactly space and \t to \r
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    width = min(words, len(tokens))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - width + 1].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())), np.uint64, len(starts))


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; zero without hashes."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_text(text: str, words: int = WORDS) -> int:
    """SimHash of a text's word shingles, as an unsigned 64-bit integer; zero without words."""
    return fingerprint_of(shingle_hashes(text, words))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Rank of each 64-bit value in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_rank_column(value: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


class Forest:
    """Union-find over positions, fed with blocks of links."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> bool:
        """Whether the links connected anything new."""
        changed = False
        while True:
            ru, rv = self.root[u], self.root[v]
            apart = ru != rv
            if not apart.any():
                return changed
            changed = True
            u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
            np.minimum.at(self.root, np.maximum(ru, rv), np.minimum(ru, rv))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


class GrayIndex:
    """A tree for each group of fingerprints: level 0 has the values in Gray order, each level above runs of FAN nodes.

    A node holds the bits shared by its run (mask) and their values
    (pattern). All trees have as many levels as the tallest; at the top each
    group is one node.
    """

    def __init__(self, values: np.ndarray, starts: np.ndarray) -> None:
        sizes = np.diff(np.append(starts, len(values)))
        group = np.repeat(np.arange(len(starts)), sizes)
        self.group = group
        self.values = values[np.lexsort((gray_rank(values), group))]
        both, either = self.values, self.values
        self.levels = [(~np.zeros_like(both), both)]
        self.children: list[np.ndarray] = [np.arange(len(both) + 1)]
        while sizes.max() > 1:
            within = np.arange(len(both)) - np.repeat(starts, sizes)
            cuts = np.flatnonzero(within % FAN == 0)
            self.children.append(np.append(cuts, len(both)))
            both, either = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts)
            self.levels.append((~(both ^ either), both))
            sizes = -(-sizes // FAN)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.linked = Forest(len(self.values))
        self._roots: list[tuple[np.ndarray, np.ndarray]] | None = None
        #: Pairs of nodes that were compared, and those dropped by their bits or as connected already.
        self.compared = self.dropped = self.known = 0

    def _connected(self, level: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether all members of both nodes are in one component."""
        if self._roots is None:
            least = most = self.linked.root
            self._roots = [(least, most)]
            for children in self.children[1:]:
                least, most = np.minimum.reduceat(least, children[:-1]), np.maximum.reduceat(most, children[:-1])
                self._roots.append((least, most))
        least, most = self._roots[level]
        return (least[u] == most[v]) & (most[u] == least[v])

    def _link(self, u: np.ndarray, v: np.ndarray) -> None:
        if self.linked.join(u, v):
            self._roots = None

    def _neighbours(self, bits: int) -> None:
        """Links of near neighbours in Gray order: most of a cluster, before any node is opened."""
        for d in range(1, FAN + 1):
            near = np.flatnonzero((self.group[d:] == self.group[:-d]) & (np.bitwise_count(self.values[d:] ^ self.values[:-d]) <= bits))
            self._link(near, near + d)

    def search(self, u: np.ndarray, v: np.ndarray, bits: int = BITS, budget: int = 1 << 18) -> None:
        """Connect all within ``bits`` between the groups u[i] and v[i] (or inside one, where they are the same).

        Worked depth first, about ``budget`` pairs of nodes at once, so memory stays bounded.
        """
        if (u == v).any():
            self._neighbours(bits)
        step, i = max(1, budget // FAN**2), np.arange(FAN)
        stack = [(len(self.levels) - 1, u, v, True)]
        while stack:
            level, u, v, new = stack.pop()
            if new:
                mask, pattern = self.levels[level]
                near = np.bitwise_count((pattern[u] ^ pattern[v]) & mask[u] & mask[v]) <= bits
                self.compared += len(u)
                self.dropped += len(u) - int(np.count_nonzero(near))
                u, v = u[near], v[near]
                if not level:
                    apart = u != v
                    self._link(u[apart], v[apart])
                    continue
            if not len(u):
                continue
            if len(u) > step:
                stack.append((level, u[step:], v[step:], False))
                u, v = u[:step], v[:step]
            known = self._connected(level, u, v)
            self.known += int(np.count_nonzero(known))
            u, v = u[~known], v[~known]
            first = self.children[level]
            a, b = first[u][:, None, None] + i[:, None], first[v][:, None, None] + i
            there = (a < first[u + 1][:, None, None]) & (b < first[v + 1][:, None, None])
            there &= (u != v)[:, None, None] | (a < b if level == 1 else a <= b)
            a, b = np.broadcast_arrays(a, b)
            stack.append((level - 1, a[there], b[there], True))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links found."""
        other = np.flatnonzero(self.linked.root != np.arange(len(self.values)))
        return self.values[self.linked.root[other]], self.values[other]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places where sorted rows differ from the row before, the first included."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def indexed(key: np.ndarray, cell: np.ndarray, side: np.ndarray, fp: np.ndarray) -> GrayIndex:
    """The searched index over rows sorted by (key, cell, side): inside a cell of one side, between the sides of one with two."""
    starts = _changes(key, cell, side)
    index = GrayIndex(fp, starts)
    cells = np.searchsorted(starts, _changes(key, cell))
    two = np.diff(np.append(cells, len(starts))) == 2
    index.search(cells, cells + two)
    return index


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, cell, side, fp) sorted by the first three to links (a, b)."""

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        a, b = indexed(*columns).forest()
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        held.append([*columns[:3], columns[3].view(np.uint64)])
        if sum(len(h[0]) for h in held) < AT_ONCE:
            continue
        columns = [np.concatenate(c) for c in zip(*held)]
        cut = int(_changes(*columns[:2])[-1])  # the last cell may go on
        held = [[c[cut:] for c in columns]]
        if cut:
            yield out([c[:cut] for c in columns])
    if held:
        yield out([np.concatenate(c) for c in zip(*held)])


def key_columns(count: int) -> list[Column]:
    """Group keys of ``fp``, such that two fingerprints within BITS share one at least.

    BITS + k blocks leave k of them untouched. The fewest blocks are taken that make
    groups of GROUP unrelated fingerprints, and no more bits of a block than
    that needs; a few fingerprints are one group.
    """
    wanted = math.ceil(math.log2(max(1, count / GROUP)))
    if not wanted:
        return [F.lit(0).cast("long")]
    for kept in (1, 2, 3, 4):
        width = 64 // (BITS + kept)
        if kept * width >= wanted or kept == 4:
            break
    used = min(width, math.ceil(wanted / kept))
    keys = []
    for number, chosen in enumerate(combinations(range(BITS + kept), kept)):
        key = F.lit(number).cast("long")
        for block in chosen:
            key = F.shiftleft(key, used).bitwiseOR(F.shiftrightunsigned("fp", block * width).bitwiseAND(F.lit((1 << used) - 1)))
        keys.append(key)
    return keys


def near_links(fingerprints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect what lies within BITS among distinct ``fp`` longs."""
    rows = fingerprints.select("fp", F.explode(F.array(*key_columns(fingerprints.count()))).alias("key"))
    hot = cut_lineage(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > chunk))
    cells = rows.select("key", F.lit(0).alias("cell"), F.lit(0).alias("side"), "fp")
    if not hot.isEmpty():
        cells = cells.join(hot, "key", "left_anti").unionByName(_range_pairs(rows.join(hot, "key"), chunk))
    dealt = cells.repartition(shuffle_partitions(fingerprints.sparkSession), "key", "cell").sortWithinPartitions("key", "cell", "side")
    return dealt.select("key", "cell", "side", "fp").mapInArrow(_search, "a long, b long")


def _range_pairs(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows (key, n, fp) of large groups, once for each pair of Gray-rank ranges that may hold links."""
    rows = rows.withColumn("rank", gray_rank_column(F.col("fp")))
    shares = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = rows.groupBy("key").agg(F.percentile_approx("rank", shares, 10 * RANGES).alias("cuts"), F.max("n").alias("n"))
    stride = F.greatest(F.lit(1), F.floor(RANGES / F.ceil(F.col("n") / chunk)))
    cuts = cuts.select("key", F.filter("cuts", lambda c, i: (i + 1) % stride == 0).alias("cuts"))
    rows = rows.join(cuts, "key").select("key", "fp", F.size(F.filter("cuts", lambda c: c <= F.col("rank"))).alias("own"))
    nodes = rows.groupBy("key", "own").agg(F.bit_and("fp").alias("all"), F.bit_or("fp").alias("some"))
    mask = F.bitwise_not(F.col("all").bitwiseXOR(F.col("some")))
    left = nodes.select("key", F.col("own").alias("u"), F.col("all").alias("ua"), mask.alias("um"))
    right = nodes.select("key", F.col("own").alias("v"), F.col("all").alias("va"), mask.alias("vm"))
    apart = F.bit_count(F.col("ua").bitwiseXOR(F.col("va")).bitwiseAND(F.col("um")).bitwiseAND(F.col("vm")))
    pairs = left.join(right, "key").where((F.col("u") <= F.col("v")) & (apart <= BITS)).select("key", "u", "v")
    ends = F.when(F.col("u") == F.col("v"), F.array(F.struct(F.col("u").alias("own"), F.lit(0).alias("side"))))
    ends = ends.otherwise(F.array(F.struct(F.col("u").alias("own"), F.lit(0).alias("side")), F.struct(F.col("v").alias("own"), F.lit(1).alias("side"))))
    wanted = pairs.select("key", (F.col("u") * (RANGES + 1) + F.col("v") + 1).alias("cell"), F.inline(ends))
    return rows.join(wanted, ["key", "own"]).select("key", "cell", "side", "fp")


def fingerprints(df: DataFrame) -> DataFrame:
    """(doc_id, fp) of each row of ``df`` (doc_id, text); fp is the signed long of the text's SimHash.

    A null text counts as empty; repeated rows are answered one for one; an empty
    table gives no rows; other columns are ignored.
    """
    schema = "at long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield arrow_rows([(d, signed(fingerprint_text(t))) for d, t in zip(batch.column("doc_id").to_pylist(), texts)], schema)

    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return slim.mapInArrow(run, schema).withColumnRenamed("at", "doc_id")


def near_duplicates(df: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``df``.

    Rows keep their number: repeated rows are repeated in the result. A null
    doc_id never names a component unless it has no other member (then the
    component_id is null). Texts without words have fingerprint zero and link
    like any other. Extra columns are ignored; an empty table gives no rows.
    """
    prints = cut_lineage(fingerprints(df))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    # Fingerprints are ordered by their first doc_id (none: last), so a component's smallest
    # node is its name, and no group of a whole component is ever formed to find it.
    node = F.struct(F.col("first").isNull().alias("unnamed"), "first", "fp")
    ends = nodes.select("fp", node.alias("node"))
    links = near_links(nodes.select("fp"))
    links = links.join(ends.select(F.col("fp").alias("a"), F.col("node").alias("na")), "a").join(ends.select(F.col("fp").alias("b"), F.col("node").alias("nb")), "b")
    roots = connected(links.select(F.col("na").alias("a"), F.col("nb").alias("b")))
    found = roots.select(F.col("node.fp").alias("fp"), F.col("root.first").alias("least"))
    # Written out, so that the last join is between two plain shuffles and Spark can split the
    # rows of a fingerprint that very many copies share.
    classes = cut_lineage(nodes.join(found, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


_SKETCH = "at long, whole binary, fp long, bands array<long>"


def rarest(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The quarter of the distinct hashes with the lowest counts, eight at least; ties by hash, so all texts order alike."""
    distinct = np.unique(hashes)
    order = np.argsort(counts[(distinct & np.uint64(len(counts) - 1)).astype(np.int64)], kind="stable")
    return distinct[order[: max(8, -(-len(distinct) // RAREST))]]


def sketch(text: str, words: int, counts: np.ndarray) -> tuple[bytes, int, list[int]]:
    """A text's exact hash (of its words), SimHash, and keys: bands of min-hashes and min-hashes of its rarest shingles."""
    from xxhash import xxh3_128_digest

    hashes = shingle_hashes(text, words)
    whole = xxh3_128_digest(b" ".join(text.encode("utf-8", "surrogatepass").lower().split()))
    if not len(hashes):
        return whole, 0, []
    low = np.empty(len(_ODD), np.uint64)
    step = max(1, (1 << 16) // len(hashes))
    for k in range(0, len(_ODD), step):
        mixed = hashes[None, :] * _ODD[k : k + step, None]
        low[k : k + step] = (mixed ^ (mixed >> np.uint64(32))).min(axis=1)
    bands = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        bands = (bands ^ (bands >> np.uint64(29))) * _MIX + row
    mixed = rarest(hashes, counts)[None, :] * _ODD_RARE[:, None]
    rare = (mixed ^ (mixed >> np.uint64(32))).min(axis=1) * _MIX + np.arange(BANDS, BANDS + RARE, dtype=np.uint64)
    return whole, signed(fingerprint_of(hashes)), np.concatenate((bands, rare)).view(np.int64).tolist()


def _shingle_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall on each counter: an upper bound for each shingle, of a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(COUNTERS, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append((shingle_hashes(text, words) & np.uint64(COUNTERS - 1)).astype(np.int64))
                size += len(held[-1])
                if size >= COUNTERS:
                    total += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held, size = [], 0
        return total + np.bincount(np.concatenate(held), minlength=COUNTERS) if held else total

    return np.minimum(tree_sum(texts, COUNTERS, count), np.iinfo(np.int32).max).astype(np.int32)


def _sketches(df: DataFrame, words: int) -> DataFrame:
    texts = df.select(text_or_empty().alias("text"))
    told = df.sparkSession.sparkContext.broadcast(_shingle_counts(texts, words))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield arrow_rows([(d, *sketch(t, words, told.value)) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())], _SKETCH)

    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return slim.mapInArrow(run, _SKETCH).withColumnRenamed("at", "doc_id")


def _candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of nodes (first, fp, bands) that may be similar: index links, equal fingerprints, shared bands.

    For a key each node meets one other, its leader by one of two random orders,
    so that a key which very many nodes share gives no more pairs than nodes. Keys of rare shingles are shared
    by few nodes, whatever text all have in common, so a node that fails with one leader has others.
    """
    heads = nodes.groupBy("fp").agg(F.min("first").alias("head"))
    links = near_links(heads.select("fp"))
    a, b = (heads.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_head")) for c in "ab")
    near = links.join(a, "a").join(b, "b").select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))
    same = nodes.join(heads, "fp").select(F.col("first").alias("a"), F.col("head").alias("b"))
    banded = nodes.select("first", F.posexplode("bands").alias("band", "key"))
    order = F.xxhash64("first", F.col("band") % 2)
    leaders = banded.groupBy("key").agg(F.min(F.struct(order.alias("order"), "first")).alias("leader"), F.count("*").alias("n")).where(F.col("n") > 1)
    met = banded.join(leaders, "key").select(F.col("first").alias("a"), F.col("leader.first").alias("b"))
    pairs = near.union(same).union(met).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard(mine: np.ndarray, other: np.ndarray) -> float:
    """Similarity of two sorted arrays of distinct hashes; two empty ones are alike."""
    if not len(mine) or not len(other):
        return float(len(mine) == len(other))
    at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
    shared = int(np.count_nonzero(other[at] == mine))
    return shared / (len(mine) + len(other) - shared)


def similar(df: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) of the documents of ``df`` (doc_id, text) by links of a Jaccard similarity of word shingles.

    Texts with the same words (A-Z lower-cased) are one node. Candidate links
    come from the Gray index and from bands of min-hashes; each is verified on
    the two texts' shingle sets, so no component holds a link below
    ``similarity``. A pair of 0.8 shares no band once in two hundred times, and none of the keys of rare shingles once in many thousand.
    component_id is the component's smallest doc_id. Rows with a null doc_id
    are left out; repeated rows are one document; a null text counts as empty; an empty
    table gives no rows.
    """
    named = df.where(F.col("doc_id").isNotNull())
    sketches = cut_lineage(_sketches(named, words))
    nodes = cut_lineage(sketches.groupBy("whole").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"), F.min("bands").alias("bands")).drop("whole"))
    pairs = cut_lineage(_candidates(nodes))
    members = sketches.select("doc_id", "whole")
    firsts = members.groupBy("whole").agg(F.min("doc_id").alias("first"))
    # The first of its node, for each document; a link like any other, but certain.
    copies = members.join(firsts, "whole").where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    links = _verified(named, pairs, words, similarity).union(copies)
    roots = connected(links)
    everyone = members.select("doc_id").distinct()
    found = everyone.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    return found.select("doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def _verified(named: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar. One text's shingles are brought to the other, 4 bytes each."""

    def distinct(text: str) -> np.ndarray:
        return np.unique(shingle_hashes(text, words).astype(np.uint32))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, b""
        for batch in batches:
            rows = []
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if text != last:  # rows of one text come together after the join
                    last, held = text, distinct(text).tobytes()
                rows.append((a, b, held))
            yield arrow_rows(rows, "a long, to long, held binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.zeros(0, np.uint32)
        for batch in batches:
            rows = []
            for a, b, held, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if text != last:
                    last, mine = text, distinct(text)
                if jaccard(mine, np.frombuffer(held, np.uint32)) >= similarity:
                    rows.append((a, b))
            yield arrow_rows(rows, "a long, b long")

    # Both joins deal the same columns by doc_id, so Spark shuffles the texts once.
    texts = named.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    carried = texts.join(pairs, texts["doc_id"] == pairs["a"]).select("a", "b", "text").mapInArrow(carry, "a long, to long, held binary")
    met = texts.join(carried, texts["doc_id"] == carried["to"]).select("a", "to", "held", "text")
    return met.mapInArrow(compare, "a long, b long")


def deduplicate(df: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of ``df`` that are the first of their component of ``similar``.

    The document whose doc_id names the component stays. Rows that share a
    doc_id are one document and stay or go together; rows with a null doc_id
    stay, for nothing tells them apart. All columns pass through.
    """
    groups = similar(df.select("doc_id", "text"), words, similarity)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return df.join(gone, df["doc_id"] == gone["_gone"], "left_anti").select([F.col(f"`{c}`") for c in df.columns])


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
