import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import simhash
from wakeline.llm.components import connected


def brute_components(rows):
    prints = [(d, simhash.fingerprint_text(t or "")) for d, t in rows]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if least.get(r) is not None or d is not None else None
    return sorted(((d, least[find(i)]) for i, (d, _) in enumerate(prints)), key=str)


def near_copies(prose):
    rng, rows = random.Random(2), []
    for group in range(12):
        words = prose(group, 150).split()
        for k in range(6):
            copy = list(words)
            for _ in range(k % 3):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows) + 1, " ".join(copy)))
    return rows


def test_simhash_components(make, prose, odd_rows):
    rows = near_copies(prose) + [(100 + d if d else None, t) for d, t in odd_rows]
    got = simhash.near_duplicates(make(rows, extra=True)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == brute_components(rows)
    assert simhash.near_duplicates(make([])).count() == 0


def ball(seed, centres=4, members=60, flips=4):
    """Distinct fingerprints around a few centres."""
    rng = np.random.default_rng(seed)
    out = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (members, flips)).astype(np.uint64), axis=1) for c in rng.integers(0, 1 << 63, centres, dtype=np.uint64)]
    return np.unique(np.concatenate(out))


def near(values, bits=4):
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    return {(int(i), int(j)) for i, j in zip(*np.nonzero(distance <= bits)) if i < j}


def roots(n, links):
    forest = simhash.Forest(n)
    u, v = (np.array([link[i] for link in links], np.int64) for i in (0, 1))
    forest.join(u, v)
    return forest.root


def test_hot_groups_are_cut_into_gray_ranges(spark):
    values = ball(3, 12)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    whole, cut = (connected(simhash.near_links(df, chunk=c)).collect() for c in (10_000, 7))
    assert sorted(whole) == sorted(cut) and len(whole) > 100
    rows = df.withColumn("key", F.lit(1).cast("long")).withColumn("n", F.lit(len(values)))
    dealt = simhash._range_pairs(rows, 7).groupBy("cell").count().collect()
    ranges = len(values) // 7
    # Most pairs of ranges share no near bits and are dealt to no task.
    assert ranges < len(dealt) < ranges * ranges // 4 and max(r["count"] for r in dealt) <= 20


def test_gray_ranks():
    values = np.arange(1 << 10, dtype=np.uint64)
    order = values[np.argsort(simhash.gray_rank(values))]
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("values", [ball(1), ball(2, 40, 12), np.random.default_rng(8).integers(0, 1 << 16, 900).astype(np.uint64), ball(5, 1, 700, 2)])
def test_all_links_come_from_the_index(values):
    values = np.unique(values)
    zeros = np.zeros(len(values), np.int64)
    index = simhash.indexed(zeros, zeros, zeros, values)
    at = {int(v): i for i, v in enumerate(values)}
    a, b = index.forest()
    links = [(at[int(x)], at[int(y)]) for x, y in zip(a, b)]
    assert (roots(len(values), links) == roots(len(values), sorted(near(values)))).all()
    assert len(links) < len(values) and index.compared > 0


def test_groups_are_pruned_by_shared_bits():
    """Clusters of near fingerprints are dropped against each other whole."""
    values = ball(6, 200, 40, 2)
    zeros = np.zeros(len(values), np.int64)
    index = simhash.indexed(zeros, zeros, zeros, values)
    assert index.compared < len(values) ** 2 / 2 / 10 and index.dropped > index.compared / 4 and index.known > 0


def test_sides_of_a_cell_meet_each_other_only():
    values = np.sort(ball(9, 2, 40))
    side = (np.arange(len(values)) % 2).astype(np.int32)
    order = np.argsort(side, kind="stable")
    zeros = np.zeros(len(values), np.int64)
    index = simhash.indexed(zeros, zeros, side[order], values[order])
    at = {int(v): i for i, v in enumerate(values)}
    links = [(at[int(x)], at[int(y)]) for x, y in zip(*index.forest())]
    across = [(i, j) for i, j in near(values) if side[i] != side[j]]
    assert (roots(len(values), links) == roots(len(values), across)).all()


@pytest.mark.parametrize("count", [10, 5_000, 40_000_000, 1 << 34, 1 << 40, 1 << 50])
def test_linked_fingerprints_share_a_key(spark, count):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64) << np.uint64(1)
    b = a ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 4)).astype(np.uint64), axis=1)
    rows = [(k, int(x), int(y)) for k, (x, y) in enumerate(zip(a.view(np.int64), b.view(np.int64)))]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    keys = simhash.key_columns(count)
    mine, other = (df.select("k", F.col(c).alias("fp")).select("k", F.array(*keys).alias(f"of_{c}")) for c in "ab")
    assert mine.join(other, "k").where(~F.arrays_overlap("of_a", "of_b")).count() == 0


def edited_copies(seed, groups=40):
    """(rows, sets): texts with 0 to 4 edits of their group's text, and each text's five-word shingles."""
    rng, rows = random.Random(seed), []
    for group in range(groups):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(30, 250))]
        for _ in range(4):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                spot = rng.randrange(len(copy))
                copy[spot : spot + rng.randint(0, 1)] = [f"x{rng.randrange(4000)}"]
            rows.append((len(rows) + 1, " ".join(copy)))
    rng.shuffle(rows)
    split = {d: t.split() for d, t in rows}
    return rows, {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, w in split.items()}


def test_similar_against_brute_force(make):
    rows, sets = edited_copies(21)
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    different = [(a, b) for a, b in links if sets[a] != sets[b]]
    got = {r.doc_id: r.component_id for r in simhash.similar(make(rows, extra=True)).collect()}
    assert len(different) > 60
    assert sum(got[a] == got[b] for a, b in different) >= 0.97 * len(different)
    # No component joins more than the links do.
    root = roots(len(ids) + 1, links)
    assert all(root[d] == root[c] for d, c in got.items()) and all(c <= d for d, c in got.items())


def test_deduplicate(make, prose, odd_rows):
    rows = [(100 + i, prose(i % 40, 150)) for i in range(60)] + odd_rows
    got = simhash.deduplicate(make(rows, extra=True))
    assert got.columns == make(rows, extra=True).columns
    kept = [r.doc_id for r in got.select("doc_id").collect()]
    # Nulls, empty texts and texts of white space are one node; repeated rows go together.
    assert sorted(d for d in kept if d is not None) == sorted([1, 4, 5, 6, 7, 9, 10, 11] + [100 + i for i in range(40)])
    assert kept.count(None) == 2
    assert simhash.deduplicate(make([])).count() == 0


def test_deduplicate_clashing_columns(make):
    df = make([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)])
    for name in ("a", "b", "fp", "first", "key", "bands", "whole", "component_id", "root", "node", "cell", "side", "_gone"):
        df = df.withColumn(name, F.lit("mine"))
    got = simhash.deduplicate(df).collect()
    assert sorted(r.doc_id for r in got) == [1, 3] and all(r["_gone"] == r["root"] == "mine" for r in got)


def test_pairs_within_a_large_template_family(make):
    """Thousands of texts of one template, about 0.63 alike, with planted pairs of 0.8 and more among them."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    template = words(300)

    def filled(base, slots):
        out = list(base)
        for _ in range(slots):
            out[rng.randrange(len(out))] = words(1)[0]
        return out

    rows, pairs = [], []
    for i in range(4_200):
        mine = filled(template, 16)
        rows.append((10 * i, " ".join(mine)))
        if i % 21 == 0:
            copy = filled(mine, 6)
            rows.append((10 * i + 1, " ".join(copy)))
            a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (mine, copy))
            if len(a & b) >= 0.8 * len(a | b):
                pairs.append((10 * i, 10 * i + 1))
    got = {r.doc_id: r.component_id for r in simhash.similar(make(rows)).collect()}
    assert len(pairs) > 100
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
