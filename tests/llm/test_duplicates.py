import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import sharding, substring
from wakeline.llm.components import connected


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.root for r in connected(links).collect()} == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_run_minima_are_the_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(4)
    for n in (46, 47, 300):
        h = rng.permutation(n).astype(np.uint64) << np.uint64(30)
        h[rng.integers(0, n, n // 5)] = h[0]  # ties: the first place is the node

        def nodes(low, high):
            if high - low < substring.PASSAGE:
                return set()
            c = low + int(h[low:high].argmin())
            return {c} | nodes(low, c) | nodes(c + 1, high)

        at = substring.run_minima(substring.minima_levels(h))
        assert at.tolist() == [s + int(h[s : s + substring.PASSAGE].argmin()) for s in range(n - substring.PASSAGE + 1)]
        assert set(at.tolist()) == nodes(0, n)


def test_contexts_against_plain_minima():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 200, dtype=np.uint64)
    block = substring.Block([(7, 0, base[:120]), (8, 0, base[120:])])
    everything = [np.ones(200, bool)] * substring.FUNCTIONS
    key, at, kind = block.contexts(everything)
    runs = [s for s in range(155) if s + substring.PASSAGE <= 120 or s >= 120]
    assert sorted(at[kind == substring.RUN].tolist()) == [s + substring.PASSAGE // 2 for s in runs]
    pairs = set()
    for j in range(substring.FUNCTIONS):
        h = substring.function_hashes(base, j)
        for s in runs:
            c, d = sorted(range(s, s + substring.PASSAGE), key=lambda x: int(h[x]))[:2]
            pairs.add((j, c, d))
    assert len(at[kind == substring.PAIR]) == len(pairs)
    assert sorted(at[kind == substring.PAIR].tolist()) == sorted(c for _, c, _ in pairs)


def test_links_are_joined_as_intervals():
    rows = [
        (9, 1, 100, 500, 0), (9, 1, 110, 509, 1),  # near each other in both: counts
        (9, 1, 300, 900, 2),  # alone
        (9, 1, 400, 50, 0), (9, 1, 410, 2000, 1),  # near in one text only
        (9, 2, 10, 700, substring.RUN), (9, 2, 60, 760, substring.PAIR),  # contexts count alone; their intervals meet
        (9, 9, 0, 0, substring.OWN),
    ]
    got = substring.joined_intervals(*(np.array(c) for c in zip(*rows)))
    half = substring.HALF
    assert list(zip(*(c.tolist() for c in got))) == [(9, 1, 500 - half, 509 + half), (9, 2, 700 - half, 760 + half), (9, 9, 0, 0)]


def planted(prose):
    passage, other = prose("p", 70), prose("q", 55)
    edited = passage.split()
    edited[35] = "different"
    rows = [(i, prose(i, 130)) for i in range(30)]
    rows[3] = (3, f"{prose('a', 60)} {passage} {prose('b', 60)}")
    rows[9] = (9, f"{prose('c', 80)}\n{passage.upper()}\n{prose('d', 40)}")
    rows[14] = (14, f"{prose('e', 20)} {' '.join(edited)} {prose('f', 90)}")
    rows[20] = (20, f"{other} {prose('g', 90)} {passage}")
    rows[25] = (25, f"{prose('h', 90)} {other}")
    rows[27] = (27, f"{prose('i', 90)} {' '.join(other.split()[:40])} {prose('j', 70)}")  # 40 words: too short
    return rows


def test_passages_are_found_and_clean_rows_left(make, prose):
    rows = planted(prose)
    got = {r.doc_id: r for r in substring.find_passages(make(rows, extra=True)).collect()}
    texts = dict(rows)
    assert {d for d, r in got.items() if r.spans} == {9, 14, 20, 25}
    for doc_id, n in ((9, 70), (14, 70), (20, 70), (25, 55)):
        s, e = got[doc_id].spans
        assert abs(len(texts[doc_id][s:e].split()) - n) <= 1
        assert set(got[doc_id].repeats.of) <= ({20} if doc_id == 25 else {3, 9, 14} - {doc_id}) and min(got[doc_id].repeats.start) == s
        assert got[doc_id].kept_text == texts[doc_id][:s] + texts[doc_id][e:]
    assert all(r.kept_text == texts[d] for d, r in got.items() if not r.spans)
    kept = {r.doc_id: r for r in substring.drop_passages(make(rows)).collect()}
    assert kept[9].n_chars == len(kept[9].text) < len(texts[9]) and len(kept) == len(rows)


def test_passages_against_brute_force(make):
    rng = random.Random(6)
    pool = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(55, 90))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(5, 60))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(rng.randrange(4), pool[rng.randrange(6)])
        rows.append((i, " ".join(parts)))
    expected, sets = set(), []
    for i, text in rows:
        mine = substring.shingles(text).astype(np.uint32)
        if any(substring.matching_runs(mine, s) for s in sets):
            expected.add(i)
        sets.append(mine)
    assert {r.doc_id for r in substring.find_passages(make(rows)).collect() if r.spans} == expected


def test_passage_of_lines_that_earlier_documents_hold(make):
    """The first document of each shingle has it in another context; the later one has the passage."""
    rng = random.Random(12)
    words = lambda n: " ".join(f"v{rng.randrange(100_000)}" for _ in range(n))
    rows, late = [], []
    for case in range(20):
        lines = [words(20) for _ in range(3)]
        pairs = [" ".join(lines[:2]), " ".join(lines[1:])]  # 40 words: too short
        rows += [(len(rows) + k, f"{words(50)} {line} {words(50)}") for k, line in enumerate(lines * 2 + pairs * 10)]
        late += [(1000 + 2 * case + k, f"{words(60)} {' '.join(lines)} {words(60)}") for k in range(2)]
    got = {r.doc_id: r for r in substring.find_passages(make(rows + late)).collect()}
    assert {d for d, r in got.items() if r.spans} == {d for d, _ in late if d % 2}
    assert all(got[d].repeats.of == [d - 1] for d, _ in late if d % 2)


def test_contexts_where_a_text_holds_a_shingle_again(make):
    rng = random.Random(13)
    words = lambda n: " ".join(f"v{rng.randrange(100_000)}" for _ in range(n))
    rows, late = [], []
    for case in range(10):
        lines = [words(20) for _ in range(3)]
        pairs = [" ".join(lines[:2]), " ".join(lines[1:])]
        rows += [(len(rows) + k, f"{words(50)} {pair} {words(50)}") for k, pair in enumerate(pairs * 10)]
        for k in range(2):
            alone = " ".join(f"{pair} {words(60)}" for pair in pairs)
            late.append((1000 + 2 * case + k, f"{alone} {' '.join(lines)} {words(60)}"))
    got = {r.doc_id for r in substring.find_passages(make(rows + late)).collect() if r.spans}
    assert got == {d for d, _ in late if d % 2}


def test_matching_runs_against_brute_force():
    def brute(held):
        found = set()
        for s in range(len(held)):
            for e in range(s + substring.PASSAGE, len(held) + 1):
                gaps = "".join("x" if h else "." for h in held[s:e])
                if held[s] and held[e - 1] and 10 * sum(held[s:e]) >= 8 * (e - s) and "." * (substring.PASSAGE // 2 + 1) not in gaps:
                    found.add((s, e))
        return sorted(f for f in found if not any(g != f and g[0] <= f[0] and f[1] <= g[1] for g in found))

    edits = [k < 8 or 13 <= k < 21 or 26 <= k < 52 for k in range(52)]
    rng, cases = random.Random(9), [edits, edits[::-1]]
    for _ in range(150):
        held = []
        while len(held) < 110:
            held += [True] * rng.randint(1, 25) + [False] * rng.choice([1, 3, 5, 5, 8, 23, 24])
        cases.append(held)
    for held in cases:
        mine = np.arange(len(held), dtype=np.uint32)
        assert substring.matching_runs(mine, mine[np.array(held)]) == brute(held)
    assert brute(edits) == [(0, 52)] and sum(map(bool, map(brute, cases))) > 40


def edited_passages(seed, cases=60, decoys=False):
    """Rows, and for each late document its passage's similarity in shingles to the earlier one's."""
    rng = random.Random(seed)
    words = lambda n: [f"v{rng.randrange(200_000)}" for _ in range(n)]
    rows, share = [], {}
    for case in range(cases):
        passage = words(rng.randint(52, 200))
        copy = list(passage)
        for _ in range(rng.randint(0, 10)):
            spot = rng.randrange(len(copy))
            copy[spot : spot + rng.randint(0, 1)] = words(rng.randint(0, 2))
        if decoys:  # earlier documents that hold parts of the passage, each too short
            for k in range(0, len(copy), 15):
                rows.append((len(rows), " ".join(words(40) + copy[k : k + 22] + words(40))))
        sets = [{tuple(p[i : i + 5]) for i in range(len(p) - 4)} for p in (passage, copy)]
        share[1_000_001 + 2 * case] = len(sets[0] & sets[1]) / len(sets[1]) if len(copy) >= 50 else 0
        rows += [(1_000_000 + 2 * case, " ".join(words(70) + passage + words(60))), (1_000_001 + 2 * case, " ".join(words(50) + copy + words(80)))]
    return rows, share


@pytest.mark.parametrize("decoys", [False, True])
def test_recall_of_edited_passages(make, decoys):
    rows, share = edited_passages(31 + decoys, 60, decoys)
    got = {r.doc_id for r in substring.find_passages(make(rows)).collect() if r.spans}
    near = {d for d, s in share.items() if s >= 0.8}
    assert len(near) > 30 and len(near & got) >= 0.9 * len(near)
    assert not got - set(share)


def test_repeats_within_a_document(make, prose):
    passage = prose("p", 70).split()
    edited = [*passage[:30], "different", *passage[31:]]
    rows = [(1, " ".join([*prose("a", 60).split(), *passage, *prose("b", 60).split(), *edited, *prose("c", 40).split()])), (2, prose("d", 200))]
    got = {r.doc_id: r for r in substring.find_passages(make(rows)).collect()}
    s, e = got[1].spans
    assert abs(len(got[1].text[s:e].split()) - 70) <= 1 and got[1].text.index(" ".join(passage)) + 300 < s and set(got[1].repeats.of) == {1}
    assert not got[2].spans


def test_equal_texts(make, prose):
    long, short = prose("long", 90), prose("short", 30)
    rows = [(5, long), (3, long), (9, long), (4, short), (6, short), (9, long), (7, prose("other", 90))]
    got = substring.find_passages(make(rows)).collect()
    assert sorted((r.doc_id, len(r.spans), list(r.repeats.of)) for r in got) == [(3, 0, []), (4, 0, []), (5, 2, [3]), (6, 0, []), (7, 0, []), (9, 2, [3]), (9, 2, [3])]
    assert sorted(r.doc_id for r in substring.drop_passages(make(rows)).collect()) == [3, 4, 6, 7]


def test_passages_with_clashing_columns(make, prose):
    rows = [(1, prose("p", 80)), (2, prose("q", 60) + " " + prose("p", 80)), (3, None)]
    names = ("a", "b", "lo", "hi", "k", "at", "first", "digest", "spans", "kept_text", "repeats", "_cut", "_clips", "_own0", "Text2")
    df = make(rows)
    for name in names:
        df = df.withColumn(name, F.lit("mine"))
    got = {r.doc_id: r for r in substring.drop_passages(df).collect()}
    assert set(got) == {1, 2, 3} and all(r[n] == "mine" for r in got.values() for n in names)
    assert len(got[2].text.split()) < 62 and got[2].n_chars == len(got[2].text) and got[3].text is None


def test_passages_odd_rows(make, odd_rows):
    got = substring.find_passages(make(odd_rows, extra=True)).collect()
    assert len(got) == len(odd_rows)
    # A text of one word again and again repeats itself; random words of a short list don't.
    assert {r.doc_id for r in got if r.spans} == {11}
    assert substring.find_passages(make([])).count() == 0


def test_sharding(make, prose, odd_rows):
    rows = [(i, prose(i % 150, 20 + i % 90)) for i in range(600)] + [(1000 + i, prose(7, 200)) for i in range(100)]
    got = sharding.shard(make(rows, extra=True).withColumn("_before", F.lit("clash")), shards=4, tolerance=0.02).collect()
    # Against a plain sort: each row once, sizes and checksums of its text, shards in key order.
    texts = dict(rows)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in rows)
    of_text = {}
    for r in got:
        of_text.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for t, s in of_text.items() if t != prose(7, 200))
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(4)]
    assert max(sizes) < 1.05 * min(sizes)
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    odd = sharding.shard(make(odd_rows, extra=True)).collect()
    assert len(odd) == len(odd_rows) and {r.size for r in odd if r.text is None} == {1}
    assert len({(r.shard) for r in odd if r.doc_id == 8}) == 1
    assert sharding.shard(make([])).count() == 0


@pytest.mark.parametrize("edits", [1, 2])
def test_recall_with_long_decoys(make, edits):
    """Earlier documents hold 45-word parts of the copy, each too short to count; the passage itself is edited."""
    rng = random.Random(77 + edits)
    words = lambda n: [f"v{rng.randrange(200_000)}" for _ in range(n)]
    rows, near = [], set()
    for case in range(60):
        passage = words(rng.randint(60, 90))
        copy = list(passage)
        for spot in rng.sample(range(5, len(copy) - 5), edits):
            copy[spot] = words(1)[0]
        for k in range(0, len(copy) - 45, 15):
            rows.append((len(rows), " ".join(words(40) + copy[k : k + 45] + words(40))))
        rows.append((len(rows), " ".join(words(40) + copy[-45:] + words(40))))
        a, b = ({tuple(p[i : i + 5]) for i in range(len(p) - 4)} for p in (passage, copy))
        rows += [(1_000_000 + 2 * case, " ".join(words(70) + passage + words(60))), (1_000_001 + 2 * case, " ".join(words(50) + copy + words(80)))]
        if len(a & b) >= 0.8 * len(b):
            near.add(1_000_001 + 2 * case)
    got = {r.doc_id for r in substring.find_passages(make(rows)).collect() if r.spans}
    assert len(near) > 40 and len(near & got) >= 0.9 * len(near)
