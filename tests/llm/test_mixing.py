"""Mixing against a dealing of single seats, and its edge cases."""

import heapq
import re

import pytest

from wakeline.llm import mixing

SCHEMA = "doc_id long, text string, source string, shard string"


def dealt(sizes):
    """(targets, blocks, block): weights shared until no source is above its cap, then seats one at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % len(mixing.WEIGHTS)] for i, s in enumerate(names)}
    total, target, free = mixing.SHARE * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * sizes[s]}
        if not full:
            target.update(share)
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        free -= full
    positive = [t for t in target.values() if t > 0]
    block = int(min(max(min(positive) // mixing.PARTS_OF_LEAST, 1), mixing.BLOCK)) if positive else 1
    got, heap = dict.fromkeys(names, 0), [(-target[s], i) for i, s in enumerate(names)]
    heapq.heapify(heap)
    for _ in range(int(total // block)):
        while heap:
            _, i = heapq.heappop(heap)
            if got[names[i]] < 2 * sizes[names[i]] // block:
                got[names[i]] += 1
                heapq.heappush(heap, (-target[names[i]] / (2 * got[names[i]] + 1), i))
                break
    return target, got, block


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_seat_by_seat(spark, prose, seed):
    rows = [(i, prose(seed * 1000 + i, 5 + (i * 37) % 90), [None, "a", "b", "ü", "B", "z", "q"][(i * i + seed) % 7], "x") for i in range(300)]
    rows += [(1000 + i, prose(i, 200), "hot", "x") for i in range(150)]
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    target, blocks, block = dealt(sizes)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 and r["block"] == block
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert taken == {s: n * block for s, n in blocks.items()}
    assert all(abs(taken[s] - target[s]) <= 2 * block for s in taken)
    shards = {r["shard"] for r in got if r["taken"]}
    assert shards <= set(range(mixing.SHARDS)) and len(shards) > 1
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_quotas_of_shards(spark):
    sizes = [("a", False, 5_000), ("b", False, 70_000), ("c", False, 900), ("", True, 31)]
    targets = mixing._targets(spark.createDataFrame(sizes, "key string, missing boolean, source_size long"), mixing.WEIGHTS, mixing.SHARE)
    rows = {r["key"]: r["upto"] for r in mixing._quotas(targets, 16).collect()}
    block = targets.first()["block"]
    seats = int(mixing.SHARE * 75_931 // block)
    for edge in range(17):
        assert sum(u[edge] for u in rows.values()) == -(-seats * edge // 16)
    assert all(u == sorted(u) for u in rows.values())
    assert len({b - a for a, b in zip(rows["b"], rows["b"][1:])}) <= 3


def test_edge_cases(spark, odd_rows):
    rows = [(d, t, None if i % 3 == 0 else f"s{i % 3}", "x") for i, (d, t) in enumerate(odd_rows)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(d), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _, _ in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    none = mixing.mix(spark.createDataFrame([(1, None, None, "x"), (2, "", "a", "x")], SCHEMA)).collect()
    assert [(r["taken"], r["target"], r["shard"]) for r in none] == [(0, 0.0, None)] * 2
    same = mixing.mix(spark.createDataFrame([(1, "one two", "a", "x")] * 3 + [(None, "b c d", "b", "x")] * 2, SCHEMA)).collect()
    assert sum(r["taken"] for r in same) == 18 and all(r["taken"] <= 2 * r["size"] for r in same)
