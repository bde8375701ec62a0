"""Sort-means against a plain search of all centroids."""

import hashlib
import random

import numpy as np

from wakeline.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def plain(rows, width, k, rounds):
    """Every distance in Python's integers."""
    kept = [(v, [int(np.floor(1024 * float(x))) for x in e]) for v, e in rows if e is not None and len(e) == width and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(x) for _, x in order[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        who = [near(x)[1] for _, x in kept]
        for j in range(len(middle)):
            own = [x for (_, x), w in zip(kept, who) if w == j]
            if own:
                middle[j] = [sum(c) // len(own) for c in zip(*own)]
    return sorted((v, near(x)[1], near(x)[0]) for v, x in kept), middle


def test_as_plain_search(spark):
    rng = random.Random(4)
    f = lambda: float(np.float32(rng.gauss(0, 0.3)))
    rows = [(i, [f() for _ in range(8)]) for i in range(300)]
    rows += [(400 + i, [0.25] * 8) for i in range(150)]  # many equal vectors
    rows += [(600 + i, [(i % 2) * 0.5, (i % 3) * 0.5, *[0.0] * 6]) for i in range(60)]  # ties
    odd = [(700, None), (701, []), (702, [1.0] * 7), (703, [1.0] * 9), (704, [float("nan")] + [0.0] * 7), (705, [float("inf")] + [0.0] * 7), (706, [None] + [0.0] * 7)]
    df = spark.createDataFrame([(v, e, "clash") for v, e in rows + odd], SCHEMA)
    for k, rounds in ((8, 10), (3, 4), (20, 2)):
        found, middle = centroids.cluster_vectors(df, width=8, k=k, rounds=rounds)
        want, want_middle = plain(rows + odd, 8, k, rounds)
        assert sorted(map(tuple, found.collect())) == want
        assert middle.tolist() == want_middle


def test_fewer_distances_and_ties():
    rng = np.random.default_rng(1)
    middle = rng.integers(-2000, 2000, (40, 6))
    x = np.concatenate([middle[rng.integers(0, 40, 3000)] + rng.integers(-30, 30, (3000, 6)), np.zeros((5, 6), np.int64)])
    first, _, _ = centroids.assign(x, middle, None)
    cluster, distance, computed = centroids.assign(x, middle, first)
    every = ((x[:, None, :] - middle[None]) ** 2).sum(-1)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < every.size / 4
    # 2 lies as far as the own centroid 1, exactly at twice its distance: a tie that number 0 wins as well
    line = np.array([[2, 0], [0, 0], [4, 0]])
    got, _, _ = centroids.assign(np.array([[1, 0], [3, 0], [2, 0]]), line, np.array([1, 2, 1], np.int32))
    assert got.tolist() == [0, 0, 0]


def test_edge_cases(spark):
    found, middle = centroids.cluster_vectors(spark.createDataFrame([], SCHEMA), width=2)
    assert found.collect() == [] and len(middle) == 0
    big = [(1, [1e30, 0.0], "x"), (2, [1e6, 0.0], "x"), (3, [-1e30, 5.0], "x"), (None, [1e6, 0.0], "x"), (2, [1e6, 0.0], "x")]
    found, middle = centroids.cluster_vectors(spark.createDataFrame(big, SCHEMA), width=2, k=2, rounds=3)
    rows = found.collect()
    assert len(rows) == 5 and max(r["distance"] for r in rows) <= 2**63 - 1 and min(r["distance"] for r in rows) >= 0
    few, middle = centroids.cluster_vectors(spark.createDataFrame(big[1:2], SCHEMA), width=2)
    assert [tuple(r) for r in few.collect()] == [(2, 0, 0)] and middle.tolist() == [[1_024_000_000, 0]]
