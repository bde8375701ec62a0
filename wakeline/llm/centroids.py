"""Operator 13, centroid clustering by Sort-means.

Components are integers, so distances, sums and means are exact. In each
round a vector is compared with its centroid of the round before and then
with the others in ascending distance from that one, until one lies strictly
beyond twice the vector's own distance: by the triangle inequality neither it nor any later
one is nearer, and a tie that a smaller number would win is still seen.

A round reads the table of vectors with their clusters, writes it anew in
the shared checkpoint folder (the table before is deleted then) and sums the components by
cluster in tasks and then across them. The driver sees ``k`` centroids, never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import delete_folder, scratch_folder, written

CLUSTERS = 8
ROUNDS = 10
WIDTH = 64
SCALE = 1024
SEED = 3
#: Components beyond it count as it.
LARGEST = 2**62
#: Up to it, squared distances and their sums are computed in 64 bits; beyond, in Python's integers.
SMALL = 2**27
MOST_LONG = 2**63 - 1


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as long integers."""
    return np.clip(np.floor(vectors * float(SCALE)), -LARGEST, LARGEST).astype(np.int64)


def _exact(x: np.ndarray) -> np.ndarray:
    return x if not x.size or max(int(x.max()), -int(x.min())) <= SMALL else x.astype(object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``a`` to ``b``."""
    apart = a - b
    return (apart * apart).sum(axis=-1)


def assign(vectors: np.ndarray, centroids: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector and the number of distances computed, from the clusters ``before``.

    Without clusters before, all start at centroid 0.
    """
    x, c = _exact(vectors), _exact(centroids)
    if object in (x.dtype, c.dtype):
        x, c = vectors.astype(object), centroids.astype(object)
    start = np.zeros(len(x), np.int32) if before is None else before
    cluster, distance, computed = start.copy(), np.zeros(len(x), x.dtype), 0
    for own in np.unique(start):
        rows = np.flatnonzero(start == own)
        first = squared(x[rows], c[own])
        best, who = first.copy(), np.full(len(rows), own, np.int32)
        apart = squared(c, c[own])
        others = sorted((j for j in range(len(c)) if j != own), key=lambda j: apart[j])
        open_rows = np.arange(len(rows))
        for j in others:
            open_rows = open_rows[(4 * first[open_rows] >= apart[j]).astype(bool)]
            if not len(open_rows):
                break
            d = squared(x[rows[open_rows]], c[j])
            computed += len(d)
            nearer = ((d < best[open_rows]) | ((d == best[open_rows]) & (j < who[open_rows]))).astype(bool)
            best[open_rows[nearer]], who[open_rows[nearer]] = d[nearer], j
        computed += len(rows)
        cluster[rows], distance[rows] = who, best
    return cluster, distance, computed


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def _assigned(centroids: np.ndarray, last: bool):
    """Tasks that give (vec_id, x, cluster) their next cluster; the last time vec_id, cluster and distance alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            before = batch.column("cluster")
            cluster, distance, _ = assign(_matrix(batch.column("x"), centroids.shape[1]), centroids, None if before.null_count else before.to_numpy())
            own = pa.array(cluster, pa.int32())
            if last:
                far = pa.array([min(int(d), MOST_LONG) for d in distance], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), own, far], names=["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), own], names=["vec_id", "x", "cluster"])

    return run


def _sums(width: int):
    """Tasks that sum the components of (cluster, x): a row for each cluster and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            x, cluster = _exact(_matrix(batch.column("x"), width)), batch.column("cluster").to_numpy()
            for own in np.unique(cluster):
                rows = x[cluster == own]
                n, held = total.get(int(own), (0, np.zeros(width, object)))
                total[int(own)] = n + len(rows), held + rows.sum(axis=0).astype(object)
        rows = [(own, i, n, Decimal(int(s))) for own, (n, held) in total.items() for i, s in enumerate(held)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["cluster", "i", "n", "total"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, vector) to (vec_id, x, cluster): integers as bytes, no cluster yet."""
    for batch in batches:
        vectors = batch.column("vector")
        rows = integers(np.asarray(vectors.flatten(), dtype=np.float64).reshape(batch.num_rows, -1)) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary()), pa.nulls(batch.num_rows, pa.int32())], names=["vec_id", "x", "cluster"])


_TABLE = "vec_id long, x binary, cluster int"


def _means(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the clusters' means; a cluster without vectors keeps its centroid."""
    rows = table.select("cluster", "x").mapInArrow(_sums(centroids.shape[1]), "cluster int, i int, n long, total decimal(38,0)")
    new = centroids.copy()
    for row in rows.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k * width rows
        new[row["cluster"], row["i"]] = int(row["total"]) // row["n"]
    return new


def cluster_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = WIDTH, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), final centroids) of the vectors with exactly ``width`` components, all finite.

    Other rows, null vectors too, are left out; other columns are not read. The first centroids are the vectors
    with the smallest hashes of ``seed:key``, a null key last and equal keys by their
    components; with fewer than ``k`` vectors each is a centroid, and
    without any the result is empty. Repeated rows count each. Ties go to the
    smaller cluster number. Components beyond 2**62 count as that, and distances that a long can't hold as the largest long.
    The rows are read from a table in the checkpoint folder.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "clusters")
    own = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = own.where((F.size("vector") == width) & finite)
    table = written(kept.mapInArrow(_packed, _TABLE), f"{folder}/0")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = [bytes(r["x"]) for r in table.orderBy(order.asc_nulls_last(), "vec_id", "x").limit(k).select("x").collect()]
    centroids = np.frombuffer(b"".join(first), np.int64).reshape(-1, width)
    for i in range(1, rounds + 1 if len(centroids) else 0):
        table = written(table.mapInArrow(_assigned(centroids, False), _TABLE), f"{folder}/{i}")
        delete_folder(spark, f"{folder}/{i - 1}")
        centroids = _means(table, centroids)
    result = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], result), centroids
    found = written(table.mapInArrow(_assigned(centroids, True), result), f"{folder}/end")
    delete_folder(spark, f"{folder}/{rounds}")
    return found, centroids


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    most = lambda d: min(d, MOST_LONG)
    rows = [(j, most(inertia.get(j, 0)), most(sum(inertia.values())), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds one after another, over a row for each vector and component."""
    steps = [f"""kept as (select row_number() over () as row, vec_id, embedding from embeddings where len(embedding) = {WIDTH}
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
v as materialized (select row, vec_id, i, cast(floor({SCALE} * cast(embedding[i] as double)) as bigint) as x from kept, (select unnest(generate_series(1, {WIDTH})) as i)),
c0 as materialized (select cluster, i, x from v join (select row, row_number() over (order by sha256('{SEED}:' || vec_id)) - 1 as cluster from kept) using (row) where cluster < {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} as materialized (select row, min({{'d': d, 'c': cluster}}) as best from (
  select row, cluster, cast(sum((v.x - c.x) * (v.x - c.x)) as bigint) as d from v join c{r} c using (i) group by row, cluster) group by row)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} as materialized (select cluster, i, coalesce((s - ((s % n) + n) % n) // n, c{r}.x) as x from c{r} left join (
  select best.c as cluster, i, cast(sum(x) as bigint) as s, count(*) as n from v join a{r} using (row) group by 1, 2) using (cluster, i))""")
    return f"""with {', '.join(steps)},
h as (select cluster, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from c{ROUNDS} group by cluster)
select vec_id, cast(best.c as int) as cluster, best.d as distance, cast(sum(best.d) over (partition by best.c) as bigint) as cluster_inertia,
  cast(sum(best.d) over () as bigint) as inertia, centroid_sha256 from a{ROUNDS} join kept using (row) join h on h.cluster = best.c"""


OP13_SQL = _sql()
