"""Helpers that the operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of the contracts, as a Java and Python character class.
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``.

    A local session that names none gets one of its own; on a cluster that is
    an error, as the executors would write to their own disks.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    # Spark gives each application a folder of its own in there; it goes when the driver's JVM ends.
    return _until_exit(spark, context._jsc.sc().getCheckpointDir().get())


def _until_exit(spark: SparkSession, folder: str) -> str:
    path, store = _at(spark, folder)
    store.deleteOnExit(path)
    return folder


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, in the store that all executors share."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, store = _at(spark, folder)
    store.delete(path, True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Arrow batches to Python of at most about ``size`` while jobs of long rows run; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, folder: str, block: int | None = None) -> DataFrame:
    """``df`` written as Parquet and read back; ``block``: bytes of a row group, which readers of long rows hold whole."""
    (df.write.option("parquet.block.size", block) if block else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def own_names(df: DataFrame, *kept: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with all columns but ``kept`` under names that no operator uses, and each old column by its new name."""
    names = {c: c if c in kept else f"_own{i}" for i, c in enumerate(df.columns)}
    return df.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), {c: F.col(n).alias(c) for c, n in names.items()}


def tree_sum(rows: DataFrame, size: int, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of the arrays of ``size`` counts that ``count`` makes of each task's rows, added up as a tree.

    There is one array a task, so tasks are as few as the cluster has cores; arrays travel packed, as most counts are small.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([packed(count(batches))], pa.binary())], names=["counts"])

    def packed(counts: np.ndarray) -> bytes:
        return zlib.compress(counts.astype(np.int64).tobytes(), 1)

    def unpacked(counts: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(counts), np.int64)

    arrays = few_tasks(rows).mapInArrow(counted, "counts binary").rdd.map(lambda r: bytes(r["counts"]))
    if not arrays.getNumPartitions():
        return np.zeros(size, np.int64)
    return unpacked(arrays.treeReduce(lambda a, b: packed(unpacked(a) + unpacked(b)), 2))


def few_tasks(rows: DataFrame) -> DataFrame:
    return rows.coalesce(max(2, rows.sparkSession.sparkContext.defaultParallelism))


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
}


def arrow_rows(rows: Sequence[tuple], schema: str) -> pa.RecordBatch:
    """Row tuples as one Arrow batch of a ``"name type, ..."`` schema; None stays null."""
    fields = [part.split(" ") for part in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), _ARROW[t]) for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])
