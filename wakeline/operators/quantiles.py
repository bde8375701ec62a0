"""Exact quantiles of many groups by counting: no group's values are ever held together.

A quantile lies between two values known by their rank. Rounds of counting narrow the
stretch that holds a rank: its values are counted in ``CELLS`` equal cells, the cell with the rank is the
next stretch, between the least and the largest value in it, until those are one. The
driver sees at most ``CELLS`` counts for each stretch; groups are few.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 256


def _ranks(n: int, share: float) -> tuple[int, int, float]:
    """The ranks on both sides of a quantile of n values and how far it lies between them."""
    at = share * (n - 1)
    low = min(math.floor(at), n - 1)
    return low, min(low + 1, n - 1), at - low


def _narrowed(counts: DataFrame, group: str, stretches: list[tuple], cells: int) -> dict[tuple, list[tuple]]:
    """For each stretch (group, column, low, high) its cells (cell, n, least, most), in order."""
    table = counts.sparkSession.createDataFrame([(i, *s) for i, s in enumerate(stretches)], f"_s int, {group} {counts.schema[group].dataType.simpleString()}, column string, low double, high double")
    met = counts.join(F.broadcast(table.withColumnRenamed(group, "_group").withColumnRenamed("column", "_column")), F.col(group).eqNullSafe(F.col("_group")) & (F.col("column") == F.col("_column")) & F.col("v").between(F.col("low"), F.col("high")))
    # Infinite values have cells of their own; halves where the difference of two finite values is infinite.
    low, high = (F.greatest(F.least(F.col(c), F.lit(sys.float_info.max)), F.lit(-sys.float_info.max)) for c in ("low", "high"))
    scale = F.when(high - low == math.inf, 0.5).otherwise(1.0)
    inner = F.least(F.floor((F.col("v") * scale - low * scale) / F.nullif(high * scale - low * scale, F.lit(0.0)) * cells), F.lit(cells - 1))
    cell = F.when(F.col("v") == -math.inf, -1).when(F.col("v") == math.inf, cells).otherwise(F.coalesce(inner, F.lit(0))).alias("cell")
    found: dict[tuple, list[tuple]] = {}
    for r in met.groupBy("_s", cell).agg(F.sum("n").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect():
        found.setdefault(stretches[r["_s"]], []).append((r["cell"], r["n"], r["a"], r["b"]))
    return {s: sorted(c) for s, c in found.items()}


def exact_quantiles(rows: DataFrame, group: str, columns: Sequence[str], shares: Sequence[float], cells: int = CELLS) -> DataFrame:
    """(group, column, i, value): the i-th share's quantile of each column, linear between the two values around it.

    Nulls and NaN are left out; infinite values count, and one between both infinities is NaN; a group without values has no rows; a null group is a group. Equal values are counted together first.
    """
    spark = rows.sparkSession
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]))
    long = rows.select(group, pairs.alias("p")).select(group, "p.column", "p.v").where("v is not null and not isnan(v)")
    counts = long.groupBy(group, "column", "v").agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = counts.groupBy(group, "column").agg(F.sum("n").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect()
        wanted = {(r[group], r["column"]): [_ranks(r["n"], s) for s in shares] for r in facts}
        known: dict[tuple, float] = {}
        open_ranks: dict[tuple, tuple] = {}  # (group, column, rank) -> (low, high, values below low)
        for r in facts:
            for rank in {x for pair in wanted[r[group], r["column"]] for x in pair[:2]}:
                open_ranks[r[group], r["column"], rank] = (r["a"], r["b"], 0)
        while open_ranks:
            for key in [k for k, (a, b, _) in open_ranks.items() if a == b]:
                known[key] = open_ranks.pop(key)[0]
            if not open_ranks:
                break
            found = _narrowed(counts, group, sorted({(g, c, a, b) for (g, c, _), (a, b, _) in open_ranks.items()}, key=str), cells)
            for (g, c, rank), (a, b, below) in open_ranks.items():
                for _, n, least, most in found[g, c, a, b]:
                    if rank < below + n:
                        open_ranks[g, c, rank] = (least, most, below)
                        break
                    below += n
    finally:
        counts.unpersist()
    values = []
    for (g, c), pairs_ in wanted.items():
        for i, (low, high, between) in enumerate(pairs_):
            a, b = known[g, c, low], known[g, c, high]
            values.append((g, c, i, a if a == b or not between else a * (1 - between) + b * between if math.isinf(b - a) else a + (b - a) * between))
    return spark.createDataFrame(values, f"{group} {rows.schema[group].dataType.simpleString()}, column string, i int, value double")
