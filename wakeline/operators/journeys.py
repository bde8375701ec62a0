"""Journeys: legs chained around an anchor, in closed form with windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULT, Config


def journeys(legs: DataFrame, direction: str, cfg: Config = DEFAULT) -> DataFrame:
    """Inbound or outbound journey of each entity of ``legs``.

    Inbound: the legs up to the first arrival at the anchor from elsewhere,
    back to the last ground stop that is too long; outbound: from the last
    departure elsewhere to the first such stop. A null place is elsewhere.
    """
    at = lambda c: F.col(c).eqNullSafe(F.lit(cfg.anchor))
    w = Window.partitionBy("hex").orderBy("leg_idx")
    whole = Window.partitionBy("hex")
    rows = legs.withColumns({
        "gap_next": F.lead("t_start").over(w) - F.col("t_end"),
        "gap_prev": F.col("t_start") - F.lag("t_end").over(w),
    })
    i = F.col("leg_idx")
    if direction == "inbound":
        rows = rows.withColumn("pivot", F.min(F.when(at("to_apt") & ~at("from_apt"), i)).over(whole))
        rows = rows.withColumn("edge", F.max(F.when((i < F.col("pivot")) & (F.col("gap_next") > cfg.ground_stop_s), i)).over(whole))
        rows = rows.where((i <= F.col("pivot")) & (F.col("edge").isNull() | (i > F.col("edge"))))
    else:
        rows = rows.withColumn("pivot", F.max(F.when(at("from_apt") & ~at("to_apt"), i)).over(whole))
        rows = rows.withColumn("edge", F.min(F.when((i > F.col("pivot")) & (F.col("gap_prev") > cfg.ground_stop_s), i)).over(whole))
        rows = rows.where((i >= F.col("pivot")) & (F.col("edge").isNull() | (i < F.col("edge"))))
    far = F.min_by("from_apt", i) if direction == "inbound" else F.max_by("to_apt", i)
    anchor = F.lit(cfg.anchor)
    return rows.groupBy("hex").agg(
        F.lit(direction).alias("direction"),
        (far if direction == "inbound" else anchor).alias("origin"),
        (anchor if direction == "inbound" else far).alias("destination"),
        F.min("t_start").alias("t_start"),
        F.max_by("t_end", i).alias("t_end"),
        F.count("*").cast("int").alias("n_legs"),
        F.round(F.sum("path_nm"), 1).alias("total_nm"),
        F.sort_array(F.collect_list("t_start")).alias("leg_t_starts"),
    )
