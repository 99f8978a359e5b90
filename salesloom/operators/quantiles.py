"""Exact quantiles of weighted values, found without gathering the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.numbering import place_rows


def exact_quantiles(values: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per column.

    ``values`` has distinct (column, x) with weight n. The values are range
    sorted once; partition totals, one row per partition and column, tell which
    partition holds each wanted rank, and only those partitions are scanned by a
    running sum. Result: (column, p, quantile).
    """
    placed = place_rows(values, ["column", "x"])
    # Bounded by range partitions times columns.
    parts = placed.groupBy("column", "_part").agg(F.sum("n").alias("weight"))
    earlier = Window.partitionBy("column").orderBy("_part")
    parts = parts.select(
        "column",
        "_part",
        "weight",
        (F.sum("weight").over(earlier) - F.col("weight")).alias("before"),
    )
    totals = parts.groupBy("column").agg(F.sum("weight").alias("total"))
    wanted = totals.select(
        "column", "total", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    ).withColumn("position", F.col("p") * (F.col("total") - 1))
    ranks = wanted.select(
        "column",
        "p",
        "position",
        F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))).alias("rank"),
    )
    # Equal column, then a range test among that column's few partition totals.
    located = (
        ranks.join(parts, "column")
        .where("rank >= before and rank < before + weight")
        .select("column", "_part", "p", "position", F.col("rank") - F.col("before"), "rank")
        .toDF("column", "_part", "p", "position", "offset", "rank")
    )
    targets = located.select("column", "_part").distinct()
    running = Window.partitionBy("column", "_part").orderBy("x")
    scanned = placed.join(F.broadcast(targets), ["column", "_part"], "left_semi").withColumn(
        "through", F.sum("n").over(running)
    )
    hits = scanned.join(F.broadcast(located), ["column", "_part"]).where(
        "offset < through and offset >= through - n"
    )
    lower = F.min(F.when(F.col("rank") == F.floor("position"), F.col("x")))
    upper = F.max(F.when(F.col("rank") == F.ceil("position"), F.col("x")))
    part = F.first("position") - F.floor(F.first("position"))
    return hits.groupBy("column", "p").agg((lower + (upper - lower) * part).alias("quantile"))
