"""Connected components by alternating stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import stage

_MOST_ROUNDS = 60  # the number of rounds grows with the logarithm of the longest path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b: neighbours of a node move to its smallest one."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # Written first, so that the join below sees two plain exchanges and can split a hot node.
    least = stage(around.groupBy("u").agg(F.min("v").alias("m")), "least")
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return stage(moved.filter("a <> b").distinct(), "star")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node it can reach.

    Self edges and NULL ends are ignored; repeated and reversed edges count once; no edges give no
    rows. A node with very many neighbours is pre-aggregated to its minimum, and only joins, which
    adaptive execution splits, ever see all of them.
    """
    edges = (
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = stage(edges, "edges")
    before = None
    for _ in range(_MOST_ROUNDS):
        edges = _star(_star(edges, large=True), large=False)
        now = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if (now["n"], now["x"]) == before:
            break
        before = (now["n"], now["x"])
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
