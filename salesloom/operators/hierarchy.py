"""Dimensions of the snowflake: flat members, nested levels, products, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.dates import calendar_columns
from salesloom.operators.numbering import number_rows


def date_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date_id"))


def day_span(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per day from the earliest to the latest date found in ``columns``."""
    ends = df.agg(
        F.least(*[F.min(c) for c in columns]).alias("first"),
        F.greatest(*[F.max(c) for c in columns]).alias("last"),
    )
    return ends.select(F.explode(F.sequence("first", "last")).alias("date_id"))


def calendar(days: DataFrame) -> DataFrame:
    return days.select("date_id", *calendar_columns(F.col("date_id")))


def members(df: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Distinct natural keys, numbered in their own order; incomplete keys are left out."""
    return number_rows(df.select(*natural).na.drop().distinct(), natural, key)


def keyed_hierarchy(paths: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Give every level of a hierarchy its key; a member is its whole path, not its name.

    ``paths`` holds distinct complete paths. Result: one row per path with
    ``<level>_id`` beside each level.
    """
    keyed = paths
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        level_keys = members(paths, path, f"{levels[depth - 1]}_id")
        keyed = keyed.join(level_keys, path)
    return keyed


def level_table(keyed: DataFrame, level: str, parent: str | None = None) -> DataFrame:
    """The stored dimension of one level: key, name and parent key."""
    columns = [F.col(f"{level}_id"), F.col(level).alias(f"{level}_name")]
    if parent:
        columns.append(F.col(f"{parent}_id"))
    return keyed.select(*columns).distinct()


def closure(keyed: DataFrame, levels: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """(depth, level, ancestor_id, ancestor_name, leaf_id): every member above every leaf, and itself.

    ``keyed`` has a row per leaf with ``<level>_id`` and the name of every level above it, topmost
    level first. Depth 0 is everything, whose id is 0. Whatever is grouped by leaf rolls up to any
    level with one join on ``leaf_id``.
    """
    names = names or [f"{level}_name" for level in levels]
    leaf = F.col(f"{levels[-1]}_id").alias("leaf_id")

    def member(depth: int, level: str, key: Column, name: Column) -> Column:
        return F.struct(
            F.lit(depth).alias("depth"), F.lit(level).alias("level"), key.cast("long").alias("ancestor_id"),
            name.cast("string").alias("ancestor_name"),
        )

    whole = member(0, "all", F.lit(0), F.lit(None))
    above = [
        member(depth, level, F.col(f"{level}_id"), F.col(name))
        for depth, (level, name) in enumerate(zip(levels, names, strict=True), 1)
    ]
    return keyed.select(F.explode(F.array(whole, *above)).alias("a"), leaf).select("a.*", "leaf_id")


def first_product(paths: DataFrame) -> DataFrame:
    """One row per (product_id, product_name); the smallest category path wins a clash."""
    return (
        paths.groupBy("product_id", "product_name")
        .agg(F.min(F.struct("category", "sub_category")).alias("path"))
        .select("product_id", "product_name", "path.category", "path.sub_category")
    )


def children_by_name(paths: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Paths that arise when each child is attached to every parent of the same *name*.

    This is the fan-out a name-only parent join produces once a name repeats
    under different grandparents. Works on distinct paths, which are few.
    """
    grown = paths.select(levels[0], levels[1]).distinct()
    for depth in range(2, len(levels)):
        parent, child = levels[depth - 1], levels[depth]
        grown = grown.join(paths.select(parent, child).distinct(), parent).select(
            *levels[:depth], child
        )
    return grown


def false_children(paths: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Children from the name-only join that no source row supports, for every level below the second."""
    audits = []
    for depth in range(3, len(levels) + 1):
        path = list(levels[:depth])
        by_name = children_by_name(paths, path)
        wrong = by_name.join(paths.select(*path).distinct(), path, "left_anti")
        audits.append(
            wrong.select(
                F.lit(levels[depth - 1]).alias("level"),
                *[
                    (F.col(c) if c in path else F.lit(None).cast("string")).alias(c)
                    for c in levels
                ],
            )
        )
    result = audits[0]
    for audit in audits[1:]:
        result = result.unionByName(audit)
    return result
