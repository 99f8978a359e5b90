"""Dense row numbers over a total order, without sending the rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.sources.storage import pass_on

_SLOT = "_slot"
_PART = "_part"
_LINE_VALUES = 4096
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row within partition below


def file_line(df: DataFrame) -> DataFrame:
    """Add ``_line``, a short hash of where the row lies in its file.

    It is the same on every retry, so it can split a group of equal rows over
    several range partitions. It has few values, as it is shuffled with the rows.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return df.withColumn("_line", F.pmod(place, F.lit(_LINE_VALUES)).cast("int"))


def place_rows(df: DataFrame, order_by: Sequence[str], spread_by: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort, note each row's partition and position, and write the result."""
    keys = [*order_by, *spread_by]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(*spread_by)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    return pass_on(placed, "placed").withColumn(
        _PART, F.shiftrightunsigned(_SLOT, _POSITION_BITS)
    )


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    key: str,
    *,
    start: int = 1,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``key`` = start, start+1, ... in the order of ``order_by``.

    Each range partition is counted and its rows get the sum of the partitions
    before it plus their own position. Ties
    must be equal rows (or be told apart by ``order_by``); ``spread_by`` names
    extra columns that only split such ties over partitions.
    """
    placed = place_rows(df, order_by, spread_by)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: bounded by spark.sql.shuffle.partitions.
    offsets = (
        placed.groupBy(_PART)
        .agg(F.count("*").alias("_n"))
        .select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    position = F.col(_SLOT).bitwiseAND((1 << _POSITION_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), _PART)
        .withColumn(key, F.col("_before") + position + F.lit(start))
        .drop(_SLOT, _PART, "_before")
    )


def new_members(
    existing: DataFrame,
    incoming: DataFrame,
    unique: Sequence[str],
    key: str,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Rows to append to a keyed table so that every incoming unique key is present.

    Keys already there are skipped. Where incoming rows disagree on the
    attributes, the smallest attribute tuple wins. New keys continue after the
    largest existing one. Rows with a NULL in the unique key are left out: no
    equality join could ever reach them.
    """
    rows = incoming.na.drop(subset=list(unique))
    if attributes:
        rows = (
            rows.groupBy(*unique)
            .agg(F.min(F.struct(*attributes)).alias("_first"))
            .select(*unique, *[F.col(f"_first.{a}").alias(a) for a in attributes])
        )
    else:
        rows = rows.select(*unique).distinct()
    fresh = pass_on(rows.join(existing.select(*unique), list(unique), "left_anti"), "fresh")
    if fresh.isEmpty():
        return existing.limit(0)
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
    numbered = number_rows(fresh, unique, key, start=top + 1)
    return numbered.select(*existing.columns)


def any_null(columns: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in columns:
        test = test | F.col(name).isNull()
    return test
