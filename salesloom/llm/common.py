"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.sources.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 8 << 20


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; NULL counts as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores put before it until no column is called that."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Keep batches of long texts small: 8 MB to Python at a time, unless the session asks for less.

    The number of rows, Spark's own limit, says nothing about texts of very different length. The
    setting stays with the session, as results are computed after an operator has returned.
    """
    now = spark.conf.get(_BATCH).rstrip("bB")
    if not now.isdigit() or int(now) > _BATCH_BYTES:
        spark.conf.set(_BATCH, str(_BATCH_BYTES))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and frees its shuffles."""
    return materialize(df, label)
