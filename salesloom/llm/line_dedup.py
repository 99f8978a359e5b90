"""Boilerplate lines by their frequency relative to the site, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import stage, unused

RATIO = 0.05
MIN_PAGES = 3
_EDGES = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """What two lines are compared by: the line without blanks at its ends."""
    return F.btrim(line, F.lit(_EDGES))


def boilerplate(
    docs: DataFrame, *, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): for each host the lines on more than ``ratio`` of its pages and ``min_pages`` or more.

    A line counts once a page. A host's array holds at most its lines per page, on average, divided
    by ``ratio``, however many pages it has. Counts are summed before the shuffle, so neither a hot
    host nor a hot line gathers its rows in one task.
    """
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    totals = stage(pages.groupBy("host").agg(F.count("*").alias("pages")), "host-pages")
    distinct = F.array_distinct(F.transform(_lines(F.col("text")), _key))
    counts = (
        pages.select("host", F.explode(distinct).alias("line"))
        .filter("line <> ''")
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    counts = stage(counts, "line-pages").withColumnRenamed("host", "at")
    frequent = counts.join(totals, F.col("at").eqNullSafe(F.col("host"))).filter(
        F.col("n") / F.col("pages") > ratio
    )
    return stage(frequent.groupBy("host").agg(F.collect_list("line").alias("lines")), "boilerplate")


def drop_boilerplate(
    docs: DataFrame,
    *,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the boilerplate lines of its host taken out of each text.

    Lines end at a line feed; blank lines are never boilerplate. A text that loses no line stays
    byte for byte; one that loses all becomes empty, and the row stays. NULL texts stay NULL; rows
    with a NULL host form one host; repeated rows count as pages of their own; an empty table gives
    no rows. ``counts`` names two columns to add: lines before, and lines dropped.
    """
    found = boilerplate(docs, host_col=host_col, text_col=text_col, ratio=ratio, min_pages=min_pages)
    host, gone = unused(docs.columns, "host"), unused(docs.columns, "lines")
    found = found.select(F.col("host").alias(host), F.col("lines").alias(gone))
    joined = docs.join(found, F.col(host_col).eqNullSafe(F.col(host)), "left")
    kept_name = unused(docs.columns, "kept")
    kept = F.filter(_lines(F.col(text_col)), lambda x: ~F.array_contains(F.col(gone), _key(x)))
    joined = joined.withColumn(kept_name, F.when(F.col(gone).isNotNull(), kept))
    text = F.when(F.col(kept_name).isNull(), F.col(text_col)).otherwise(F.array_join(kept_name, "\n"))
    out = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        before = F.coalesce(F.size(_lines(F.col(text_col))), F.lit(0))
        before = F.when(F.col(text_col).isNull(), 0).otherwise(before).cast("long")
        after = F.when(F.col(kept_name).isNull(), before).otherwise(F.size(kept_name)).cast("long")
        out += [before.alias(counts[0]), (before - after).alias(counts[1])]
    return joined.select(*out)
