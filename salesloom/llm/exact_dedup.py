"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of fixed size. Distinct blocks are sorted and numbered; then
adjacent pairs of numbers are named by sorting and numbering the distinct pairs, again and again,
until each text has one number. Equal numbers (at an equal count of blocks) mean equal texts: the
names are ranks, so no two different texts can ever share one.

Blocks travel through one shuffle only. They are ordered by a 64-bit hash first and, where blocks
share a hash, by their bytes; after that a block is known by its hash and that tie number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import BLANKS, stage
from salesloom.operators.numbering import number_rows

BLOCK = 4096


def normalised(text: Column) -> Column:
    """Runs of ASCII blanks become one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _blocks(data: Column, size: int) -> Column:
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / size)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, F.lit(size))
    )


def _block_names(data: DataFrame, size: int, block_hash: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(h, tie, name) of all distinct blocks, and (h, block, tie) of those that share a hash."""
    blocks = data.select(F.explode(_blocks(F.col("data"), size)).alias("block"))
    blocks = blocks.select(block_hash(F.col("block")).alias("h"), "block").distinct()
    per_hash = stage(blocks.groupBy("h").agg(F.count("*").alias("n")), "block-hashes")
    shared = per_hash.filter("n > 1").select("h")
    tied = blocks.join(shared, "h").withColumn(
        "tie", F.row_number().over(Window.partitionBy("h").orderBy("block"))
    )
    tied = stage(tied.select("h", "block", "tie"), "tied-blocks")
    every = per_hash.filter("n = 1").select("h", F.lit(0).alias("tie")).union(tied.select("h", "tie"))
    return number_rows(every, ["h", "tie"], "name"), tied


def document_names(
    data: DataFrame, size: int = BLOCK, block_hash: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """(row, blocks, name) for rows (row, data): equal bytes have equal blocks and name, others not."""
    names, tied = _block_names(data, size, block_hash)
    pieces = data.select("row", F.posexplode(_blocks(F.col("data"), size)).alias("pos", "block"))
    pieces = pieces.select("row", "pos", block_hash(F.col("block")).alias("h"), "block")
    if tied.isEmpty():
        found = pieces.select("row", "pos", "h", F.lit(0).alias("tie"))
    else:
        other = tied.select(F.col("h").alias("th"), F.col("block").alias("tb"), "tie")
        found = pieces.join(other, (F.col("h") == F.col("th")) & (F.col("block") == F.col("tb")), "left")
        found = found.select("row", "pos", "h", F.coalesce("tie", F.lit(0)).alias("tie"))
    found = stage(found, "pieces")
    now = stage(found.join(stage(names, "block-names"), ["h", "tie"]).select("row", "pos", "name"), "named")
    counts = stage(found.groupBy("row").agg(F.count("*").alias("blocks")), "block-counts")
    now = stage(now.join(counts, "row"), "named")
    done = now.filter("blocks = 1").select("row", "blocks", "name")
    left = counts.agg(F.max("blocks").alias("most")).first()["most"] or 1
    now = now.filter("blocks > 1")
    while left > 1:
        half = (F.col("pos") / 2).cast("int")
        first = F.max(F.when(F.col("pos") % 2 == 0, F.col("name")))
        second = F.max(F.when(F.col("pos") % 2 == 1, F.col("name")))
        pairs = now.groupBy("row", "blocks", half.alias("pos")).agg(
            first.alias("l"), F.coalesce(second, F.lit(0)).alias("r")
        )
        pairs = stage(pairs, "pairs")
        names = stage(number_rows(pairs.select("l", "r").distinct(), ["l", "r"], "name"), "pair-names")
        now = stage(pairs.join(names, ["l", "r"]).select("row", "blocks", "pos", "name"), "named")
        left = (left + 1) // 2
    return done.union(now.select("row", "blocks", "name"))


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = BLOCK,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII blanks became one space; NULL counts as
    empty. Of equal texts the row with the smallest id stays, a NULL id comes last, and of repeated
    rows with one id a single one stays. An empty table gives no rows; other columns are not read.
    """
    text = normalised(F.col(text_col))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = stage(
        source.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
            F.col("text").cast("binary").alias("data"),
        ),
        "rows",
    )
    named = document_names(rows.select("row", "data"), size, block_hash)
    listed = stage(rows.select("row", "doc_id", "text_sha256").join(stage(named, "names"), "row"), "listed")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "row"))
    groups = stage(
        listed.groupBy("blocks", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "groups"
    )
    return listed.join(groups, ["blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
