"""From raw documents to token ids: five stages, each written and read again before the next.

Every stage works on all rows that the one before kept, and all but the last return the columns
they were given. Texts that lose lines have their ``n_chars`` counted anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import bpe, line_dedup, mixing, quality, simhash
from salesloom.llm.common import stage as written
from salesloom.llm.common import unused, utf8


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.scorer(model)(utf8(F.col("text"))) >= quality.THRESHOLD)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a site go; the documents stay."""
    clean = line_dedup.drop_boilerplate(docs)
    if "n_chars" not in docs.columns:
        return clean
    count = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return clean.select(*[count.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of three words, three bits."""
    return simhash.keep_one(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, so not at all or up to three times."""
    mixed = mixing.mix(docs, keep=docs.columns)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    repeated = mixed.filter("copies > 0").select(
        copy.alias(unused(docs.columns, "copy")), *[F.col(f"kept_{c}").alias(c) for c in docs.columns]
    )
    return repeated.select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and hashes of the ids and of what they decode to."""
    return bpe.encode_documents(docs, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: A trained classifier decides which documents stay, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
