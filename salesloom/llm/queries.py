"""One query per operator over its whole table, and the same rows in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    bpe, exact_dedup, language_id, line_dedup, mixing, quality, records, simhash, spelling, suffixes, url_filter,
    vector_search, whitening,
)
from salesloom.llm.common import bounded_batches, stage

RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), RULES)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = docs.select("doc_id", simhash.fingerprint(3)(simhash.utf8(F.col("text"))).alias("fingerprint"))
    found = simhash.attach_components(stage(marked, "fingerprints"), "doc_id", 3)
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_substrings(read(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    clean = line_dedup.drop_boilerplate(docs, counts=("n_lines", "n_dropped"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return clean.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.token_records(read(spark, sf_dir, "documents"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "value")
    rows = found.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", each)
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value.whitened").alias("whitened"),
        F.col("value.explained").alias("explained"), "identity_error",
    )


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(read(spark, sf_dir, "documents"))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_simhash_dedup, op3_byte_bpe, op4_nearest_neighbours, op5_suffix_dedup,
        op6_quality_classifier, op7_mixing, op8_exact_dedup, op9_line_dedup, op10_token_records,
        op11_whitening, op12_language_id, op13_spelling_variants,
    )
}

ORACLE: dict[str, str] = {
    "op7_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM d GROUP BY source),
        f AS (
            SELECT *, 3 * source_size AS cap,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before_me, 0))
                   / sum(weight) OVER from_me AS level
            FROM s
            WINDOW before_me AS (ORDER BY 3 * source_size / weight, source
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   from_me AS (ORDER BY 3 * source_size / weight, source
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        t AS (
            SELECT source, source_size, least(
                weight * (SELECT level FROM f WHERE level * weight <= cap
                          ORDER BY cap / weight, source LIMIT 1),
                CAST(cap AS DOUBLE)) AS target
            FROM f),
        r AS (
            SELECT doc_id, size, source_size, target, target / source_size AS e,
                   CAST('0x' || substr(md5('mix-1' || coalesce('/' || d.source, '')), 1, 8) AS BIGINT)
                   / 4294967296.0 AS u,
                   row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS place
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               CAST(least(floor(u + e * place) - floor(u + e * (place - 1)), 3) * size AS BIGINT) AS taken
        FROM r
    """,
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op9_line_dedup": r"""
        WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        keys AS (SELECT doc_id, source, unnest(list_distinct(list_transform(
                     lines, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM d),
        bad AS (
            SELECT k.source, line FROM keys k
            JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY source) p USING (source)
            WHERE line <> '' GROUP BY k.source, line, pages
            HAVING count(*) >= 3 AND count(*) / pages > 0.05),
        host AS (SELECT source, list(line) AS gone FROM bad GROUP BY source),
        c AS (
            SELECT doc_id, len(lines) AS n_lines, list_filter(lines, lambda x: NOT coalesce(list_contains(
                       gone, trim(x, ' ' || chr(9) || chr(13))), false)) AS kept
            FROM d LEFT JOIN host USING (source))
        SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines,
               CAST(n_lines - len(kept) AS BIGINT) AS n_dropped,
               sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
        FROM c
    """,
}
