"""Column profiles and audits.

Most of them share one frame, ``frequencies``: how often each value of each
column occurs. Its grouping combines before it shuffles, so a value that fills
a third of a column travels as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.numbers import decimal_digits, integer_digits
from salesloom.functions.text import collapse_blanks
from salesloom.operators.quantiles import exact_quantiles

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
_NUMBER_FIELDS = ["mean", "std", "min", "q25", "q50", "q75", "max"]


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): every value of every column as text, NULL included."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def missing(df: DataFrame) -> DataFrame:
    """NULLs per column, in one pass without a shuffle of rows."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column", "missing")


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column; ``approximate`` needs one pass and no row shuffle."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return row.unpivot([], df.columns, "column", "unique")
    found = frequencies(df, df.columns)
    return found.groupBy("column").agg(F.count("value").alias("unique"))


def data_types(df: DataFrame) -> DataFrame:
    """Name and type of each column with the number of its non-NULL values."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(c).alias("non_null")
        )
        for c in df.columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _moments(df: DataFrame, columns: Sequence[str], approximate: bool) -> DataFrame:
    """(column, count, and for numbers mean, std, min, max and, if approximate, quartiles), in one pass."""
    numbers = numeric_columns(df)

    def of(c: str) -> Column:
        x = F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
        fields = [
            F.count(c).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"),
        ]
        if approximate:
            fields += [F.percentile_approx(x, p).alias(name) for p, name in QUARTILES.items()]
        return F.struct(*fields).alias(c)

    return df.agg(*[of(c) for c in columns]).unpivot([], list(columns), "column", "m").select("column", "m.*")


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """One row per column: count, unique, top, freq for texts; moments and quartiles for numbers.

    Ties for ``top`` go to the smallest value. Counts and moments take one pass
    without a shuffle of rows; only texts and dates are spread out to find the
    most frequent value. ``approximate`` estimates distinct counts and quartiles
    in that same pass and leaves out ``top`` and ``freq``.
    """
    columns = list(columns or df.columns)
    numbers = [c for c in numeric_columns(df) if c in columns]
    others = [c for c in columns if c not in numbers]
    result = _moments(df, columns, approximate)
    if approximate:
        result = result.join(distinct_counts(df.select(*columns), approximate=True), "column")
        nothing = F.lit(None).cast("string").alias("top"), F.lit(None).cast("long").alias("freq")
        unique = F.when(~F.col("column").isin(numbers), F.col("unique")).alias("unique")
        return result.select("column", "count", unique, *nothing, *_NUMBER_FIELDS)
    if numbers:
        values = df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "x")
        weights = values.where("x is not null").groupBy("column", "x").agg(F.count("*").alias("n"))
        quartiles = (
            exact_quantiles(weights, list(QUARTILES))
            .groupBy("column")
            .agg(
                *[
                    F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
                    for p, name in QUARTILES.items()
                ]
            )
        )
        result = result.join(quartiles, "column", "left")
    if others:
        texts = (
            frequencies(df, others)
            .where("value is not null")
            .groupBy("column")
            .agg(
                F.count("*").alias("unique"),
                # Most frequent first, then smallest: the minimum of (-n, value).
                F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("top"),
            )
            .select("column", "unique", F.col("top.value").alias("top"), (-F.col("top.n")).alias("freq"))
        )
        result = result.join(texts, "column", "left")
    for name, kind in (("unique", "long"), ("top", "string"), ("freq", "long"), *[(q, "double") for q in QUARTILES.values()]):
        if name not in result.columns:
            result = result.withColumn(name, F.lit(None).cast(kind))
    return result.select("column", "count", "unique", "top", "freq", *_NUMBER_FIELDS)


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 100) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


def seeded_sample(df: DataFrame, key: Sequence[str], rows: int = 100, seed: int = 42) -> DataFrame:
    """The ``rows`` rows with the smallest seeded hash: the same ones under any partitioning.

    The hash is MD5 over the printed key, so that other engines can draw the same sample.
    """
    printed = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return df.orderBy(F.md5(printed.cast("binary")), *key).limit(rows)


def unique_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value): the sorted distinct values of the text columns, blanks collapsed."""
    tidied = df.select(*[collapse_blanks(F.col(c)).alias(c) for c in columns])
    return (
        tidied.unpivot([], list(columns), "column", "value")
        .where("value is not null")
        .distinct()
        .orderBy("column", "value")
    )


def unique_text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unique_texts(df, columns).groupBy("column").agg(F.count("*").alias("values"))


def digit_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most and fewest digits before and after the point, per number column."""
    # Counted first and then compared: each value is printed once, not once per measure.
    counted = df.select(
        *[F.struct(integer_digits(F.col(c)).alias("i"), decimal_digits(F.col(c)).alias("d")).alias(c) for c in columns]
    )
    row = counted.agg(
        *[
            F.struct(
                F.max(f"{c}.i").alias("max_int_digits"), F.max(f"{c}.d").alias("max_decimal_digits"),
                F.min(f"{c}.i").alias("min_int_digits"), F.min(f"{c}.d").alias("min_decimal_digits"),
            ).alias(c)
            for c in columns
        ]
    )
    return row.unpivot([], list(columns), "column", "d").select("column", "d.*")


def id_name_conflicts(df: DataFrame) -> DataFrame:
    """All (product_id, product_name) pairs of ids that carry more than one name."""
    pairs = df.select("product_id", "product_name").na.drop(subset=["product_id"]).distinct()
    names = pairs.groupBy("product_id").agg(F.count("product_name").alias("names"))
    return pairs.join(names.where("names > 1"), "product_id", "left_semi").orderBy(
        "product_id", "product_name"
    )


def audit(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, metric, value) with the row, missing and distinct counts of each column.

    Rows and missing values take one pass; only exact distinct counts shuffle values.
    """
    row = df.agg(
        *[
            F.struct(F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("missing")).alias(c)
            for c in df.columns
        ]
    )
    plain = row.unpivot([], df.columns, "column", "m").select("column", "m.*")
    wide = plain.join(distinct_counts(df, approximate), "column")
    return wide.unpivot(["column"], ["rows", "missing", "unique"], "metric", "value")


def compare_audits(before: DataFrame, after: DataFrame, approximate: bool = False) -> DataFrame:
    """The same audit on two frames, side by side."""
    left = audit(before, approximate).withColumnRenamed("value", "before")
    right = audit(after, approximate).withColumnRenamed("value", "after")
    return left.join(right, ["column", "metric"], "full").withColumn(
        "delta", F.col("after") - F.col("before")
    )


def audit_report(df: DataFrame, key: Sequence[str]) -> dict[str, DataFrame]:
    """The audit as one frame per sheet."""
    return {
        "describe": describe(df),
        "missing": missing(df),
        "unique": distinct_counts(df),
        "dtypes": data_types(df),
        "preview": preview(df, key),
        "sample": seeded_sample(df, key),
    }


def row_and_order_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), F.count_distinct("order_id").alias("distinct_orders")
    )


def exact_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Groups of rows equal on ``key``, most frequent first; ties by key, which also spreads the sort."""
    groups = df.groupBy(*key).agg(F.count("*").alias("cnt")).where("cnt > 1")
    return groups.orderBy(F.desc("cnt"), *key)
