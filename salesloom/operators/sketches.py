"""Profiles that can be stored per part of a table and merged, without reading rows again.

Counts, sums and ends merge exactly. Distinct values, quantiles and the most frequent values are
sketches of bounded size: with the sizes here, a distinct count is within 5 % and a quantile within
2 % of the ranks, at any number of rows. A value's estimated frequency is never below
its true one, and above it by at most 1 % of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_ERROR = 0.05
RANK_ERROR = 0.02
FREQUENCY_ERROR = 0.01
_HLL = 14  # 2**14 registers: standard error below 1 %
_KLL = 400
_TOP = 2048  # tracked values


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _of_column(field: T.StructField) -> Column:
    value, text = F.col(field.name), F.col(field.name).cast("string")
    number = value.cast("double") if _is_number(field.dataType) else F.lit(None).cast("double")
    exact = value.cast("decimal(38,6)") if _is_number(field.dataType) else F.lit(None).cast("decimal(38,6)")
    return F.struct(
        F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("missing"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
        F.min(text).alias("first_text"),
        F.max(text).alias("last_text"),
        F.sum(exact).alias("total"),
        F.hll_sketch_agg(text, _HLL).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, _KLL).alias("quantile_sketch"),
        F.expr(f"approx_top_k_accumulate(cast(`{field.name}` as string), {_TOP})").alias("top_sketch"),
    ).alias(field.name)


def profile(df: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    """(part..., column, rows, missing, ends, total, sketches): one row per part and column."""
    fields = [f for f in df.schema.fields if f.name not in part]
    row = df.groupBy(*part).agg(*[_of_column(f) for f in fields])
    parts = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("p")) for f in fields])
    return row.select(*part, F.explode(parts).alias("of")).select(*part, "of.column", "of.p.*")


def merged(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of many parts as one per column, or one per ``by`` and column."""
    return profiles.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min("first_text").alias("first_text"),
        F.max("last_text").alias("last_text"),
        F.sum("total").cast("decimal(38,6)").alias("total"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(top_sketch, {_TOP})").alias("top_sketch"),
    )


def estimates(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """Profiles with their sketches read off: ``distinct``, one column per quantile, and ``top`` values."""
    number = F.col("least").isNotNull()
    read = [
        F.when(number, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))).alias(f"q{round(100 * q)}")
        for q in quantiles
    ]
    plain = [c for c in profiles.columns if not c.endswith("_sketch")]
    return profiles.select(
        *plain, F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *read,
        F.expr(f"approx_top_k_estimate(top_sketch, {top})").alias("top"),
    )
