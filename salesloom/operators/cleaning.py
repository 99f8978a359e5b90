"""From an all-text file to clean typed rows, in one narrow projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.dates import parse_day_first
from salesloom.functions.numbers import has_exponent, parse_number
from salesloom.functions.text import collapse_blanks, fold_accents, proper_case, strip
from salesloom.schemas import CODE_COLUMNS, DATE_COLUMNS, NUMBER_COLUMNS, STAGING

# What a missing rate or cost counts as.
FILL_ZERO = ["discount", "shipping_cost"]

# Numbers keep all their digits until the load casts them to the column's type.
WIDE = "decimal(38,10)"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def clean_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: parse_day_first(F.col(c)) for c in _present(df, DATE_COLUMNS)})


def amount(column: str) -> Column:
    """The number a cell holds, not yet cut to the column's type; NULL where it holds none.

    Fractional quantities round to whole units.
    """
    wide = parse_number(F.col(column), WIDE)
    return F.round(wide, 0) if column == "quantity" else wide


def fits(column: str) -> Column:
    """False where the column's type can't hold the number."""
    return amount(column).try_cast(STAGING[column].dataType).isNotNull()


def clean_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: amount(c) for c in _present(df, NUMBER_COLUMNS)})


def tidy_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One space between words, no accents."""
    collapsed = df.withColumns({c: collapse_blanks(F.col(c)) for c in columns})
    return fold_accents(collapsed, columns)


def cased(column: str, text: Column) -> Column:
    """Codes in upper case, names in proper case."""
    return F.upper(text) if column in CODE_COLUMNS else proper_case(text)


def clean_text(df: DataFrame) -> DataFrame:
    """All text columns tidied and cased; NULL stays NULL."""
    columns = text_columns(df)
    return tidy_text(df, columns).withColumns({c: cased(c, F.col(c)) for c in columns})


def drop_undated(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["order_date"])


def fill_missing(df: DataFrame) -> DataFrame:
    return df.na.fill(0, subset=_present(df, FILL_ZERO))


def clean(raw: DataFrame) -> DataFrame:
    """The whole cleaning step; rows without an order date are dropped."""
    return fill_missing(drop_undated(clean_text(clean_numbers(clean_dates(raw)))))


def invalid_numbers(raw: DataFrame) -> DataFrame:
    """Every number cell without a value, with a swallowed exponent or out of its type's range, and its raw text."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(c).alias("raw_value"),
                    F.when(F.col(c).isNull() | (strip(F.col(c)) == ""), "missing")
                    .when(has_exponent(F.col(c)), "exponent")
                    .when(amount(c).isNull(), "unreadable")
                    .when(~fits(c), "out_of_range")
                    .alias("reason"),
                )
                for c in _present(raw, NUMBER_COLUMNS)
            ]
        )
    )
    found = raw.select("order_id", cells.alias("cell")).where("cell.reason is not null")
    return found.select("cell.column", "order_id", "cell.raw_value", "cell.reason")


def _long(row: DataFrame, keys: Sequence[str], entries: list[tuple], value: str) -> DataFrame:
    """Turn a one-row frame of counters into (keys..., value) rows."""
    structs = [
        F.struct(
            *[F.lit(k).alias(name) for name, k in zip(keys, labels, strict=True)],
            F.col(counter).cast("long").alias(value),
        )
        for *labels, counter in entries
    ]
    return row.select(F.explode(F.array(*structs)).alias("e")).select("e.*")


def change_counts(raw: DataFrame) -> DataFrame:
    """How many values each text rule changes, per column, in one pass over the raw rows."""
    columns = text_columns(raw.drop(*DATE_COLUMNS, *NUMBER_COLUMNS))
    copies = raw.select(*columns, *[F.col(c).alias(f"{c}_t") for c in columns])
    tidied = tidy_text(copies, [f"{c}_t" for c in columns])
    counters, entries = [], []
    for c in columns:
        before, after = F.col(c), F.col(f"{c}_t")
        rule = "upper" if c in CODE_COLUMNS else "proper_case"
        counters.append(F.count_if(~before.eqNullSafe(after)).alias(f"{c}_1"))
        counters.append(F.count_if(~after.eqNullSafe(cased(c, after))).alias(f"{c}_2"))
        entries += [(c, "tidy", f"{c}_1"), (c, rule, f"{c}_2")]
    return _long(tidied.agg(*counters), ["column", "rule"], entries, "changed")


def null_date_counts(raw: DataFrame) -> DataFrame:
    """Unreadable or missing dates per date column."""
    columns = _present(raw, DATE_COLUMNS)
    row = clean_dates(raw).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(row, ["column"], [(c, c) for c in columns], "null_dates")


def number_error_counts(raw: DataFrame) -> DataFrame:
    """Per number column: cells that had text but no value, and all cells without value."""
    columns = _present(raw, NUMBER_COLUMNS)
    typed = raw.select(*columns, *[amount(c).alias(f"{c}_v") for c in columns])
    counters, structs = [], []
    for c in columns:
        empty = F.col(f"{c}_v").isNull()
        counters.append(F.count_if(empty & F.col(c).isNotNull()).alias(f"{c}_new"))
        counters.append(F.count_if(empty).alias(f"{c}_all"))
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}_new").alias("new_errors"),
                F.col(f"{c}_all").alias("total_null"),
            )
        )
    row = typed.agg(*counters)
    return row.select(F.explode(F.array(*structs)).alias("e")).select("e.*")


def undated_share(raw: DataFrame) -> DataFrame:
    """Rows the missing order date drops, and their share."""
    undated = F.count_if(F.col("order_date").isNull())
    return clean_dates(raw).agg(
        F.count("*").alias("rows_before"),
        undated.alias("dropped"),
        F.round(
            undated.cast("double") / F.nullif(F.count("*").cast("double"), F.lit(0.0)), 6
        ).alias("dropped_ratio"),
    )


def filled_counts(raw: DataFrame) -> DataFrame:
    """Values set to zero per filled column, among the rows that are kept."""
    columns = _present(raw, FILL_ZERO)
    kept = drop_undated(clean_dates(raw))
    row = kept.agg(*[F.count_if(amount(c).isNull()).alias(c) for c in columns])
    return _long(row, ["column"], [(c, c) for c in columns], "filled")
