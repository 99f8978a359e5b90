"""Number parsing, ratios and printed forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.functions.text import strip


def number_text(text: Column) -> Column:
    """Digits, point and minus of a printed amount; ``(x)`` means minus x.

    Where there is no parenthesis, the last step takes out blanks and commas with all else.
    """
    plain = F.replace(strip(text), F.lit(","), F.lit(""))
    in_parentheses = plain.startswith("(") & plain.endswith(")") & (F.length(plain) > 2)
    inside = F.concat(F.lit("-"), F.substring(plain, F.lit(2), F.length(plain) - 2))
    signed = F.when(text.contains("("), F.when(in_parentheses, inside).otherwise(plain)).otherwise(text)
    return F.regexp_replace(signed, r"[^\d.\-]", "")


def parse_number(text: Column, sql_type: str) -> Column:
    """Amount as ``sql_type``, NULL where the text holds none."""
    return number_text(text).try_cast(sql_type)


def has_exponent(text: Column) -> Column:
    """True for forms like 1e3, whose exponent the amount rule would swallow."""
    return text.rlike(r"[0-9.][eE][+-]?[0-9]")


def ratio(numerator: Column, denominator: Column, digits: int, scale: float = 1.0) -> Column:
    """Rounded quotient of two sums; NULL over zero."""
    bottom = F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.round(numerator.cast("double") / bottom * F.lit(scale), digits)


def money(amount: Column, digits: int = 2) -> Column:
    """An exact amount as the double a report shows."""
    return F.round(amount, digits).cast("double")


def whole_number_text(amount: Column) -> Column:
    """Thousands-separated text of the amount, halves rounded away from zero."""
    return F.format_number(F.round(amount, 0), 0)


def _printed(amount: Column) -> Column:
    return F.when(amount.isNotNull(), F.format_string("%.6f", amount.cast("double")))


def integer_digits(amount: Column) -> Column:
    """Number of digits before the point."""
    text = _printed(amount)
    return F.length(F.replace(F.split_part(text, F.lit("."), F.lit(1)), F.lit("-"), F.lit("")))


def decimal_digits(amount: Column) -> Column:
    """Number of digits after the point, trailing zeros not counted, six at most."""
    text = _printed(amount)
    return F.length(F.rtrim(F.split_part(text, F.lit("."), F.lit(2)), F.lit("0")))
