"""Cleaning rules on hand-made rows."""

import datetime
import decimal
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.functions.dates import parse_day_first
from salesloom.functions.numbers import decimal_digits, integer_digits, parse_number
from salesloom.functions.text import _UNTIDY, collapse_blanks, fold_accents, is_ascii, proper_case, strip
from salesloom.operators import cleaning
from salesloom.schemas import RAW


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    rows = df.select("i", build(F.col("s")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


def test_dates(spark):
    texts = ["1/1/2011", "14-12-2014", "31.12.2011", " 05/07/1996 ", "12/31/2011", "31/2/2011",
             "2011-01-02", "", None]
    d = datetime.date
    assert apply(spark, texts, parse_day_first) == [
        d(2011, 1, 1), d(2014, 12, 14), d(2011, 12, 31), d(1996, 7, 5), None, None, None, None, None]


def test_numbers(spark):
    texts = ["1,791", "(12.5)", "$1,234.5", " 7 ", "1-5", "", ".", "-", "1.", "-3.25", "()", "1e3",
             "n/a", None]
    got = apply(spark, texts, lambda c: parse_number(c, "decimal(18,2)"))
    want = ["1791", "-12.5", "1234.5", "7", None, None, None, None, "1", "-3.25", None, "13", None,
            None]
    assert got == [None if w is None else decimal.Decimal(w).quantize(decimal.Decimal("0.01"))
                   for w in want]


def test_quantity_rounds_to_whole_units(spark):
    df = spark.createDataFrame([("2.5",), ("3",), ("x",)], "quantity string")
    assert [r[0] for r in cleaning.clean_numbers(df).collect()] == [3, 3, None]


BLANKS = [" a  b ", "a\tb", "a\r\nb", "a  b", " a", "a\x1cb", "ab", "", " ", None, "é  é"]


def test_numbers_beyond_the_type_are_kept_and_reported(spark):
    raw = spark.createDataFrame([("1", "12.345", "50"), ("2", "1", None)], "order_id string, sales string, discount string")
    cleaned = cleaning.fill_missing(cleaning.clean_numbers(raw)).orderBy("order_id").collect()
    assert [(float(r["sales"]), float(r["discount"])) for r in cleaned] == [(12.345, 50.0), (1.0, 0.0)]
    found = {(r["column"], r["raw_value"], r["reason"]) for r in cleaning.invalid_numbers(raw).collect()}
    assert found == {("discount", "50", "out_of_range"), ("discount", None, "missing")}


def test_blanks(spark):
    want = [None if t is None else " ".join(t.split()) for t in BLANKS]
    assert apply(spark, BLANKS, collapse_blanks) == want
    assert apply(spark, BLANKS, strip) == [None if t is None else t.strip() for t in BLANKS]


def expected_fold(text):
    parts = unicodedata.normalize("NFKD", text)
    return "".join(c for c in parts if not unicodedata.combining(c))


def fold_all(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r["s"] for r in sorted(fold_accents(df, ["s"]).collect(), key=lambda r: r["i"])]


def test_accents(spark):
    texts = ["Yucatán", "Provence-Alpes-Côte d'Azur", "søren ß", "ﬁne ½ … ™", "éà",
             "한국어", "Ελλάδα", "Việt Nam", "日本 ｶﾞ", "plain", "", None]
    got = fold_all(spark, texts)
    assert got == [None if t is None else expected_fold(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=20, max_size=60))
def test_accents_equal_nfkd_on_any_text(spark, texts):
    assert fold_all(spark, texts) == [expected_fold(t) for t in texts]


def test_every_letter_folds_like_nfkd(spark):
    chars = [chr(c) for c in range(0x80, 0x3400)] + [chr(c) for c in range(0xF900, 0xFFFE)]
    assert fold_all(spark, chars) == [expected_fold(c) for c in chars]


def test_ascii(spark):
    assert apply(spark, ["abc", "é", "", None], is_ascii) == [True, False, True, None]


CASES = ["OIC push pins, bulk pack", "o'brien mc-donald", "8.5 x 11", "3d printer", "x1y2z", "a_b",
         "UPPER lower", "it's ok", "'ajman", "", "søren KIERKEGAARD", None]


def test_proper_case(spark):
    want = [t if t is None or not t.isascii() else t.title() for t in CASES]
    assert apply(spark, CASES, proper_case) == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=126)), min_size=50))
def test_proper_case_is_title(spark, texts):
    assert apply(spark, texts, proper_case) == [t.title() for t in texts]


def test_digits(spark):
    values = [decimal.Decimal(v) for v in ("106.14000", "-26.05500", "0.00000", "12345.00000")]
    assert apply(spark, values, integer_digits, "decimal(18,5)") == [3, 2, 1, 5]
    assert apply(spark, values, decimal_digits, "decimal(18,5)") == [2, 3, 0, 0]


# Lines of a raw file and what cleaning makes of them.
RAW_LINE = ["ag-2011-2040", "1/1/2011", "6-1-2011", "standard class", "toby braunhardt", "consumer",
            "Yucatán", "Provence-Alpes-Côte d'Azur", "Africa", "Oceania", "off-ten-1",
            "office  supplies", "storage", "OIC Push Pins,\r\nBulk Pack", "1,791", "2", None,
            "(106.14)", "", "Medium", "2011"]


@pytest.fixture(scope="module")
def cleaned(spark):
    undated = ["x", "soon", *RAW_LINE[2:]]
    return cleaning.clean(spark.createDataFrame([RAW_LINE, undated], RAW)).collect()


def test_clean_drops_undated_rows(cleaned):
    assert len(cleaned) == 1


def test_clean_row(cleaned):
    row = cleaned[0].asDict()
    assert row["order_id"] == "AG-2011-2040" and row["region"] == "OCEANIA"
    assert row["order_date"] == datetime.date(2011, 1, 1)
    assert row["ship_date"] == datetime.date(2011, 1, 6)
    assert row["state"] == "Yucatan" and row["country"] == "Provence-Alpes-Cote D'Azur"
    assert row["category"] == "Office Supplies"
    assert row["product_name"] == "Oic Push Pins, Bulk Pack"
    assert row["sales"] == 1791 and row["profit"] == decimal.Decimal("-106.14")
    assert row["discount"] == 0 and row["shipping_cost"] == 0 and row["quantity"] == 2


def test_missing_text_stays_missing(spark):
    line = [None if c in ("segment", "order_id") else v
            for c, v in zip(RAW.names, RAW_LINE, strict=True)]
    row = cleaning.clean(spark.createDataFrame([line], RAW)).first()
    assert row["segment"] is None and row["order_id"] is None


def test_invalid_report_keeps_the_text(spark):
    bad = dict(zip(RAW.names, RAW_LINE, strict=True), sales="n/a", quantity="1e3", discount="0.1",
               shipping_cost=" ")
    df = spark.createDataFrame([[bad[c] for c in RAW.names]], RAW)
    found = {(r["column"], r["raw_value"], r["reason"]) for r in cleaning.invalid_numbers(df).collect()}
    assert found == {("sales", "n/a", "unreadable"), ("quantity", "1e3", "exponent"),
                     ("shipping_cost", " ", "missing")}


def test_only_blanks_that_are_no_single_space_are_collapsed(spark):
    texts = ["", "a", "a b", "a  b", " a", "a ", " ", "a\tb", "a\nb", "a \n", "\x00", "é", "a é", "\U0001f600 b", "~ !"]
    old = r"[^\x20-\x7E]|^ | $|  "
    found = apply(spark, texts, lambda c: F.struct(c.rlike(_UNTIDY).alias("now"), c.rlike(old).alias("old")))
    assert [r["now"] for r in found] == [r["old"] for r in found]
