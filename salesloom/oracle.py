"""The same results in plain SQL over the base tables, for checking.

Each statement starts from the Parquet tables and builds what it needs as
common table expressions; nothing is shared with the DataFrame code but the
column names.
"""

from __future__ import annotations

from salesloom.schemas import (
    CODE_COLUMNS, DUPLICATE_KEY, NAME_COLUMNS, NUMBER_COLUMNS, RAW, STAGING, TABLES, TEXT_COLUMNS,
)

GEO = "market, region, country, state"
MEASURES = "sales, quantity, discount, profit, shipping_cost"
COMPARED = f"order_id, raw_product_id, product_name, {MEASURES}"
SUMMARY_KEYS = (
    "year, quarter, month, month_name, segment, state_name, region_name, market_name, "
    "category_name, sub_category_name"
)

# name -> (names it needs, body)
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, needs: str, body: str) -> None:
    _PARTS[name] = (tuple(needs.split()), body)


_part("lines", "", """
SELECT *, 'O-' || o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(l_shipdate AS DATE) AS ship_date,
       CASE l_returnflag WHEN 'A' THEN 'Standard Class' WHEN 'N' THEN 'Second Class'
            ELSE 'First Class' END AS ship_mode,
       c_name AS customer_name, c_mktsegment AS segment, 'STATE_' || (c_custkey % 10) AS state,
       n_name AS country, r_name AS market, 'ZONE_' || (n_nationkey % 3) AS region,
       'PRD-' || (p_partkey // 2) AS product_id, p_type AS category, p_brand AS sub_category,
       p_name AS product_name, CAST(l_extendedprice AS DECIMAL(18,2)) AS sales,
       CAST(l_quantity AS INT) AS quantity, CAST(l_discount * 5 AS DECIMAL(5,4)) AS discount,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount * 5 AS DECIMAL(5,4)))
            - CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(18,2)) * 0.7
            AS DECIMAL(18,5)) AS profit,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(abs(l_tax) AS DECIMAL(5,4)) * 0.1,
                  2) AS DECIMAL(18,2)) AS shipping_cost,
       o_orderpriority AS order_priority
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey""")

_part("staging", "lines", f"SELECT {', '.join(STAGING.names)} FROM lines")

_part("doubled", "staging", """
SELECT * FROM staging UNION ALL SELECT * FROM staging WHERE market = 'ASIA'""")

_part("geo", "staging", f"""
SELECT *, dense_rank() OVER (ORDER BY market) AS market_id,
       dense_rank() OVER (ORDER BY market, region) AS region_id,
       dense_rank() OVER (ORDER BY market, region, country) AS country_id,
       dense_rank() OVER (ORDER BY {GEO}) AS state_id
FROM (SELECT DISTINCT {GEO} FROM staging)""")

_part("cust", "staging", """
SELECT *, row_number() OVER (ORDER BY customer_name, segment) AS customer_id
FROM (SELECT DISTINCT customer_name, segment FROM staging)""")

_part("cats", "staging", """
SELECT *, dense_rank() OVER (ORDER BY category) AS category_id,
       dense_rank() OVER (ORDER BY category, sub_category) AS sub_category_id
FROM (SELECT DISTINCT category, sub_category FROM staging)""")

_part("prod", "staging cats", """
SELECT row_number() OVER (ORDER BY raw_product_id, product_name) AS product_id, raw_product_id,
       product_name, sub_category_id, sub_category, category_id, category
FROM (SELECT product_id AS raw_product_id, product_name, category, sub_category,
             row_number() OVER (PARTITION BY product_id, product_name
                                ORDER BY category, sub_category) AS pick
      FROM staging) JOIN cats USING (category, sub_category)
WHERE pick = 1""")

_CAL = """
SELECT CAST(d AS DATE) AS date_id, CAST(year(d) AS INT) AS year,
       CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
       monthname(d) AS month_name
FROM {days} t(d)"""
_SPANNED = """(SELECT unnest(generate_series(least(min(order_date), min(ship_date)),
       greatest(max(order_date), max(ship_date)), INTERVAL 1 DAY)) FROM staging)"""
_part("cal", "staging", _CAL.format(days=_SPANNED))


def _fact_rows(source: str, days: str = "order_date IS NOT NULL") -> str:
    return f"""
SELECT order_id, order_date AS order_date_id, ship_date AS ship_date_id, ship_mode, customer_id,
       state_id, p.product_id, {MEASURES}, order_priority
FROM {source} s
JOIN geo USING ({GEO})
JOIN cust USING (customer_name, segment)
JOIN prod p ON p.raw_product_id = s.product_id AND p.product_name = s.product_name
WHERE {days}"""


_part("loaded", "staging geo cust prod", _fact_rows("staging"))
_part("loaded_doubled", "doubled geo cust prod", _fact_rows("doubled"))

_part("fact", "loaded", """
SELECT row_number() OVER (ORDER BY order_date_id, order_id, product_id, customer_id, state_id,
                          ship_date_id, ship_mode, sales, quantity, discount, profit,
                          shipping_cost, order_priority) AS sales_id, *
FROM loaded""")

_part("vfull", "fact geo cust prod cal", f"""
SELECT f.sales_id, f.order_id, f.order_date_id, o.year AS order_year, o.quarter AS order_quarter,
       o.month AS order_month, o.month_name AS order_month_name, f.ship_date_id,
       s.year AS ship_year, s.quarter AS ship_quarter, s.month AS ship_month,
       s.month_name AS ship_month_name,
       date_diff('day', f.order_date_id, f.ship_date_id) AS shipping_days, f.ship_mode,
       f.customer_id, customer_name, segment, f.state_id, state AS state_name, country_id,
       country AS country_name, region_id, region AS region_name, market_id,
       market AS market_name, f.product_id, raw_product_id, product_name, sub_category_id,
       sub_category AS sub_category_name, category_id, category AS category_name, {MEASURES},
       order_priority
FROM fact f
LEFT JOIN cal o ON o.date_id = f.order_date_id
LEFT JOIN cal s ON s.date_id = f.ship_date_id
LEFT JOIN cust USING (customer_id)
LEFT JOIN geo USING (state_id)
LEFT JOIN prod ON prod.product_id = f.product_id""")

_part("vsum", "vfull", f"""
SELECT order_year AS year, order_quarter AS quarter, order_month AS month,
       order_month_name AS month_name, segment, state_name, region_name, market_name,
       category_name, sub_category_name, sum(sales) AS total_sales, sum(quantity) AS total_qty,
       sum(profit) AS total_profit, count(DISTINCT order_id) AS order_count,
       round(CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(sales) AS DOUBLE), 0), 4)
           AS true_margin
FROM vfull
GROUP BY ALL""")

_part("staged_lines", "staging", f"""
SELECT order_id, product_id AS raw_product_id, product_name, {MEASURES} FROM staging""")
_part("fact_lines", "fact prod", f"""
SELECT order_id, raw_product_id, product_name, {MEASURES}
FROM fact JOIN prod ON fact.product_id = prod.product_id""")


# --- the uncleaned text file ----------------------------------------------


def _pick(number: str, *choices: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {choice}" for i, choice in enumerate(choices))
    return f"CASE {number} % {len(choices)} {cases} END"


def _day(column: str, form: str) -> str:
    return f"strftime({column}, '{form}')"


def _txt(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_RAW = {
    "order_id": _pick("o_orderkey", "lower(order_id)", "'  ' || order_id", "order_id || ' '"),
    "order_date": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN "
    + _day("order_date", "%Y-%m-%d") + " ELSE " + _pick(
        "o_orderkey", _day("order_date", "%-d/%-m/%Y"), _day("order_date", "%d-%m-%Y"),
        "' ' || " + _day("order_date", "%-d.%-m.%Y") + " || ' '", _day("order_date", "%d/%m/%Y"),
    ) + " END",
    "ship_date": "CASE WHEN l_suppkey % 71 = 0 THEN " + _day("ship_date", "%m/%d/%Y") + " ELSE "
    + _pick("l_linenumber", _day("ship_date", "%-d-%-m-%Y"), _day("ship_date", "%d.%m.%Y"),
            _day("ship_date", "%-d/%-m/%Y")) + " END",
    "ship_mode": _pick("l_linenumber", "upper(ship_mode)", "replace(lower(ship_mode), ' ', '  ')"),
    "customer_name": "CASE WHEN c_custkey % 7 = 0 THEN 'søren ' || c_name "
                     "WHEN c_custkey % 5 = 0 THEN 'josé  ' || lower(c_name) "
                     "ELSE upper(c_name) END",
    "segment": "lower(segment)",
    "state": _pick("c_custkey", "'são paulo ' || state", "'côte d''azur ' || lower(state)"),
    "country": "country || chr(160)",
    "market": "lower(market)",
    "region": "'Zone_' || (n_nationkey % 3)",
    "product_id": "lower(product_id)",
    "category": "lower(category)",
    "sub_category": "upper(sub_category)",
    "product_name": _pick("l_partkey", "upper(product_name)",
                          "replace(product_name, ' ', chr(13) || chr(10))",
                          "replace(product_name, ' ', chr(9))", "'oﬃce ' || product_name",
                          "product_name || ', 8.5 x 11 \"wide\"'"),
    "sales": "CASE WHEN l_partkey % 211 = 0 THEN 'n/a' WHEN l_partkey % 223 = 0 THEN '1e3' "
             f"WHEN l_partkey % 227 = 0 THEN {_txt('sales')} || '5' ELSE "
    + _pick("l_suppkey", "format('{:,.2f}', CAST(sales AS DOUBLE))", "'$' || " + _txt("sales"),
            "' ' || " + _txt("sales") + " || ' '", _txt("sales")) + " END",
    "quantity": f"CASE WHEN l_suppkey % 61 = 0 THEN '' ELSE {_txt('quantity')} END",
    "discount": f"CASE WHEN (o_orderkey + l_linenumber) % 31 = 0 THEN NULL "
                f"WHEN (o_orderkey + l_linenumber) % 53 = 0 THEN '50' "
                f"ELSE {_txt('discount')} END",
    "profit": "CASE WHEN l_linenumber % 2 = 0 AND profit < 0 THEN '(' || "
              f"{_txt('abs(profit)')} || ')' ELSE {_txt('profit')} END",
    "shipping_cost": "CASE WHEN (o_orderkey + l_linenumber) % 37 = 0 THEN NULL "
                     "WHEN (o_orderkey + l_linenumber) % 41 = 0 THEN 'free' "
                     f"ELSE {_txt('shipping_cost')} END",
    "order_priority": "lower(order_priority)",
    "year": _txt("year(order_date)"),
}
_part("raw", "lines", "SELECT " + ", ".join(f"{_RAW[c]} AS {c}" for c in RAW.names)
      + " FROM lines")

_TYPES = {"sales": "DECIMAL(18,2)", "profit": "DECIMAL(18,5)", "discount": "DECIMAL(5,4)",
          "shipping_cost": "DECIMAL(18,2)", "quantity": "INT"}


def _spaced(column: str) -> str:
    return f"trim(regexp_replace({column}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


def _parsed_date(column: str) -> str:
    plain = f"regexp_replace({_spaced(column)}, '[-.]', '/', 'g')"
    return f"CAST(try_strptime({plain}, '%d/%m/%Y') AS DATE)"


def _parsed_number(column: str) -> str:
    plain = f"replace({_spaced(column)}, ',', '')"
    signed = f"regexp_replace({plain}, '^\\((.+)\\)$', '-\\1')"
    digits = f"regexp_replace({signed}, '[^0-9.\\-]', '', 'g')"
    if column == "quantity":
        return f"round(TRY_CAST({digits} AS DECIMAL(38,10)), 0)"
    return f"TRY_CAST({digits} AS DECIMAL(38,10))"


def _tidy(column: str) -> str:
    return f"replace(strip_accents({_spaced(column)}), 'ﬃ', 'ffi')"


def _ascii(text: str) -> str:
    return f"NOT regexp_matches({text}, '[^\\x00-\\x7F]')"


def _cased(column: str, text: str) -> str:
    if column in CODE_COLUMNS:
        return f"upper({text})"
    words = f"regexp_extract_all({text}, '[A-Za-z]+|[^A-Za-z]+')"
    titled = f"list_transform({words}, lambda x: upper(x[1]) || lower(x[2:]))"
    return f"CASE WHEN {_ascii(text)} THEN array_to_string({titled}, '') ELSE {text} END"


def _cleaned(column: str) -> str:
    if column in ("order_date", "ship_date"):
        return _parsed_date(column)
    if column in ("discount", "shipping_cost"):
        return f"coalesce({_parsed_number(column)}, 0)"
    if column in NUMBER_COLUMNS:
        return _parsed_number(column)
    return f"{column}_c" if column != "year" else "year"


_part("tidied", "raw", "SELECT *, " + ", ".join(f"{_tidy(c)} AS {c}_t" for c in TEXT_COLUMNS)
      + " FROM raw")
_part("cased", "tidied", "SELECT *, " + ", ".join(
    f"{_cased(c, c + '_t')} AS {c}_c" for c in TEXT_COLUMNS) + " FROM tidied")
_part("clean", "cased", "SELECT * FROM (SELECT " + ", ".join(
    f"{_cleaned(c)} AS {c}" for c in RAW.names) + " FROM cased) WHERE order_date IS NOT NULL")


# The same two parts under a calendar that lacks days.
_SHORT = {
    "cal": _CAL.format(days="range(TIMESTAMP '1996-01-01', TIMESTAMP '2001-01-01', INTERVAL 1 DAY)"),
    "loaded": _fact_rows("staging", "order_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"),
}


def sql(text: str, short: bool = False) -> str:
    """``text`` preceded by the parts it mentions, and the parts those need."""
    import re

    chosen: list[str] = []

    def add(name: str) -> None:
        if name not in chosen:
            for need in _PARTS[name][0]:
                add(need)
            chosen.append(name)

    for name in _PARTS:
        if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
            add(name)
    if not chosen:
        return text.strip()
    bodies = {name: _PARTS[name][1] for name in chosen} | (_SHORT if short else {})
    parts = ",\n".join(f"{name} AS MATERIALIZED ({bodies[name].strip()})" for name in chosen)
    return f"WITH {parts}\n{text.strip()}"


_DOUBLES = {"sales", "discount", "profit", "shipping_cost", "total_sales", "total_profit"}


def _shown(columns: list[str], more: tuple[str, ...] = ()) -> str:
    doubles = _DOUBLES.union(more)
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in doubles else c for c in columns)


def _money(expression: str, digits: int = 2) -> str:
    return f"CAST(round({expression}, {digits}) AS DOUBLE)"


def _ratio(top: str, bottom: str, digits: int, scale: str = "1.0") -> str:
    quotient = f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0) * CAST({scale} AS DOUBLE)"
    return f"round({quotient}, {digits})"


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


ORACLE: dict[str, str] = {}


_WITH_SHORT_CALENDAR = (
    "e_anti", "e_left_null", "e_match_rate", "e_cross_one_row", "j01_loading_gaps",
    "j01_loading_gaps_by_digest", "j03_layer_digests", "j04_layer_totals", "j06_load_overview", "j07_key_orphans", "j10_order_match",
)


_OF_LAST_YEAR = (
    "l3_category_share", "l4_top_products_and_customers", "l6_drill_down", "l7_high_discount_losses",
)
_YEAR = "FROM (SELECT * FROM vfull WHERE order_year = (SELECT max(order_year) FROM vfull)) y"


def _oracle(name: str, text: str) -> None:
    ORACLE[name] = sql(text)
    if name in _OF_LAST_YEAR:
        ORACLE[f"{name}_of_year"] = sql(text.replace("FROM vfull", _YEAR))
    if name in _WITH_SHORT_CALENDAR:
        ORACLE[f"{name}_planted"] = sql(text, short=True)


STAGING_SHOWN = _shown(STAGING.names)

# --- A --------------------------------------------------------------------

# An empty cell of a file is a missing one.
_oracle("a_csv_roundtrip", "SELECT "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW.names) + " FROM raw")
_oracle("a_typed_load", f"SELECT {STAGING_SHOWN} FROM (SELECT * REPLACE ("
        + ", ".join(f"TRY_CAST({c} AS {kind}) AS {c}" for c, kind in _TYPES.items())
        + ") FROM clean)")


def _bad_cast(field) -> str:
    column = field.name
    if column not in _TYPES:  # the clean file's dates all convert
        return "CAST(0 AS BIGINT)"
    return f"count(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {_TYPES[column]}) IS NULL)"


_LIMITS = {"order_id": 50, "ship_mode": 50, "customer_name": 100, "segment": 50, "state": 100,
           "country": 100, "market": 50, "region": 50, "product_id": 50, "category": 50,
           "sub_category": 50, "product_name": 200, "order_priority": 50}
_oracle("a_load_diagnostics", _union([
    f"SELECT '{f.name}' AS \"column\", count(*) AS rows_loaded, "
    "(SELECT 2 * count(DISTINCT market) FROM staging) AS malformed_lines, "
    f"{_bad_cast(f)} AS bad_casts, "
    + (f"count(*) FILTER (length({f.name}) > {_LIMITS[f.name]})" if f.name in _LIMITS
       else "CAST(0 AS BIGINT)") + " AS too_long FROM clean"
    for f in STAGING.fields]))

_oracle("a_report_tables", _union(
    [f"SELECT '{s}' AS sheet, CAST({len(STAGING.names)} AS BIGINT) AS row_count"
     for s in ("describe", "missing", "unique", "dtypes")]
    + [f"SELECT '{s}', least(100, count(*)) FROM staging" for s in ("preview", "sample")]))
_oracle("a_append", f"SELECT {STAGING_SHOWN} FROM staging")
_oracle("a_insert_ignore", """
SELECT row_number() OVER (ORDER BY NOT early, customer_name, segment) AS customer_id,
       customer_name, segment
FROM (SELECT customer_name, segment, bool_or(order_date < DATE '1996-01-01') AS early
      FROM staging GROUP BY customer_name, segment)""")
_oracle("a_view", "SELECT market_name, count(*) AS row_count FROM vfull GROUP BY market_name")
_oracle("a_table_shape", "SELECT CAST(20 AS BIGINT) AS column_count, count(*) AS row_count FROM staging")

_ISO = "^ *[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} *$"
_BAD = {c: f"NOT regexp_matches({c}, '{_ISO}')" for c in ("order_date", "ship_date")} | {
    c: f"TRY_CAST({c} AS {_TYPES[c]}) IS NULL" for c in NUMBER_COLUMNS}
_REASONS = {"order_date": "date", "ship_date": "date"} | {
    c: _TYPES[c].lower() for c in NUMBER_COLUMNS}
_SHORT_LINE = "market || ',' || market_id"
_LONG_LINE = "rtrim(repeat(market || ',', 23), ',')"
_oracle("a_load_warnings", "SELECT \"column\", raw, reason, count(*) AS warnings FROM (" + _union([
    *[f"SELECT '{c}' AS \"column\", {c} AS raw, 'not {_REASONS[c]}' AS reason FROM raw "
      f"WHERE {c} IS NOT NULL AND {c} <> '' AND {test}" for c, test in _BAD.items()],
    *[f"SELECT NULL, {line}, 'malformed line' FROM (SELECT DISTINCT market, market_id FROM geo)"
      for line in (_SHORT_LINE, _LONG_LINE)]]) + ") GROUP BY ALL")

_TABLE_ROWS = {
    "staging_sales": "FROM staging", "dim_date": "FROM cal", "dim_customer": "FROM cust",
    "dim_market": "FROM (SELECT DISTINCT market_id FROM geo)",
    "dim_region": "FROM (SELECT DISTINCT region_id FROM geo)",
    "dim_country": "FROM (SELECT DISTINCT country_id FROM geo)", "dim_state": "FROM geo",
    "dim_category": "FROM (SELECT DISTINCT category_id FROM cats)",
    "dim_sub_category": "FROM cats", "dim_product": "FROM prod", "fact_sales": "FROM fact",
}
_oracle("a_data_dictionary", _union([
    f"SELECT '{table}' AS table_name, column_name, CAST(ordinal AS INT) AS ordinal, data_type, "
    f"'YES' AS is_nullable, (SELECT count(*) {rows}) AS table_rows FROM (VALUES "
    + ", ".join(f"('{f.name}', {i}, '{f.dataType.simpleString()}')"
                for i, f in enumerate(TABLES[table].fields, 1))
    + ") v(column_name, ordinal, data_type)"
    for table, rows in _TABLE_ROWS.items()]))

# --- B --------------------------------------------------------------------

_oracle("b_dates", f"""
SELECT order_id, order_date AS order_date_raw, {_parsed_date('order_date')} AS order_date,
       ship_date AS ship_date_raw, {_parsed_date('ship_date')} AS ship_date FROM raw""")
_oracle("b_date_nulls", _union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({_parsed_date(c)} IS NULL) AS null_dates FROM raw"
    for c in ("order_date", "ship_date")]))
_oracle("b_numbers", "SELECT order_id, " + ", ".join(
    f"{c} AS {c}_raw, CAST({_parsed_number(c)} AS DOUBLE) AS {c}"
    for c in NUMBER_COLUMNS) + " FROM raw")
_oracle("b_number_errors", _union([
    f"SELECT '{c}' AS \"column\", "
    f"count(*) FILTER ({_parsed_number(c)} IS NULL AND {c} IS NOT NULL) AS new_errors, "
    f"count(*) FILTER ({_parsed_number(c)} IS NULL) AS total_null FROM raw"
    for c in NUMBER_COLUMNS]))
_oracle("b_invalid_report", "SELECT * FROM (" + _union([
    f"SELECT '{c}' AS \"column\", order_id, {c} AS raw_value, "
    f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'missing' "
    f"WHEN regexp_matches({c}, '[0-9.][eE][+-]?[0-9]') THEN 'exponent' "
    f"WHEN {_parsed_number(c)} IS NULL THEN 'unreadable' "
    f"WHEN TRY_CAST({_parsed_number(c)} AS {_TYPES[c]}) IS NULL THEN 'out_of_range' END AS reason FROM raw"
    for c in NUMBER_COLUMNS]) + ") WHERE reason IS NOT NULL")
_oracle("b_whitespace", "SELECT " + ", ".join(f"{_spaced(c)} AS {c}" for c in TEXT_COLUMNS)
        + " FROM raw")
_oracle("b_accent_fold", "SELECT doc_id, strip_accents(text) AS folded FROM documents")
_oracle("b_is_ascii", f"""
SELECT lang, count(*) FILTER ({_ascii('text')}) AS ascii_rows,
       count(*) FILTER (NOT ({_ascii('text')})) AS other_rows
FROM documents GROUP BY lang""")
_oracle("b_upper_codes", "SELECT " + ", ".join(f"{c}_c AS {c}" for c in CODE_COLUMNS)
        + " FROM cased")
_oracle("b_proper_case", "SELECT " + ", ".join(f"{c}_c AS {c}" for c in NAME_COLUMNS)
        + " FROM cased")
_oracle("b_change_counts", _union([
    f"SELECT '{c}' AS \"column\", '{rule}' AS rule, "
    f"count(*) FILTER ({a} IS DISTINCT FROM {b}) AS changed FROM cased"
    for c in TEXT_COLUMNS
    for rule, a, b in (("tidy", c, f"{c}_t"),
                       ("upper" if c in CODE_COLUMNS else "proper_case", f"{c}_t", f"{c}_c"))]))
_oracle("b_drop_null_dates", f"""
SELECT count(*) AS rows_before, count(*) FILTER (d IS NULL) AS dropped,
       round(count(*) FILTER (d IS NULL) / CAST(count(*) AS DOUBLE), 6) AS dropped_ratio
FROM (SELECT {_parsed_date('order_date')} AS d FROM raw)""")
_oracle("b_fill_zero", _union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({_parsed_number(c)} IS NULL) AS filled "
    f"FROM raw WHERE {_parsed_date('order_date')} IS NOT NULL"
    for c in ("discount", "shipping_cost")]))
_oracle("b_clean", f"SELECT {_shown(RAW.names, ('quantity',))} FROM clean")

# --- C --------------------------------------------------------------------


def _describe(column: str) -> str:
    if column in NUMBER_COLUMNS:
        x = f"CAST({column} AS DOUBLE)"
        return (
            f"SELECT '{column}' AS \"column\", count({column}) AS \"count\", "
            f"CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, "
            f"CAST(NULL AS BIGINT) AS freq, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, "
            + ", ".join(f"round(quantile_cont({x}, {p}), 4) AS q{int(p * 100)}"
                        for p in (0.25, 0.5, 0.75))
            + f", round(max({x}), 4) AS max FROM staging")
    groups = f"(SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM staging GROUP BY 1)"
    return (
        f"SELECT '{column}' AS \"column\", CAST(sum(n) AS BIGINT) AS \"count\", "
        f"count(*) AS \"unique\", arg_min(v, (-n, v)) AS top, max(n) AS freq, "
        "NULL AS mean, NULL AS std, NULL AS min, NULL AS q25, NULL AS q50, NULL AS q75, "
        f"NULL AS max FROM {groups}")


_oracle("c_describe", _union(
    [_describe(c) for c in sorted(STAGING.names, key=lambda c: c not in NUMBER_COLUMNS)]))
_oracle("c_missing", _union([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM raw" for c in RAW.names]))
_oracle("c_nunique", _union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"unique\" FROM raw" for c in RAW.names]))
_oracle("c_dtypes", _union([
    f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS dtype, "
    f"count({f.name}) AS non_null FROM staging" for f in STAGING.fields]))
_oracle("c_preview", f"""
SELECT {STAGING_SHOWN}
FROM (SELECT * FROM staging ORDER BY {', '.join(STAGING.names)} LIMIT 100)""")
_oracle("c_sample", f"""
SELECT {STAGING_SHOWN} FROM (SELECT * FROM staging ORDER BY
       md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in STAGING.names)})),
       {', '.join(STAGING.names)} LIMIT 100)""")
_oracle("c_unique_text", _union([
    f"SELECT DISTINCT '{c}' AS \"column\", {_spaced(c)} AS value FROM raw" for c in TEXT_COLUMNS]))
_oracle("c_unique_text_counts", _union([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {_spaced(c)}) AS \"values\" FROM raw"
    for c in TEXT_COLUMNS]))


def _digits(column: str) -> str:
    whole = "CAST(length(replace(split_part(t, '.', 1), '-', '')) AS INT)"
    part = "CAST(length(rtrim(split_part(t, '.', 2), '0')) AS INT)"
    return (f"SELECT '{column}' AS \"column\", max({whole}) AS max_int_digits, "
            f"max({part}) AS max_decimal_digits, min({whole}) AS min_int_digits, "
            f"min({part}) AS min_decimal_digits "
            f"FROM (SELECT printf('%.6f', CAST({_parsed_number(column)} AS DOUBLE)) AS t FROM raw)")


_oracle("c_digit_profile", _union([_digits(c) for c in NUMBER_COLUMNS]))


def _conflicts(source: str) -> str:
    return f"""
SELECT DISTINCT product_id, product_name FROM {source}
WHERE product_id IN (SELECT product_id FROM {source} GROUP BY product_id
                     HAVING count(DISTINCT product_name) > 1)"""


_oracle("c_id_name_conflicts", _conflicts("raw"))


def _audit(source: str) -> str:
    return _union([
        f"SELECT '{c}' AS \"column\", '{metric}' AS metric, {expression} AS value FROM {source}"
        for c in RAW.names
        for metric, expression in (("rows", "count(*)"), ("missing", f"count(*) - count({c})"),
                                   ("unique", f"count(DISTINCT {c})"))])


_oracle("c_audit_compare", f"""
SELECT b."column", b.metric, b.value AS before, a.value AS after, a.value - b.value AS delta
FROM ({_audit('raw')}) b JOIN ({_audit('clean')}) a
  ON a."column" = b."column" AND a.metric = b.metric""")
_oracle("c_row_order_counts", """
SELECT count(*) AS total_rows, count(DISTINCT order_id) AS distinct_orders FROM staging""")
_oracle("c_exact_duplicates", f"""
SELECT {_shown(DUPLICATE_KEY)}, count(*) AS cnt
FROM doubled GROUP BY {', '.join(DUPLICATE_KEY)} HAVING count(*) > 1""")

# --- D --------------------------------------------------------------------

_SPAN = """(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d, lo
 FROM (SELECT least(min(order_date), min(ship_date)) AS lo,
              greatest(max(order_date), max(ship_date)) AS hi FROM staging))"""


def _calendar_parts(d: str) -> str:
    return (f"CAST(year({d}) AS INT) AS year, CAST(quarter({d}) AS INT) AS quarter, "
            f"CAST(month({d}) AS INT) AS month, monthname({d}) AS month_name, "
            f"CAST(day({d}) AS INT) AS day, dayname({d}) AS day_of_week, "
            f"CAST(weekofyear({d}) AS INT) AS week_of_year, "
            f"CAST(dayofweek({d}) IN (0, 6) AS INT) AS is_weekend")


_oracle("d_series", f"""
SELECT CAST(date_diff('day', lo, CAST(d AS DATE)) AS INT) AS n, CAST(d AS DATE) AS date_id
FROM {_SPAN}""")
_oracle("d_calendar", f"SELECT CAST(d AS DATE) AS date_id, {_calendar_parts('d')} FROM {_SPAN}")
_oracle("d_customer", "SELECT customer_id, customer_name, segment FROM cust")
_oracle("d_market", "SELECT DISTINCT market_id, market AS market_name FROM geo")
_oracle("d_category", "SELECT DISTINCT category_id, category AS category_name FROM cats")
_oracle("d_region", "SELECT DISTINCT region_id, region AS region_name, market_id FROM geo")
_oracle("d_country", "SELECT DISTINCT country_id, country AS country_name, region_id FROM geo")
_oracle("d_state", "SELECT state_id, state AS state_name, country_id FROM geo")
_oracle("d_sub_category",
        "SELECT sub_category_id, sub_category AS sub_category_name, category_id FROM cats")
_oracle("d_product", "SELECT product_id, raw_product_id, product_name, sub_category_id FROM prod")
FACT_SHOWN = _shown(TABLES["fact_sales"].names)
_oracle("d_fact", f"SELECT {FACT_SHOWN} FROM fact")
_oracle("d_keys", """
SELECT count(*) AS rows, min(sales_id) AS first_key, max(sales_id) AS last_key,
       count(DISTINCT sales_id) AS distinct_keys FROM fact""")
_oracle("d_fanout_audit", """
SELECT 'country' AS level, market, region, country, NULL AS state
FROM (SELECT DISTINCT p.market, p.region, c.country
      FROM geo p JOIN geo c ON p.region = c.region
      EXCEPT SELECT market, region, country FROM geo)
UNION ALL
SELECT 'state', market, region, country, state
FROM (SELECT DISTINCT p.market, p.region, c.country, s.state
      FROM geo p JOIN geo c ON p.region = c.region JOIN geo s ON s.country = c.country
      EXCEPT SELECT market, region, country, state FROM geo)""")

# --- E --------------------------------------------------------------------

_oracle("e_inner", """
SELECT sales_id, order_id, customer_name, CAST(sales AS DOUBLE) AS sales
FROM fact JOIN cust USING (customer_id)""")
_oracle("e_composite_chain", f"""
SELECT order_id, state_id, customer_id, p.product_id AS product_key,
       CAST(sales AS DOUBLE) AS sales
FROM staging s JOIN geo USING ({GEO}) JOIN cust USING (customer_name, segment)
JOIN prod p ON p.raw_product_id = s.product_id AND p.product_name = s.product_name""")
_oracle("e_left_chain", """
SELECT sales_id, order_year, ship_year, customer_name, state_name, country_name, region_name,
       market_name, product_name, sub_category_name, category_name FROM vfull""")
_oracle("e_role_playing", """
SELECT order_year, ship_year, count(*) AS row_count FROM vfull GROUP BY order_year, ship_year""")
_oracle("e_snowflake_agg", f"""
SELECT market_name, category_name, count(*) AS row_count, {_money('sum(sales)')} AS total_sales
FROM vfull GROUP BY market_name, category_name""")
_oracle("e_anti", f"""
SELECT {_shown(COMPARED.split(', '))}, count(*) AS row_count
FROM staged_lines s
WHERE NOT EXISTS (SELECT 1 FROM fact_lines f WHERE {' AND '.join(
    f'f.{c} = s.{c}' for c in COMPARED.split(', '))})
GROUP BY {COMPARED}""")
_oracle("e_left_null", """
SELECT ship_date_id, count(*) AS row_count FROM fact LEFT JOIN cal ON date_id = ship_date_id
WHERE date_id IS NULL GROUP BY ship_date_id""")
_oracle("e_match_rate", """
SELECT CAST(year(order_date) AS INT) AS year, count(DISTINCT order_id) AS orders,
       count(DISTINCT CASE WHEN order_id IN (SELECT order_id FROM fact) THEN order_id END)
           AS matched
FROM staging GROUP BY 1""")
_oracle("e_cross_one_row", """
SELECT source, CAST(n AS BIGINT) AS row_count, CAST(total AS DOUBLE) AS total_sales FROM (
  SELECT 'staging_sales' AS source, count(*) AS n, sum(sales) AS total FROM staging
  UNION ALL SELECT 'fact_sales', count(*), sum(sales) FROM fact
  UNION ALL SELECT 'staging - fact', s.n - f.n, s.total - f.total
  FROM (SELECT count(*) AS n, sum(sales) AS total FROM staging) s,
       (SELECT count(*) AS n, sum(sales) AS total FROM fact) f)""")
_oracle("e_semi", _conflicts("staging"))

# --- F --------------------------------------------------------------------

_oracle("f_count", "SELECT ship_mode, count(*) AS row_count FROM fact GROUP BY ship_mode")
_DISTINCT = ["sales_id", "order_id", "order_date_id", "ship_date_id", "ship_mode", "customer_id",
             "state_id", "product_id", "order_priority"]
_DISTINCTS = ", ".join(f"count(DISTINCT {c}) AS uniq_{c}" for c in _DISTINCT)
_oracle("f_count_distinct",
        f"SELECT 'fact_sales' AS source, count(*) AS total_rows, {_DISTINCTS} FROM fact")
_oracle("f_distinct_concat", """
SELECT count(DISTINCT order_id || '-' || raw_product_id) AS joined_text,
       count(DISTINCT (order_id, raw_product_id)) AS pairs FROM vfull""")
_oracle("f_distinct_case", """
SELECT segment, count(DISTINCT order_id) FILTER (discount > 0) AS discounted_orders
FROM vfull GROUP BY segment""")
_oracle("f_sum", f"""
SELECT market_name, order_year, {_money('sum(sales)')} AS total_sales,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, {_money('sum(profit)', 5)} AS total_profit,
       {_money('sum(shipping_cost)')} AS total_shipping_cost
FROM vfull GROUP BY market_name, order_year""")
_oracle("f_sum_case", """
SELECT market_name, CAST(sum(CASE WHEN profit < 0 THEN 1 ELSE 0 END) AS BIGINT) AS loss_rows,
       CAST(sum(CASE WHEN ship_year IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_ship_year
FROM vfull GROUP BY market_name""")
_oracle("f_min_max", """
SELECT market_name, min(order_date_id) AS first_order, max(order_date_id) AS last_order,
       CAST(min(sales) AS DOUBLE) AS min_sales, CAST(max(sales) AS DOUBLE) AS max_sales
FROM vfull GROUP BY market_name""")
_oracle("f_avg", f"""
SELECT segment, {_ratio('sum(sales)', 'count(sales)', 4)} AS avg_sales,
       round(avg(CAST(quantity AS DOUBLE)), 4) AS avg_quantity
FROM vfull GROUP BY segment""")
_oracle("f_group_concat", """
SELECT order_id, string_agg(ship_mode, ',' ORDER BY ship_mode) AS ship_modes
FROM (SELECT DISTINCT order_id, ship_mode FROM fact) GROUP BY order_id""")
_oracle("f_many_keys", """
SELECT order_year AS year, order_quarter AS quarter, order_month AS month,
       order_month_name AS month_name, segment, state_name, region_name, market_name,
       category_name, sub_category_name, count(*) AS row_count,
       CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM vfull GROUP BY ALL""")
# Labels and limits of the discount bands; a missing discount is high.
_BAND = """CASE WHEN discount = 0 THEN 'No Discount'
            WHEN discount <= 0.10 THEN 'Low (0–10%)'
            WHEN discount <= 0.30 THEN 'Medium (11–30%)' ELSE 'High (>30%)' END"""
_oracle("f_alias_key", f"SELECT {_BAND} AS band, count(*) AS row_count FROM fact GROUP BY band")
_oracle("f_having", """
SELECT raw_product_id, count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM vfull GROUP BY raw_product_id HAVING count(*) > 25 AND sum(quantity) > 600""")
_oracle("f_two_level", """
SELECT lines, count(*) AS orders
FROM (SELECT order_id, count(*) AS lines FROM fact GROUP BY order_id) GROUP BY lines""")
_oracle("f_ratio", f"""
SELECT segment, order_year, {_ratio('sum(profit)', 'sum(sales)', 4)} AS margin
FROM vfull GROUP BY segment, order_year""")
_oracle("f_agg_arith", """
SELECT market_name, CAST(sum(n - 1) AS BIGINT) AS extra_lines, max(n) - min(n) AS line_spread
FROM (SELECT market_name, order_id, count(*) AS n FROM vfull GROUP BY market_name, order_id)
GROUP BY market_name""")
_oracle("f_reaggregate", """
SELECT category_name, CAST(summed AS BIGINT) AS summed_orders, distinct_orders
FROM (SELECT category_name, sum(order_count) AS summed FROM vsum GROUP BY category_name)
JOIN (SELECT category_name, count(DISTINCT order_id) AS distinct_orders FROM vfull
      GROUP BY category_name) USING (category_name)""")
_oracle("f_dedup", """
SELECT product_name, count(*) AS pairs, count(DISTINCT product_id) AS ids
FROM (SELECT DISTINCT product_id, product_name FROM staging) GROUP BY product_name""")

# --- G --------------------------------------------------------------------

_oracle("g_date_parts", f"""
SELECT order_date, {_calendar_parts('order_date')}, CAST(dayofweek(order_date) + 1 AS INT) AS dow,
       CAST(order_date + INTERVAL 30 DAY AS DATE) AS due,
       CAST(date_diff('day', order_date, last_ship) AS INT) AS longest_days
FROM (SELECT order_date, max(ship_date) AS last_ship FROM staging GROUP BY order_date)""")
_oracle("g_math", """
SELECT sales_id, CAST(round(sales * discount, 2) AS DOUBLE) AS saved,
       CAST(round(sales - shipping_cost, 0) AS DOUBLE) AS net,
       CAST(round(profit, 1) AS DOUBLE) AS profit_1 FROM fact""")
_oracle("g_null", """
SELECT order_priority, count(*) FILTER (discount IS NULL) AS no_discount,
       count(nullif(quantity, '')) AS with_quantity,
       count(*) FILTER (coalesce(shipping_cost, '0') = '0') AS zero_or_missing_cost
FROM raw GROUP BY order_priority""")
_oracle("g_case", """
SELECT CASE WHEN quantity <= 10 THEN 'small' WHEN quantity <= 30 THEN 'medium' ELSE 'large' END
           AS order_size, count(*) AS row_count, count(*) FILTER (profit < 0) AS loss_rows
FROM fact GROUP BY 1""")
_oracle("g_string", """
SELECT market_name || ' - ' || segment AS label, upper(segment) AS upper,
       CAST(length(segment) AS INT) AS length, split_part(segment, 'U', 1) AS head,
       format('{:,}', CAST(round(sum(sales), 0) AS BIGINT)) AS sales_text
FROM vfull GROUP BY market_name, segment""")
_oracle("g_field_order", """
SELECT ship_mode, row_count,
       CAST(CASE ship_mode WHEN 'Second Class' THEN 1 WHEN 'First Class' THEN 2 ELSE 0 END
            AS BIGINT) AS position
FROM (SELECT ship_mode, count(*) AS row_count FROM fact GROUP BY ship_mode)""")
_oracle("g_predicates", """
SELECT market_name,
       count(*) FILTER (order_date_id BETWEEN DATE '1997-01-01' AND DATE '1998-12-31') AS in_range,
       count(*) FILTER (ship_mode IN ('First Class', 'Second Class') AND quantity <= 25)
           AS few_and_fast,
       count(*) FILTER (ship_year IS NULL OR discount = 0) AS either
FROM vfull GROUP BY market_name""")
_oracle("g_subqueries", """
SELECT raw_product_id, CAST(sum(sales) AS DOUBLE) AS total_sales FROM vfull
GROUP BY raw_product_id
HAVING CAST(sum(sales) AS DOUBLE) > (
    SELECT CAST(sum(sales) AS DOUBLE) / count(DISTINCT raw_product_id) FROM vfull)""")

# --- H --------------------------------------------------------------------

_oracle("h_order", f"""
SELECT market_name, country_name, {_money('sum(sales)')} AS total_sales
FROM vfull GROUP BY market_name, country_name ORDER BY market_name, country_name""")
_oracle("h_order_alias", f"""
SELECT country_name, {_money('sum(profit)')} AS total_profit
FROM vfull GROUP BY country_name ORDER BY total_profit DESC""")
_oracle("h_custom_order", """
SELECT order_priority, count(*) AS row_count FROM fact GROUP BY order_priority
ORDER BY list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'],
                       order_priority)""")
_oracle("h_limit", f"SELECT {FACT_SHOWN} FROM fact ORDER BY sales_id LIMIT 10")
_oracle("h_top_k", f"""
SELECT sub_category_name, {_money('sum(sales)')} AS total_sales,
       {_money('sum(profit)')} AS total_profit
FROM vfull GROUP BY sub_category_name ORDER BY sum(sales) DESC, sub_category_name LIMIT 5""")
_oracle("h_union_all", _union([
    f"SELECT '{table}' AS table_name, count(*) AS row_count {rows}"
    for table, rows in _TABLE_ROWS.items()]))
_oracle("h_union_distinct", """
SELECT customer_name, segment FROM staging WHERE order_date < DATE '1999-01-01'
UNION SELECT customer_name, segment FROM staging WHERE order_date >= DATE '1997-01-01'""")

# --- J --------------------------------------------------------------------


def _equal(left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in MEASURES.split(", "))


_GAPS = f"""
SELECT s.order_id, p.raw_product_id, p.product_name, p.product_id AS dim_product_id,
       {', '.join(f'CAST(s.{c} AS DOUBLE) AS {c}' if c in _DOUBLES else 's.' + c
                  for c in MEASURES.split(', '))}
FROM staging s JOIN prod p ON p.raw_product_id = s.product_id AND p.product_name = s.product_name
WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.order_id = s.order_id
                  AND f.product_id = p.product_id AND {_equal('f', 's')})"""
_oracle("j01_loading_gaps", _GAPS)


_oracle("j01_loading_gaps_by_digest", _GAPS)


def _phantoms(kept: str) -> str:
    return f"""
SELECT f.order_id, p.product_id, p.raw_product_id, p.product_name,
       {', '.join(f'CAST(f.{c} AS DOUBLE) AS {c}' if c in _DOUBLES else 'f.' + c
                  for c in MEASURES.split(', '))}
FROM fact f JOIN prod p ON p.product_id = f.product_id
WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE {kept} AND s.order_id = f.order_id
                  AND s.product_id = p.raw_product_id AND s.product_name = p.product_name
                  AND {_equal('f', 's')})"""


_oracle("j02_phantom_rows", _phantoms("true"))
_oracle("j02_phantom_rows_planted", _phantoms("s.market <> 'AFRICA'"))


def _difference(staged: str) -> str:
    return f"""
SELECT {_shown(COMPARED.split(', '))}, CAST(sum(s) AS BIGINT) AS staging_rows,
       CAST(sum(f) AS BIGINT) AS fact_rows, CAST(sum(s) - sum(f) AS BIGINT) AS delta
FROM (SELECT *, 1 AS s, 0 AS f FROM ({staged})
      UNION ALL SELECT *, 0, 1 FROM fact_lines)
GROUP BY {COMPARED} HAVING sum(s) <> sum(f)"""


_oracle("j03_multiset_difference", _difference("SELECT * FROM staged_lines"))
_oracle("j03_multiset_difference_planted", _difference(
    f"SELECT order_id, product_id AS raw_product_id, product_name, {MEASURES} FROM doubled"))


for _name in ("j02_phantom_rows", "j03_multiset_difference"):
    for _end in ("", "_planted"):
        ORACLE[f"{_name}_by_digest{_end}"] = ORACLE[f"{_name}{_end}"]
_oracle("j03_layer_digests", f"""
SELECT CAST(level AS INT) AS level, period, CAST(sum(s) AS BIGINT) AS left_rows,
       CAST(sum(f) AS BIGINT) AS right_rows, bool_or(s <> f) AS differs
FROM (SELECT day, sum(s) AS s, sum(f) AS f
      FROM (SELECT order_date AS day, order_id, product_id AS raw_product_id, product_name, {MEASURES},
                   1 AS s, 0 AS f FROM staging
            UNION ALL
            SELECT order_date_id, order_id, raw_product_id, product_name, {MEASURES}, 0, 1
            FROM fact JOIN prod ON fact.product_id = prod.product_id)
      GROUP BY day, {COMPARED})
CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS level)
CROSS JOIN LATERAL (SELECT CASE level WHEN 1 THEN 'all' ELSE
                    substr(CAST(day AS VARCHAR), 1, [0, 4, 7, 10][level]) END AS period)
GROUP BY level, period""")


for _name in ("f_group_concat", "f_two_level"):
    ORACLE[f"{_name}_clustered"] = ORACLE[_name]
_oracle("f_reaggregate_sketch", """
SELECT category_name, count(DISTINCT order_id) AS distinct_orders, true AS within
FROM vfull GROUP BY category_name""")


def _closure(leaf: str, source: str, *levels: tuple[str, str]) -> str:
    return _union([
        f"SELECT 0 AS depth, 'all' AS level, 0 AS ancestor_id, NULL AS ancestor_name, {leaf} AS leaf_id FROM {source}",
        *[f"SELECT {depth}, '{level}', {level}_id, {name}, {leaf} FROM {source}"
          for depth, (level, name) in enumerate(levels, 1)]])


_GEO_CLOSURE = _closure("state_id", "geo", *[(c, c) for c in GEO.split(", ")])
_oracle("d_geography_closure", _GEO_CLOSURE)
_oracle("d_product_closure", _closure(
    "product_id", "prod", ("category", "category"), ("sub_category", "sub_category"), ("product", "product_name")))
_oracle("l6_roll_up_by_closure", _union([
    f"SELECT {depth} AS depth, '{level}' AS level, {number} AS ancestor_id, {name} AS ancestor_name, "
    f"{_money('sum(sales)')} AS total_sales, {_money('sum(profit)')} AS total_profit FROM vfull GROUP BY ALL"
    for depth, (level, number, name) in enumerate([("all", "0", "NULL"), *[
        (c, f"{c}_id", f"{c}_name") for c in GEO.split(", ")]])]))
_oracle("c_merged_profiles", _union([
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing, "
    + (f"CAST(round(sum({c}), 2) AS DOUBLE)" if c in NUMBER_COLUMNS else "CAST(NULL AS DOUBLE)")
    + " AS total, true AS distinct_within, "
    + ("true" if c in NUMBER_COLUMNS else "CAST(NULL AS BOOLEAN)") + " AS median_within FROM staging"
    for c in STAGING.names if c != "market"]))


def _layer(source: str, rows: str, product: str) -> str:
    return (f"SELECT '{source}' AS source, count(*) AS n, sum(sales) AS s, sum(quantity) AS q, "
            f"sum(profit) AS p, count(DISTINCT order_id || '-' || {product}) AS o FROM {rows}")


_oracle("j04_layer_totals", f"""
SELECT source, CAST(n AS BIGINT) AS row_count, CAST(s AS DOUBLE) AS total_sales,
       CAST(q AS BIGINT) AS total_quantity, CAST(p AS DOUBLE) AS total_profit,
       CAST(o AS BIGINT) AS order_products
FROM (WITH t AS ({_layer('staging_sales', 'staging', 'product_id')} UNION ALL
                 {_layer('fact_sales', 'fact JOIN prod USING (product_id)', 'raw_product_id')}
                 UNION ALL {_layer('vw_sales_full', 'vfull', 'raw_product_id')})
      SELECT * FROM t UNION ALL
      SELECT 'difference (staging - ' || (CASE b.source WHEN 'fact_sales' THEN 'fact'
                                          ELSE 'view' END) || ')',
             a.n - b.n, a.s - b.s, a.q - b.q, a.p - b.p, a.o - b.o
      FROM t a JOIN t b ON a.source = 'staging_sales' AND b.source <> 'staging_sales')""")
_oracle("j05_distinct_comparison", f"""
WITH_T SELECT * FROM t UNION ALL
SELECT 'difference (fact - view)', a.total_rows - b.total_rows,
       {', '.join(f'a.uniq_{c} - b.uniq_{c}' for c in _DISTINCT)}
FROM t a JOIN t b ON a.source = 'fact_sales' AND b.source = 'vw_sales_full'""".replace(
    "WITH_T", f"""SELECT * FROM (WITH t AS (
  SELECT 'fact_sales' AS source, count(*) AS total_rows, {_DISTINCTS} FROM fact UNION ALL
  SELECT 'vw_sales_full', count(*), {_DISTINCTS} FROM vfull)""") + ")")
_oracle("j06_load_overview", """
SELECT 'overview' AS report, 'staging_sales' AS item, count(*) AS row_count FROM staging
UNION ALL SELECT 'overview', 'fact_sales', count(*) FROM fact
UNION ALL SELECT 'overview', 'staging - fact',
                 (SELECT count(*) FROM staging) - (SELECT count(*) FROM fact)
UNION ALL SELECT 'dimensions', 'dim_customer', count(*) FROM cust
UNION ALL SELECT 'dimensions', 'dim_state', count(*) FROM geo
UNION ALL SELECT 'dimensions', 'dim_product', count(*) FROM prod
UNION ALL SELECT 'date range', CAST(min(date_id) AS VARCHAR) || ' ~ ' ||
                 CAST(max(date_id) AS VARCHAR), count(*) FROM cal""")
_oracle("j07_key_orphans", _union([
    f"SELECT '{name} orphans' AS check_name, count(*) AS orphan_cnt FROM fact f "
    f"LEFT JOIN {table} d ON f.{column} = d.{key} WHERE d.{key} IS NULL"
    for name, column, table, key in (
        ("order_date", "order_date_id", "cal", "date_id"),
        ("ship_date", "ship_date_id", "cal", "date_id"),
        ("customer", "customer_id", "cust", "customer_id"),
        ("state", "state_id", "geo", "state_id"),
        ("product", "product_id", "prod", "product_id"))]))
_oracle("j08_product_conflict_summary", """
SELECT count(*) AS conflicting_ids, CAST(sum(n - 1) AS BIGINT) AS extra_names,
       count(*) AS ids_with_conflict
FROM (SELECT raw_product_id, count(DISTINCT product_name) AS n FROM prod GROUP BY raw_product_id)
WHERE n > 1""")
_oracle("j09_product_conflicts", """
SELECT '1 id with several names' AS check_name, count(*) AS problems
FROM (SELECT raw_product_id FROM prod GROUP BY 1 HAVING count(DISTINCT product_name) > 1)
UNION ALL SELECT '2 name with several ids', count(*)
FROM (SELECT product_name FROM prod GROUP BY 1 HAVING count(DISTINCT raw_product_id) > 1)
UNION ALL SELECT '3 repeated id and name pair', count(*)
FROM (SELECT raw_product_id, product_name FROM prod GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT '4 fact without product', count(*)
FROM fact LEFT JOIN prod USING (product_id) WHERE prod.raw_product_id IS NULL""")
_oracle("j10_order_match", """
SELECT CAST(CAST(round(100.0 * matched / total, 2) AS DECIMAL(5,2)) AS VARCHAR) || '%'
           AS match_rate, matched AS matched_orders, total AS staging_orders,
       total - matched AS unmatched_orders
FROM (SELECT count(DISTINCT s.order_id) AS total, count(DISTINCT f.order_id) AS matched
      FROM staging s LEFT JOIN (SELECT DISTINCT order_id FROM fact) f
        ON s.order_id = f.order_id)""")
_LINE_KEY = "order_id, product_id, order_date_id, ship_date_id, ship_mode, shipping_cost"
_REPEATED = f"""
SELECT {_shown(_LINE_KEY.split(', '))}, count(*) AS line_count,
       CAST(sum(sales) AS DOUBLE) AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       string_agg(DISTINCT ship_mode, ',') AS ship_modes
FROM loaded_doubled GROUP BY {_LINE_KEY} HAVING count(*) > 1"""
_oracle("j11_repeated_lines_all", _REPEATED)
_oracle("j11_repeated_lines_clustered", _REPEATED)
_oracle("j11_repeated_lines", f"SELECT * FROM ({_REPEATED}) ORDER BY {_LINE_KEY} LIMIT 100")
_oracle("j12_geography_chain", """
SELECT market AS market_name, region AS region_name, country AS country_name, state AS state_name
FROM geo ORDER BY market, region, country, state LIMIT 20""")
_oracle("j12_product_chain", """
SELECT category AS category_name, sub_category AS sub_category_name, product_id, raw_product_id,
       product_name
FROM prod ORDER BY category, sub_category, product_id LIMIT 20""")
_oracle("j13_fact_kpis", f"""
SELECT min(order_date_id) AS earliest_order, max(order_date_id) AS latest_order,
       count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders,
       {_money('sum(sales)', 0)} AS total_sales, {_money('sum(profit)', 0)} AS total_profit
FROM fact""")
_oracle("j14_view_counts", """
SELECT 'vw_sales_full' AS table_name, count(*) AS row_count FROM vfull
UNION ALL SELECT 'vw_sales_summary', count(*) FROM vsum""")

# --- K --------------------------------------------------------------------

_oracle("k01_sales_full", "SELECT * REPLACE (CAST(sales AS DOUBLE) AS sales, "
        "CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit, "
        "CAST(shipping_cost AS DOUBLE) AS shipping_cost, "
        "CAST(shipping_days AS INT) AS shipping_days) FROM vfull")
_oracle("k02_sales_summary", f"""
SELECT {SUMMARY_KEYS}, CAST(total_sales AS DOUBLE) AS total_sales,
       CAST(total_qty AS BIGINT) AS total_qty, CAST(total_profit AS DOUBLE) AS total_profit,
       order_count, true_margin FROM vsum""")
# Loaded in batches, all but the surrogate keys is as in one load.
ORACLE["a_durable_load"] = ORACLE["k02_sales_summary"]
_oracle("a_incremental_load", "SELECT * EXCLUDE (sales_id, customer_id, state_id, country_id, region_id, "
        "market_id, product_id, sub_category_id, category_id) REPLACE (CAST(sales AS DOUBLE) AS sales, "
        "CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit, "
        "CAST(shipping_cost AS DOUBLE) AS shipping_cost, "
        "CAST(shipping_days AS INT) AS shipping_days) FROM vfull")
_oracle("a_catalog_views", """
SELECT category_name, count(*) AS row_count, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM vfull GROUP BY category_name""")
_SQP = (f"{_money('sum(sales)')} AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity, "
        f"{_money('sum(profit)', 5)} AS total_profit")
_oracle("k03_product_by_month", f"""
SELECT order_year, order_month, order_month_name, raw_product_id, product_name, {_SQP},
       {_money('sum(discount)', 4)} AS total_discount,
       {_ratio('sum(discount)', 'count(discount)', 6)} AS mean_discount
FROM vfull GROUP BY order_year, order_month, order_month_name, raw_product_id, product_name""")
_oracle("k04_product_by_year", f"""
SELECT raw_product_id, product_name, order_year, {_SQP}
FROM vfull GROUP BY raw_product_id, product_name, order_year""")
_oracle("k05_product_totals", f"""
SELECT raw_product_id, product_name, {_SQP}, {_money('sum(shipping_cost)')} AS total_shipping_cost
FROM vfull GROUP BY raw_product_id, product_name""")
_oracle("k06_geography_by_category", f"""
SELECT market_name, country_name, state_name, category_name, sub_category_name, {_SQP}
FROM vfull GROUP BY market_name, country_name, state_name, category_name, sub_category_name""")
_oracle("k07_category_margin", f"""
SELECT category_name, {_money('sum(sales)', 0)} AS sales, {_money('sum(profit)', 0)} AS profit,
       {_ratio('sum(profit)', 'sum(sales)', 1, '100')} AS margin_pct
FROM vfull GROUP BY category_name""")
_oracle("k08_discount_bands", f"""
SELECT {_BAND} AS discount_band, {_money('sum(sales)')} AS total_sales,
       {_money('sum(profit)', 5)} AS total_profit,
       {_ratio('sum(profit)', 'sum(sales)', 2, '100')} AS profit_margin_pct
FROM vfull GROUP BY discount_band""")
_oracle("k09_category_check", f"""
SELECT category_name, {_money('sum(total_sales)', 0)} AS sales_total,
       {_money('sum(total_profit)', 0)} AS profit_total,
       {_ratio('sum(total_profit)', 'sum(total_sales)', 1, '100')} AS avg_margin_pct,
       CAST(sum(order_count) AS BIGINT) AS total_orders
FROM vsum GROUP BY category_name ORDER BY sales_total DESC LIMIT 5""")
_oracle("k10_kpi_cards", """
SELECT 'total sales' AS kpi,
       format('{:,}', CAST(round(sum(total_sales), 0) AS BIGINT)) AS value FROM vsum
UNION ALL SELECT 'total profit',
       format('{:,}', CAST(round(sum(total_profit), 0) AS BIGINT)) FROM vsum
UNION ALL SELECT 'average margin', CAST(CAST(round(
       CAST(sum(CAST(true_margin AS DECIMAL(18,4))) AS DOUBLE) * 100 / count(true_margin), 1)
       AS DECIMAL(18,1)) AS VARCHAR) || '%' FROM vsum""")

# --- L --------------------------------------------------------------------

_MEMBERS = {"total": "'all'", "market": "market_name", "segment": "segment",
            "category": "category_name", "sub_category": "sub_category_name",
            "product": "raw_product_id || ' ' || product_name"}


def _years(*dimensions: str) -> str:
    return "(" + _union([
        f"SELECT '{d}' AS dimension, {_MEMBERS[d]} AS member, order_year AS year, "
        "sum(sales) AS s, sum(profit) AS p FROM vfull GROUP BY ALL" for d in dimensions]) + ")"


def _grown(*dimensions: str) -> str:
    """Yearly sums next to those of the year before, NULL where that year has no rows."""
    before = "OVER (PARTITION BY dimension, member ORDER BY year)"
    adjacent = f"lag(year) {before} = year - 1"
    return (f"(WITH y AS MATERIALIZED {_years(*dimensions)} SELECT *, "
            f"CASE WHEN {adjacent} THEN lag(s) {before} END AS ps, "
            f"CASE WHEN {adjacent} THEN lag(p) {before} END AS pp FROM y)")


_oracle("l1_year_over_year", f"""
SELECT dimension, member, year, {_money('s')} AS sales, {_money('p')} AS profit,
       {_ratio('p', 's', 2, '100')} AS margin_pct,
       {_money('s - ps')} AS sales_change, {_ratio('(s - ps)', 'ps', 2, '100')} AS sales_yoy_pct,
       {_money('p - pp')} AS profit_change, {_ratio('(p - pp)', 'pp', 2, '100')} AS profit_yoy_pct
FROM {_grown(*_MEMBERS)}""")
_oracle("l2_monthly_trend", f"""
SELECT order_year, order_month, {_money('sum(sales)')} AS total_sales,
       {_money('sum(profit)')} AS total_profit FROM vfull GROUP BY order_year, order_month""")
_oracle("l3_category_share", f"""
SELECT category_name, {_money('s')} AS total_sales, {_money('p')} AS total_profit,
       {_ratio('s', 'sum(s) OVER ()', 2, '100')} AS sales_share_pct,
       {_ratio('p', 'sum(p) OVER ()', 2, '100')} AS profit_share_pct
FROM (SELECT category_name, sum(sales) AS s, sum(profit) AS p FROM vfull
      GROUP BY category_name)""")
_oracle("l4_top_products_and_customers", _union([
    f"(SELECT '{kind}' AS kind, {name} AS member, {_money('sum(sales)')} AS total_sales, "
    f"{_money('sum(profit)')} AS total_profit FROM vfull GROUP BY {name} "
    f"ORDER BY sum(sales) DESC, {name} LIMIT 10)"
    for kind, name in (("product", "product_name"), ("customer", "customer_name"))]))
_oracle("l5_largest_gains", f"""
SELECT dimension, member, year, {_money('s')} AS sales, {_money('s - ps')} AS sales_gain
FROM {_grown('market', 'product')} WHERE year = (SELECT max(order_year) FROM vfull) AND ps IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY s - ps DESC, member) <= 10""")
_oracle("l6_drill_down", f"""
SELECT market_name, region_name, country_name, customer_name,
       CAST(grouping_id(market_name, region_name, country_name, customer_name) AS INT)
           AS level_mask,
       {_money('sum(sales)')} AS total_sales, {_money('sum(profit)')} AS total_profit
FROM vfull GROUP BY ROLLUP (market_name, region_name, country_name, customer_name)""")
_oracle("l7_high_discount_losses", f"""
SELECT sub_category_name, raw_product_id, product_name,
       round(CAST(sum(discount) AS DOUBLE) / count(discount), 4) AS avg_discount,
       {_money('sum(sales)')} AS total_sales, {_money('sum(profit)')} AS total_profit,
       {_ratio('sum(profit)', 'sum(sales)', 2, '100')} AS margin_pct
FROM vfull WHERE {_BAND} = 'High (>30%)'
GROUP BY sub_category_name, raw_product_id, product_name HAVING round(sum(profit), 2) < 0""")
_oracle("l8_growth_risk", f"""
SELECT dimension, member, year, {_money('s')} AS sales, {_money('p')} AS profit,
       {_ratio('(s - ps)', 'ps', 2, '100')} AS sales_yoy_pct
FROM {_grown('sub_category', 'product')} WHERE s > ps AND p < 0""")
_oracle("l9_segment_analysis", f"""
SELECT member AS segment, year, {_money('s')} AS sales,
       {_ratio('s', 'sum(s) OVER (PARTITION BY year)', 2, '100')} AS share_pct,
       {_ratio('(s - ps)', 'ps', 2, '100')} AS sales_yoy_pct,
       {_ratio('(p - pp)', 'pp', 2, '100')} AS profit_yoy_pct
FROM {_grown('segment')}""")
