"""Exact dedup, line dedup and mixing: SQL on the given tables, plain Python on awkward ones."""

import hashlib
import random
import re
from collections import Counter

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from salesloom.llm import exact_dedup, line_dedup, mixing
from salesloom.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 9000
AWKWARD = [
    (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n", "en", "a", 3), (4, " ", None, "a", 1),
    (5, "x y", "en", "a", 3), (6, "x\n\ty", "en", "a", 4), (7, "x y ", "en", "a", 4), (5, "x y", "en", "a", 3),
    (8, LONG, "en", "b", None), (9, LONG, "en", "b", 9), (10, LONG + "z", "en", "b", 9), (11, LONG[:4096], "en", "b", 9),
    (None, "x y", "en", "b", 3), (None, "only null", "en", "b", 3), (12, "é" * 5000, "en", "b", 3), (13, "x\xa0y", "en", "b", 3),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS).repartition(4)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def by_text(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", text or ""), []).append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.update((i, keep, len(ids), digest) for i in ids)
    return out


@pytest.mark.parametrize("size,hashed", [(4096, F.xxhash64), (7, lambda b: F.pmod(F.xxhash64(b), F.lit(3)).cast("long"))])
def test_exact_duplicates_with_any_block_size_and_colliding_hashes(awkward, size, hashed):
    rows = awkward if size == 4096 else awkward.filter("length(coalesce(text, '')) < 200")
    found = exact_dedup.exact_duplicates(rows, size=size, block_hash=hashed).collect()
    expected = by_text([(r["doc_id"], r["text"]) for r in rows.collect()])
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == len({r["text_sha256"] for r in found})
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_block_names_hold_over_many_levels(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 9))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, size=1).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == by_text(enumerate(texts))


def test_lines_by_host(spark):
    rows = [(i, f"menu \nown {i}\n\nmenu", "a") for i in range(8)] + [(20, "menu\nrare", "b"), (21, None, "b"), (22, "", None)]
    rows += [(30 + i, "\tnull host\r", None) for i in range(3)] + [(40 + i, "menu", "a") for i in range(2)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, host int, lines string")
    out = line_dedup.drop_boilerplate(docs, counts=("before", "gone"))
    assert out.columns == [*docs.columns, "before", "gone"]
    found = {r["doc_id"]: (r["text"], r["before"], r["gone"]) for r in out.collect()}
    assert found[3] == ("own 3\n", 4, 2)
    assert found[20] == ("menu\nrare", 2, 0)  # on half of the pages of b, but on a single one
    assert found[21] == (None, 0, 0) and found[22] == ("", 1, 0)
    assert found[31] == ("", 1, 1) and found[40] == ("", 1, 1)
    assert len(found) == len(rows)


def test_mix_by_hand(spark):
    rows = [(i, "w " * (i % 7), "a") for i in range(300)] + [(1000 + i, "w w", "b") for i in range(5)] + [(2000, "w", "c"), (2001, None, None), (None, "w w w", None)]
    docs = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, source string, size string, target double")
    out = mixing.mix(docs, keep=docs.columns)
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["copies"] <= 3 for r in got)
    sizes, targets, taken = Counter(), {}, Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
        taken[r["source"]] += r["copies"] * r["size"]
    total = sum(sizes.values())
    weight = dict(zip(["a", "b", "c", None], [5, 2, 1, 5]))
    capped, share = set(), {}
    while True:  # cap, share the excess by weight, until none is above
        left = total - sum(3 * sizes[s] for s in capped)
        among = sum(weight[s] for s in sizes if s not in capped)
        share = {s: 3 * sizes[s] if s in capped else left * weight[s] / among for s in sizes}
        above = {s for s in sizes if share[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert targets == pytest.approx(share)
    assert abs(taken["a"] - targets["a"]) <= 7
    again = mixing.mix(docs.repartition(7), keep=docs.columns)
    key = lambda r: (r["doc_id"], r["copies"])
    assert Counter(map(key, again.collect())) == Counter(map(key, got))


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, line_dedup.drop_boilerplate, mixing.mix])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("run", [line_dedup.drop_boilerplate, mixing.mix])
def test_awkward_rows_all_come_back(awkward, run):
    assert run(awkward).count() == len(AWKWARD)


def test_native_plans_hold_no_python(awkward):
    for df in (exact_dedup.exact_duplicates(awkward), line_dedup.drop_boilerplate(awkward)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
