"""Spelling variants against plain comparison of every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from salesloom.llm import spelling
from salesloom.llm.queries import QUERIES


def plain_counts(rows, typo=97):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Near words of each word: by leaving out, in turn, each character."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1 :]]
            shorter = w[:i] + w[i + 1 :]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
        near[w].discard(w)
    return near


def plain(counts):
    near = neighbours(counts)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        rows.append((w, n, len(near[w]), f, None if f is None else counts[f], root))
    return sorted(rows, key=str)


def found(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()), key=str)


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain(plain_counts(docs))
    assert sum(r[2] > 0 for r in expected) > 100 and any(r[3] for r in expected)
    assert found(QUERIES["op13_spelling_variants"](spark, sf_dir)) == expected


def dense(seed, n):
    draw = random.Random(seed)
    return sorted({"".join(draw.choice("abé") for _ in range(draw.randint(5, 9))) for _ in range(n)})


@pytest.mark.parametrize("group", [48, 2])
def test_crowded_chunks_are_split_and_lose_no_pair(spark, group):
    words = dense(group, 700) + ["xabcdefgh", "abcdefgh", "abcdefg", "bcdefgh", "abcdXefgh", "abcdeFgh", "hgfedcba"]
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(4)
    pairs = [(r["a"], r["b"]) for r in spelling.near_pairs(rows, group).collect()]
    expected = {frozenset((w, x)) for w, near in neighbours(words).items() for x in near}
    assert len(pairs) == len(expected) and {frozenset(p) for p in pairs} == expected


def test_awkward_rows_and_chains(spark):
    rows = [
        (1, "House HOUSE house houze Houze houze " * 1, "x"), (2, "house " * 9, "x"), (3, None, "x"), (4, "", "x"), (None, "house", "x"), (5, "houz" * 2, "x"),
        (6, "mouze " * 3 + "ÉTUDE étude étude Étude " * 3, "x"), (6, "mouze " * 3, "x"), (6, "mouze " * 3, "x"), (7, "z" * 30000, "x"), (8, "tree trees " * 5, "x"),
        (9, "house " * 30 + "houses " * 3 + "abcde " * 3 + "abcdf " * 6 + "abcgf " * 12 + "abhgf " * 24, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    out = found(spelling.spelling_variants(docs))
    assert out == plain(plain_counts([r[:2] for r in rows]))
    assert {r[0]: r[5] for r in out}["abcde"] == "abhgf"
    assert found(spelling.spelling_variants(docs.limit(0))) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, ratio=1)
