"""Repeated substrings against a plain count of all strings of 200 bytes."""

import hashlib
import random
from collections import Counter

import pytest

from salesloom.llm import suffixes
from salesloom.llm.queries import QUERIES


def brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    rows = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rows.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def digests(df):
    rows = [(r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()]
    return Counter(rows)


def texts_of(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé ") for _ in range(draw.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (34, 38, 45, 90, 300)]
    texts = [None, "", " ", "a" * 199, "a" * 200, "a" * 201, "ab" * 400, shared[3], shared[3], prose(3000)]
    for _ in range(60):
        parts = [prose(draw.randint(1, 60))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(shared), prose(draw.randint(0, 40))]
        texts.append("".join(parts))
    near = prose(400)
    for _ in range(8):
        i = draw.randrange(len(near))
        texts.append(near[:i] + draw.choice("xyz") * draw.randint(0, 3) + near[i + draw.randint(0, 2) :])
    return texts


def test_cover_has_every_difference():
    period, cover = suffixes.difference_cover(3)
    assert (period, len(cover)) == (13, 4)
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


@pytest.mark.parametrize("seed,share,chunk", [(1, 0.7, 1 << 21), (2, 3.0, 3000)])
def test_against_brute_force(spark, monkeypatch, seed, share, chunk):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    texts = texts_of(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = digests(suffixes.repeated_substrings(docs, share=share))
    assert found == Counter((i, *row) for i, row in enumerate(brute(texts)))


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter((r["doc_id"], *b) for r, b in zip(rows, brute([r["text"] for r in rows])))
    assert Counter(map(tuple, QUERIES["op5_suffix_dedup"](spark, sf_dir).collect())) == expected


def test_repeated_rows_and_other_columns(spark):
    text = "".join(random.Random(5).choice("abcdef") for _ in range(700))
    docs = spark.createDataFrame([(1, text, 1), (1, text, 2), (None, "x" + text, 3)], "doc_id long, text string, chunk int")
    rows = sorted(suffixes.repeated_substrings(docs).collect(), key=lambda r: r["n_bytes"])
    assert [(r["doc_id"], len(r["kept"])) for r in rows] == [(1, 0), (1, 0), (None, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.repeated_substrings(docs).collect() == []


def test_too_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        suffixes.repeated_substrings(spark.createDataFrame([], "doc_id long, text string"), length=50)
