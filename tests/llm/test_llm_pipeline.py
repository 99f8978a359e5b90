"""The pipeline against its stages done by hand, and on awkward rows."""

import hashlib
import re
from collections import Counter

from test_llm_near_duplicates import plain_components, plain_fingerprint

import corpus_pipeline
from salesloom.llm import quality
from salesloom.llm.queries import read

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_keeps_its_promises(spark, sf_dir, tmp_path):
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    before = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir)
        path = str(tmp_path / name)
        after.write.parquet(path)
        after = spark.read.parquet(path)
        counts.append(after.count())
        if name != "byte_bpe":
            assert after.columns == docs.columns
        if name == "quality_classifier":
            good = {r["doc_id"] for r in quality.score_quality(docs, model).filter("score >= 0.7").collect()}
            assert {r["doc_id"] for r in after.collect()} == good
        if name == "line_dedup":
            assert counts[-1] == counts[-2]
            assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect())
        if name == "simhash_dedup":
            rows = before.collect()
            groups = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(groups))
        if name == "mix_sources":
            sizes = lambda df: Counter({r["source"]: 0 for r in df.collect()}) + sum((Counter({r["source"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))}) for r in df.collect()), Counter())
            assert abs(sum(sizes(after).values()) / sum(sizes(before).values()) - 1) < 0.15
        if name == "byte_bpe":
            expected = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in before.collect())
            assert Counter((r["doc_id"], r["decoded_sha256"]) for r in after.collect()) == expected
        before = after
    assert counts[0] < docs.count() and counts[2] < counts[1]
    found = corpus_pipeline.run(spark, sf_dir)
    key = lambda df: Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in df.collect())
    assert key(found) == key(before)


def test_awkward_rows_and_empty_tables(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x " * 30000, "en", "a", 1), (3, "Plain words of a text.", "en", None, 5)]
    docs = spark.createDataFrame([(*r, 7, "y") for r in rows], DOCS + ", copies int, fingerprint string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).collect() == []
        out = stage(spark, docs, sf_dir)
        out.collect()
        if name != "byte_bpe":
            assert out.columns == docs.columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_named_like_inner_ones(spark, sf_dir):
    inner = "p s n k m d y first before size place part source_size target _target tie host lines kept turn node label".split()
    rows = [(i, f"Words of text {i} that are plain.", "en", "ab"[i % 2], 9, *[str(i)] * len(inner)) for i in range(12)]
    docs = spark.createDataFrame(rows, ", ".join([DOCS, *(f"{c} string" for c in inner)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert all(r["p"] == r["label"] == str(r["doc_id"]) for r in out.collect()), name
