"""Language identification against sums over all segmentations written out, and by held-out accuracy."""

import math
import zlib

import numpy as np
import pytest

from salesloom.llm import language_id as L
from salesloom.llm.queries import QUERIES, read

PIECES = ["<unk>", "▁", "a", "b", "ab", "ba", "▁a", "▁ab", "bab", "1", "x y", *[f"<0x{i:02X}>" for i in range(256)]]


def segmentations(vocabulary, word):
    """All ways to write a word as pieces, bytes for letters without one."""
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        number = vocabulary.number.get(word[:k])
        if number is not None:
            yield from ((number, *rest) for rest in segmentations(vocabulary, word[k:]))
        elif k == 1:
            own = tuple(vocabulary.byte[b] for b in word[0].encode())
            yield from ((*own, *rest) for rest in segmentations(vocabulary, word[1:]))


def model(vocabulary, languages=2):
    rng = np.random.default_rng(0)
    units = rng.integers(0, 1 << 20, size=(languages, vocabulary.size)).astype(float)
    return L._model([f"l{i}" for i in range(languages)], np.log(np.full(languages, 1 / languages)), units, vocabulary, 1 << 20)


@pytest.mark.parametrize("word", ["▁a", "▁ab", "▁abab", "▁babab", "▁aéb", "▁日ab", "▁bbbbbbb"])
def test_forward_sums_all_segmentations(word):
    vocabulary = L.Vocabulary(PIECES)
    own = model(vocabulary)
    for i in range(2):
        expected = math.log(sum(math.exp(sum(own.log_piece[p, i] for p in s)) for s in segmentations(vocabulary, word)))
        assert own.forward([word, word])[1, i] == pytest.approx(expected, rel=1e-12)
    logs = own.steps([word])
    assert L.backward_sums(logs)[0, 0] == pytest.approx(L.forward_sums(logs)[0, -1])


@pytest.mark.parametrize("word", ["a", "abab", "aéba"])
def test_expected_counts_are_those_of_all_segmentations(word):
    vocabulary = L.Vocabulary(PIECES)
    own = model(vocabulary, 1)
    ways = list(segmentations(vocabulary, f"▁{word}"))
    weight = [math.exp(sum(own.log_piece[p, 0] for p in s)) for s in ways]
    expected = np.zeros(vocabulary.size)
    for s, w in zip(ways, weight):
        for p in s:
            expected[p] += 3 * w / sum(weight)
    found = np.zeros(vocabulary.size)
    for pieces, units in L.expected_pieces(own, [word], np.array([3.0])):
        np.add.at(found, pieces, units / L._UNIT)
    assert np.allclose(found, expected, atol=1e-3)


def test_words_are_whatever_their_place_and_length(monkeypatch):
    text = "Éa1b_c  ça-va ½² " * 20 + "x" * 3000 + " ǅ éa"
    whole = [w for ws in L.words_of(text) for w in ws]
    assert whole[:6] == ["éa", "b", "c", "ça", "va", "éa"] and "x" * 1024 in whole and whole[-1] == "éa"
    assert sum(map(len, (w for w in whole if set(w) == {"x"}))) == 3000
    monkeypatch.setattr(L, "_PORTION", 7)
    assert [w for ws in L.words_of(text) for w in ws] == whole


def test_short_words_need_no_logarithms():
    vocabulary = L.Vocabulary(PIECES)
    own = model(vocabulary)
    for words in (["▁" + "ab" * 19], ["▁a", "▁b"], ["▁babab", "▁aaaaa"]):
        numbers, spelled = vocabulary.arcs(words)
        assert not spelled
        assert np.allclose(own._forward_short(numbers), L.forward_sums(own.steps(words))[:, -1], rtol=1e-12)
    rare = L._model(["x"], np.zeros(1), np.eye(1, vocabulary.size) * 1e12, vocabulary, 1 << 20)
    assert np.isfinite(rare.forward(["▁" + "b" * (L._SHORT - 1)])).all()


def test_remembered_words_score_the_same(monkeypatch):
    vocabulary = L.Vocabulary(PIECES)
    words = ["ab", "a", "b", "abba", "ab", "日", "a" * 1024]
    roomy, tight = model(vocabulary), model(vocabulary)
    tight.most_bytes = 500
    first = roomy.word_scores(words)
    assert np.array_equal(first, roomy.word_scores(words))
    for w, expected in zip(words, first):
        assert np.allclose(tight.word_scores([w])[0], expected, rtol=1e-12)


DOCS = "doc_id long, text string, lang string, score string"


def test_awkward_rows(spark):
    train = spark.createDataFrame(
        [(1, "the cat and the dog", "en", "x"), (2, "le chat et le chien", "fr", "x"), (3, None, "fr", "x"), (4, "12", None, "x"), (5, "", "xx", "x")], DOCS
    )
    own = L.train(train)
    assert own.languages == ["en", "fr", "xx"]
    rows = [(1, "The dog! ", "en", "y"), (2, "LE CHIEN", None, "y"), (2, "LE CHIEN", None, "y"), (3, None, "en", "y"), (4, "", "en", "y"),
            (5, " 12 ½ _ ́", "fr", "y"), (None, "le " * 50000, None, "y"), (7, "z" * 20000, "en", "y")]
    found = L.predict_languages(spark.createDataFrame(rows, DOCS).repartition(3), own).collect()
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert len(found) == 8 and by_id[1][0] == "en" and by_id[2][0] == by_id[None][0] == "fr"
    assert by_id[3] == by_id[4] == by_id[5] == ("und", 0.0) and by_id[7][0] in own.languages
    assert all(0 <= r["score"] <= 1 for r in found)
    assert L.predict_languages(train.limit(0), own).collect() == []
    nothing = L.train(train.limit(0))
    assert {tuple(r) for r in L.predict_languages(train.limit(1), nothing).collect()} == {(1, "und", 0.0)}


def test_query_is_right_on_held_out_documents(spark, sf_dir):
    docs = {r["doc_id"]: r for r in read(spark, sf_dir, "documents").collect()}
    found = QUERIES["op12_language_id"](spark, sf_dir).collect()
    assert len(found) == len(docs)
    right = []
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        doc = docs[r["doc_id"]]
        letters = any(c.isalpha() for c in doc["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        if r["held_out"] and letters and doc["lang"] is not None:
            right.append(r["lang_pred"] == doc["lang"])
    assert sum(right) >= 0.97 * len(right)
