"""Byte-level BPE and token records against the tokenizers' own libraries."""

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from salesloom.llm import bpe, records
from salesloom.llm.queries import QUERIES
from salesloom.llm.tokenizing import cut, worker_bytes

AWKWARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "don't we'll I'M", "x y z w", "\x1c a \x1d",
    "<|endoftext|> and <|endoftext|>", "日本語 текст ünïcödé", "🙂🙂 👩‍👩‍👧", "a" * 5000, "ab" * 3000, "1234567 89", "!!?? ...", "word " * 3000,
    "é \u0000 \u0001", "\r\n\r\n x", "tab\tbed  text\t",
]


def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed, n=200):
    draw = random.Random(seed)
    letters = "abcXYZ 019 .,'!\n\té日  s t"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 80))) for _ in range(n)]


def expected_ids(texts):
    encoding = library()
    return [encoding.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("texts", [AWKWARD, noise(1), noise(2)])
def test_encoder_equals_the_library(texts):
    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN)
    plain = [t or "" for t in texts]
    packed = encoder.encode(plain)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == expected_ids(texts)
    assert packed == encoder.encode(plain)  # from memory now
    assert [encoder.decode(p).decode() for p in packed] == plain


def test_replay_takes_a_new_lower_rank_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"bcd": 290, b"ab": 310, b"abc": 295}

    words = [b"bcdbc", b"abcd", b"aabbcc", b""]

    def plain(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        if word in ranks:
            return [ranks[word]]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    draw = random.Random(4)
    words += [bytes(draw.choice(b"abcd") for _ in range(draw.randint(0, 30))) for _ in range(300)]
    ids, ends = bpe.replay(words, ranks)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [plain(w) for w in words]


def test_cut_loses_nothing():
    for text in [t or "" for t in AWKWARD] + noise(3):
        head, parts = cut(text)
        assert " ".join([head, *parts]) == text


def test_op3_equals_the_library_on_the_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter()
    for row, ids in zip(rows, expected_ids([r["text"] for r in rows])):
        packed = np.array(ids, dtype="<u4").tobytes()
        expected[row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((row["text"] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, QUERIES["op3_byte_bpe"](spark, sf_dir).collect())) == expected


def table(spark, texts):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, record string").repartition(3)


def test_awkward_texts_null_ids_and_repeated_rows(spark):
    docs = table(spark, AWKWARD).union(table(spark, AWKWARD)).selectExpr("nullif(doc_id, 3) doc_id", "text", "n_tokens", "record")
    found = Counter((r["doc_id"], tuple(r["ids"])) for r in bpe.encode_documents(docs, ids=True).collect())
    expected = Counter({(None if i == 3 else i, tuple(ids)): 2 for i, ids in enumerate(expected_ids(AWKWARD))})
    assert found == expected


def library_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def record_rows(ids):
    start, rows = 0, []
    for i, own in enumerate(ids):
        rows.append((i, start, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
        start += len(own)
    return rows


@pytest.mark.parametrize("file_bytes", [1 << 26, 5000])
def test_records_equal_the_library(spark, file_bytes):
    texts = AWKWARD + noise(5)
    index = records.token_records(table(spark, texts), file_bytes=file_bytes)
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in index.collect())
    assert found == record_rows(library_ids(texts))


def test_op10_equals_the_library_on_the_whole_table(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op10_token_records"](spark, sf_dir).collect())
    expected = [(rows[i]["doc_id"], *rest) for i, *rest in record_rows(library_ids([r["text"] for r in rows]))]
    assert found == expected


def test_shuffled_reads_by_offset(spark, tmp_path):
    texts = noise(6, 60)
    folder = str(tmp_path / "records")
    records.write_records(table(spark, texts), folder, file_bytes=2000)
    index = records.read_index(spark, folder)
    assert index.select("file").distinct().count() > 1
    some = records.read_records(index.filter("doc_id % 7 = 3"), folder).collect()
    expected = library_ids(texts)
    assert {r["doc_id"]: list(r["ids"]) for r in some} == {i: expected[i] for i in range(60) if i % 7 == 3}
    again = records.read_records(index.orderBy("length"), folder).collect()  # in any order
    assert {r["doc_id"]: list(r["ids"]) for r in again} == dict(enumerate(expected))
    names = lambda kind: {p.name for p in (tmp_path / "records" / f"kind={kind}").glob("part-*")}
    assert names("index") == names("records") == {r["file"] for r in index.collect()}


def test_rows_without_id_come_first_and_repeated_ones_stay(spark):
    rows = [(None, "b"), (3, "x y"), (None, None), (3, "x y"), (-2, "a"), (0, "c")]
    index = records.token_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    ids = dict(zip("abc", library_ids("abc"))) | {None: [2], "x y": library_ids(["x y"])[0]}
    ordered = [(None, None), (None, "b"), (-2, "a"), (0, "c"), (3, "x y"), (3, "x y")]
    found = sorted(index.collect(), key=lambda r: r["start"])
    expected = [(d, *r[1:]) for (d, _), r in zip(ordered, record_rows([ids[t] for _, t in ordered]))]
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in found] == expected


def test_memories_share_a_bound(spark):
    assert worker_bytes(spark, 800) == 100  # the session has eight cores in one executor
    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)), public_tokenizers.PATTERN, 3000)
    texts = noise(8)
    for text, ids in zip(texts, expected_ids(texts)):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ids
        assert sum(m.size for m in encoder.memories) <= 3000


def test_a_flipped_bit_is_found():
    data = records.frame(records.payload_of(7, np.arange(5, dtype="<u4"), 2)) + b"\n"
    assert records.read_record(data)[1].tolist() == [0, 1, 2, 3, 4]
    for i in range(len(data)):
        broken = bytearray(data)
        broken[i] ^= 4
        with pytest.raises(ValueError):
            records.read_record(bytes(broken))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(docs).collect() == []
    assert records.token_records(docs).collect() == []


def test_short_words_in_step_give_what_the_replay_gives():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"bcd": 290, b"ab": 310, b"abc": 295, b"aa": 320, b"aaa": 319}
    draw = random.Random(5)
    words = [b"", b"bcd", b"a"] + [bytes(draw.choice(b"abcd") for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    for some in (words, words[:1], []):
        ids, ends = bpe.replay_short(some, ranks, bpe.Pairs(ranks))
        expected = bpe.replay(words, ranks)
        assert ends.tolist() == expected[1][: len(some)].tolist()
        assert ids.tolist() == expected[0][: ends[-1] if len(some) else 0].tolist()
    with pytest.raises(KeyError):
        bpe.replay_short([b"ab", b"a!"], {b"a": 0, b"b": 1}, bpe.Pairs({b"a": 0, b"b": 1}))


SENTENCES = [
    "foo, bar. baz\nQux! a\n\nb.\nc 's\n's, x_, y\n,z q", "é, ü.\nö", "a.\n b", "it's, I'M. x\x1c\ny \nz, 3.\n4. a.b, c:d; e?! f!\n\x1d g",
    "x. y.\u0085\nw", "½, ²; a.\r\nb,\r\n", "\ns.", "\n, x", "a\n", "a, ", ",.\n.,", "a\0b, c. d", "\0", "a \0x", "\0 a. b", "a.\n\n\nb.\nc,\n",
    "<|endoftext|>, q\n<|endoftext|>\nr. <|endoftext|>\n" + "long" * 50 + ", x",
]


def test_cuts_at_stops_and_line_ends_change_no_id():
    texts = SENTENCES + noise(11, 2000)
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    for pattern, fine in ((public_tokenizers.PATTERN, True), (r"\S+\s?|\s+", False)):
        encoder = bpe.Encoder(ranks, pattern)
        assert encoder.fine is fine
    unpack = lambda packed: [np.frombuffer(p, "<u4").tolist() for p in packed]
    assert unpack(bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(texts)) == expected_ids(texts)
    encoder = records.IdEncoder(public_tokenizers.path(records.TOKENIZER), 1 << 20)
    assert encoder.fine
    assert unpack(encoder.encode(texts)) == [ids[:-1] for ids in library_ids(texts)]


def test_a_word_at_the_end_of_a_sentence_is_learnt_once():
    encoder = records.IdEncoder(public_tokenizers.path(records.TOKENIZER), 1 << 20)
    given, ids = [], encoder.ids
    encoder.ids = lambda texts: given.extend(texts) or ids(texts)
    encoder.encode(["so one thing. Then one thing, or one thing\nThen", "all one thing; Then one thing!\nSo"])
    assert sum(text.count("thing") for text in given) == 1


def test_workers_keep_no_memory_after_a_task(spark):
    bpe.encode_documents(table(spark, noise(12))).collect()
    key = (public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, worker_bytes(spark, bpe.EXECUTOR_BYTES))
    held = spark.sparkContext.parallelize(range(16), 16).map(lambda _: sum(map(len, bpe._encoder(*key).memories))).collect()
    assert held == [0] * 16


def watched():
    """An encoder, and the texts that it hands to the library."""
    encoder = records.IdEncoder(public_tokenizers.path(records.TOKENIZER), 20_000)
    given, ids = [], encoder.ids
    encoder.ids = lambda texts: given.extend(texts) or ids(texts)
    return encoder, given


def test_a_word_is_learnt_once_whatever_marks_follow_it():
    encoder, given = watched()
    encoder.encode(["one thing*** a thing's, the thing%%%!\nno thing(s) or thing2; in thing/thing: thing", "été, l'été, un été### d'été?!"])
    text = "\n".join(given)
    assert text.count(" thing") == 1 and text.count(" été") == 1


def test_words_in_use_outlive_those_that_are_not():
    encoder, given = watched()
    draw = random.Random(14)
    for _ in range(50):
        others = ["".join(draw.choices("abcdefgh", k=12)) for _ in range(30)]
        encoder.encode([f"a thing {' '.join(others)} and another"])
    assert sum(text.count(" thing") for text in given) == 1
    assert sum(m.size for m in encoder.memories) <= 20_000


STRANGE = [*"aabsStrevlmd'''  \n\n\t\r.,!?<|>%#-_019", "<|endoftext|>", *"éÉ×÷ñ\u0301\u00a0\u0085\u2003\u2028\u3000\u1680\u202f\u200b²½ªдя日🙂\x1c\x1f\0\x7f\u0661’"]


def test_cuts_between_strange_characters_change_no_id():
    draw = random.Random(13)
    texts = ["".join(draw.choice(STRANGE) for _ in range(draw.choice((0, 1, 2, 3, 8, 30)))) for _ in range(4000)]
    unpack = lambda packed: [np.frombuffer(p, "<u4").tolist() for p in packed]
    part = pa.array(["before", *texts, "after"], pa.binary()).slice(1, len(texts))
    encoder = records.IdEncoder(public_tokenizers.path(records.TOKENIZER), 1 << 20)
    assert unpack(encoder.encode(part)) == [ids[:-1] for ids in library_ids(texts)]
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
    assert unpack(bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(part)) == expected_ids(texts)
