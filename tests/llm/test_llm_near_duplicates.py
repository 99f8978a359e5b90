"""SimHash fingerprints, covering links and components against plain Python."""

import random

import pytest
import xxhash

from salesloom.llm import simhash
from salesloom.llm.components import connected_components
from salesloom.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable per row, by comparing every pair."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [least.get(root(i)) for i in range(len(prints))]


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    expected = sorted((d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints)))
    assert sorted(map(tuple, QUERIES["op2_simhash_dedup"](spark, sf_dir).collect())) == expected


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_near_pair_meets_in_some_table(radius):
    masks = simhash.covering_masks(radius)
    draw = random.Random(radius)
    for _ in range(2000):
        differing = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(mask & differing == 0 for mask in masks)
    assert all(20 <= mask.bit_count() <= 44 for mask in masks)


def links_of(spark, prints):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    return connected_components(simhash.fingerprint_links(spark.createDataFrame(signed, "fp long").repartition(4)))


@pytest.mark.parametrize("pairwise", [256, 32])
def test_dense_buckets_are_refined_and_lose_no_link(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    draw = random.Random(9)
    prints = set()
    for _ in range(6):  # clusters of near fingerprints, and lonely ones
        centre = draw.getrandbits(64)
        for _ in range(60):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3))))
    prints |= {draw.getrandbits(64) for _ in range(50)} | {0, 1, 7, (1 << 64) - 1}
    prints = sorted(prints)
    expected = plain_components(list(enumerate(prints)))
    found = {r["node"] % (1 << 64): r["root"] for r in links_of(spark, prints).collect()}
    groups = {}
    for p, c in zip(prints, expected):
        groups.setdefault(c, []).append(p)
    for members in groups.values():
        if len(members) == 1:
            assert members[0] not in found
        else:
            assert len({found[m] for m in members}) == 1
    assert len(set(found.values())) == sum(len(m) > 1 for m in groups.values())


@pytest.mark.parametrize("pairwise", [256, 2])
def test_the_sign_bit_counts_like_any_other(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    top = 1 << 63
    base = 0x0123456789ABCDEF
    prints = [base, base ^ top, base ^ top ^ 6, base ^ top ^ 15, ~base % (1 << 64), top, (1 << 64) - 1, 0]
    found = {r["node"] % (1 << 64): r["root"] for r in links_of(spark, prints).collect()}
    assert set(found) == {base, base ^ top, base ^ top ^ 6, base ^ top ^ 15, 0, top}
    assert len({found[p] for p in prints[:4]}) == 1 and found[0] == found[top] != found[base]


def test_a_dense_ball_is_refined_to_the_end(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRWISE", 16)
    monkeypatch.setattr(simhash, "FEW_BITS", 4)
    draw = random.Random(2)
    prints = sorted({sum(draw.getrandbits(1) << (7 * b % 64) for b in range(9)) for _ in range(100)})
    found = {r["node"] for r in links_of(spark, prints).collect()}
    lonely = {p for p in prints if not any(0 < (p ^ q).bit_count() <= 3 for q in prints)}
    assert found == {p - (1 << 64) if p >> 63 else p for p in set(prints) - lonely}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 7)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


AWKWARD = [
    (3, "A b c d", "x"), (1, "a B\tc  d", "y"), (2, None, "z"), (4, "", None), (5, " \n", "x"), (6, "one", "x"), (7, "ONE", "x"),
    (None, "one", "x"), (None, "alone without an id", "x"), (8, "w " * 50000, "x"), (8, "w " * 50000, "x"), (9, "zwei drei", "x"),
]


def test_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, component_id string")
    found = simhash.near_duplicates(docs).collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in AWKWARD]
    key = lambda r: tuple(map(str, r))
    expected = sorted(((d, p - (1 << 64) if p >> 63 else p, c) for (d, p), c in zip(prints, plain_components(prints))), key=key)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found), key=key) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    expected_ids = sorted({c for _, _, c in expected if c is not None})
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == expected_ids
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["alone without an id"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_long_texts_go_in_portions(monkeypatch):
    text = " ".join(str(i % 700) for i in range(5000))
    whole = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    assert simhash.fingerprint_of(text.encode()) % (1 << 64) == whole
