"""Quality classifier, URL filter and vector search: slopes, held-out accuracy, brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from salesloom.llm import quality, url_filter, vector_search
from salesloom.llm.queries import QUERIES, RULES

# --- quality ---------------------------------------------------------------


def test_slopes_equal_differences():
    draw = np.random.default_rng(0)
    model = quality.fit(draw.normal(size=(9, quality.FEATURES)), np.array([2, 1, 4, 2]), np.array([0, 1, 1, 0.5]), rounds=2)
    x, passages, y = draw.normal(size=(9, quality.FEATURES)), np.array([2, 1, 4, 2]), np.array([0, 1, 1, 0.5])

    def loss(w):
        p = quality._forward(w, x, passages)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    slopes = quality._backward(model.weights, x, passages, y, quality._forward(model.weights, x, passages))
    for name, value in model.weights.items():
        for at in list(np.ndindex(value.shape))[:5]:
            up, down = ({k: v.copy() for k, v in model.weights.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert slopes[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-6)


def test_attention_sums_to_one_within_each_document():
    draw = np.random.default_rng(1)
    model = quality.fit(draw.normal(size=(6, quality.FEATURES)), np.array([1, 3, 2]), np.array([0, 1, 1.0]), rounds=3)
    out = quality._forward(model.weights, draw.normal(size=(6, quality.FEATURES)), np.array([1, 3, 2]))
    assert np.add.reduceat(out["a"], out["starts"]) == pytest.approx([1, 1, 1])


def test_passages_do_not_depend_on_neighbours():
    texts = [b"", b" ", b"Plain words here.", b"x" * 5000, "é ü ".encode() * 300, b"a b " * 400, b"\n\n"]
    alone = [quality.describe_passages([t])[0] for t in texts]
    together, passages = quality.describe_passages(texts)
    assert passages.tolist() == [len(a) for a in alone]
    assert np.allclose(np.concatenate(alone), together)


def test_held_out_accuracy_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op6_quality_classifier"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    tested = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert len(tested) > 50
    assert sum(p == q for p, q in tested) / len(tested) > 0.95


def test_awkward_texts_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "x" * 200000), (None, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(9, 1), (None, 0), (1, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scored = quality.score_quality(docs, model).collect()
    assert [r["score"] for r in scored] == [0.5] * 5
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 5)] + [(1, 1)], "doc_id long, quality int")
    again = quality.score_quality(docs, quality.train(docs, known)).collect()
    assert all(0 <= r["score"] <= 1 for r in again) and again[0]["score"] == again[1]["score"]
    empty = docs.limit(0)
    assert quality.score_quality(empty, quality.train(empty, known)).collect() == []


# --- urls ------------------------------------------------------------------


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_ranks(edges, seeds, damping=0.85, rounds=15):
    total = sum(seeds.values())
    if not total:
        return {}
    seeds = {h: s / total for h, s in seeds.items()}
    out = defaultdict(float)
    for (a, _), w in edges.items():
        out[a] += w
    ranks = dict(seeds)
    for _ in range(rounds):
        new = {h: s * (1 - damping) for h, s in seeds.items()}
        for (a, b), w in edges.items():
            if a in ranks:
                new[b] = new.get(b, 0) + damping * ranks[a] * w / out[a]
        ranks = new
    return ranks


def judge(pages):
    rows, seeds, edges = [], {"allow": Counter(), "block": Counter()}, Counter()
    for page_id, url, links in pages:
        host, path = plain_host_path(url)
        rule = plain_rule(host, path)
        if rule:
            seeds[rule.verdict][host] += 1
        for to in links:
            other = plain_host_path(":" + to if to.startswith("//") else to)[0]
            if host and other and other != host:
                edges[host, other] += 1
        rows.append((page_id, host, path, rule))
    trust = plain_ranks(edges, seeds["allow"])
    distrust = plain_ranks({(b, a): w for (a, b), w in edges.items()}, seeds["block"])
    least = 1e-6 * sum(distrust.values()) / max(1, len({*trust, *distrust}))
    out = []
    for page_id, host, path, rule in rows:
        bad = distrust.get(host, 0) > max(trust.get(host, 0) * (1 + 1e-9), least)
        out.append((page_id, host, path, rule.text if rule else None, rule.verdict if rule else "block" if bad else "allow"))
    return sorted(out, key=str)


def shown(df):
    return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()), key=str)


def test_urls_of_a_linked_web(spark):
    draw = random.Random(2)
    hosts = [f"{p}{i}.{d}" for i in range(6) for p, d in (("www.", "example.com"), ("a", "site.net"), ("b", "wiki.org"), ("c", "lone.io"))]
    pages, rows = [], []
    for i in range(300):
        url = f"https://{draw.choice(hosts)}/{draw.choice(['en/', 'es/', 'fr/x', 'de', ''])}{draw.choice(['', '?q=/es/', '#f'])}"
        links = [draw.choice(["https://", "//", "HTTP://"]) + draw.choice(hosts) + draw.choice(["", "/p", "?x"]) for _ in range(draw.randint(0, 5))] + ["/own"]
        html = "".join(f"<A {draw.choice(['href', 'HREF'])}={q}{link}{q}>x</A>" for link in links for q in ['"'])
        pages.append((i, url, links))
        rows.append((i, url, html, "clash"))
    awkward = [None, "", "no scheme", "x://", "HTTP://ExAmple.COM", "http://com/", "http://notcom/", "a://b://c/d", "http://u@h:80/p?q#r", "http://É.COM/é"]
    for i, url in enumerate(awkward, 1000):
        pages.append((i, url, []))
        rows.append((i, url, None if i % 2 else "", "clash"))
    pages.append((1, "http://wiki.org/", []))
    rows.append((1, "http://wiki.org/", "<p>", "clash"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    assert shown(url_filter.judge_urls(df, RULES)) == judge(pages)
    assert url_filter.judge_urls(df.limit(0), RULES).collect() == []


def test_verdicts_do_not_depend_on_the_size_of_the_web(spark):
    """A long chain of hosts up to a blocked one, once and among many copies of itself."""

    def web(copies):
        rows = []
        for c in range(copies):
            for i in range(12):
                to = f"https://n{i + 1}.c{c}.test/" if i < 11 else "https://example.com/en/"
                rows.append((f"{c}-{i}", f"https://n{i}.c{c}.test/x", f'<a href="{to}">'))
        return [*rows, ("bad", "https://example.com/en/", ""), ("fine", "https://lonely.test/", "")]

    def verdicts(copies):
        df = spark.createDataFrame(web(copies), "page_id string, url string, html string")
        return {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, RULES).collect()}

    small, large = verdicts(1), verdicts(300)
    assert small == {p: large[p] for p in small} and small["0-0"] == "block" and small["fine"] == "allow"
    assert len({large[f"{c}-{i}"] for c in range(300) for i in range(12)}) == 1


def test_radius_counts_every_bit():
    a = np.array([0, -1, 1 << 62, -(1 << 63)])
    assert vector_search.differing_bits(a, np.array([-1, 0, -(1 << 62), 0])).tolist() == [64, 64, 1, 1]


def test_url_query_on_the_whole_table(spark, sf_dir):
    import re

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    link = re.compile(url_filter._LINK)
    pages = [(r["page_id"], r["url"], link.findall(r["html"] or "")) for r in rows]
    assert shown(QUERIES["op1_url_filter"](spark, sf_dir)) == judge(pages)


# --- vectors ---------------------------------------------------------------


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        far = sorted((math.dist(v, w), i) for i, w in rows if i != q)
        out[q] = far[:k]
    return out


def test_recall_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    truth = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    found = defaultdict(list)
    for r in QUERIES["op4_nearest_neighbours"](spark, sf_dir).collect():
        found[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert found.keys() == truth.keys()
    hits = 0
    vectors = dict(rows)
    for q, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
        assert all(s == pytest.approx(math.dist(vectors[q], vectors[i]), abs=1e-12) for _, s, i in own)
        hits += len({i for _, _, i in own} & {i for _, i in truth[q]})
    assert hits / (10 * len(truth)) >= 0.9


def test_awkward_vectors(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(1, 120)]
    rows += [(200 + i, list(rows[0][1])) for i in range(15)] + [rows[3]]
    odd = [(300, None), (301, [0.0] * 8), (302, [None] + [1.0] * 7), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (305, []), (306, [1.0] * 5), (None, [1.0] * 8)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<float>, score string")
    queries = df.filter("vec_id % 50 = 0 OR vec_id = 1 OR vec_id > 299")
    found = defaultdict(list)
    for r in vector_search.nearest(df, queries, 10).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"]))
    assert sorted(found) == [1, 50, 100, 200]
    assert [i for _, i in sorted(found[1])] == list(range(200, 210))
    assert all(len(v) == 10 for v in found.values())
    few = df.filter("vec_id < 5")
    assert vector_search.nearest(few, few, 10).count() == 12
    assert vector_search.nearest(df.limit(0), df.limit(0)).collect() == []


def test_all_codes_within_the_radius_are_probed():
    draw = random.Random(6)
    for radius in (0, 3, 8, 21, 27):
        shares = vector_search.Codes(np.zeros(1), np.zeros(1), radius).shares()
        probes = Counter(j for j, _ in vector_search._probes(shares))
        assert all(probes[j] == sum(math.comb(8, f) for f in range(s + 1)) for j, s in enumerate(shares))
        for _ in range(300):
            bits = draw.sample(range(64), radius)
            per_part = Counter(b // 8 for b in bits)
            assert any(per_part[j] <= s for j, s in enumerate(shares) if s >= 0)
