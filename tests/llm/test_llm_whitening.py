"""Whitening against exact fractions and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from salesloom.llm import whitening
from salesloom.llm.queries import QUERIES


def plain(vectors):
    """(n, sums, exact covariance, exact deviations) of lists of floats."""
    rows = [[math.floor(1024 * Fraction(float(c))) + 100000 for c in v] for v in vectors]
    n, size = len(rows), len(rows[0])
    sums = [sum(r[i] for r in rows) for i in range(size)]
    own = [[n * r[i] - sums[i] for i in range(size)] for r in rows]
    cov = [[Fraction(sum(o[i] * o[j] for o in own), n**3) for j in range(size)] for i in range(size)]
    return n, sums, cov, [sum(x * x for x in o) for o in own], np.array(own, dtype=float) / n


def draw(n=60, size=6, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(size, size)) * [3, 2, 1, 0.5, 0.3, 0.2][:size]
    return (rng.normal(size=(n, size)) @ mix + rng.normal(size=size) * 50).astype(np.float32)


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string").repartition(3)


def test_equals_exact_fractions(spark):
    vectors = draw()
    n, sums, cov, deviations, own = plain(vectors)
    df = frame(spark, vectors)
    rows = df.selectExpr("cast(embedding as array<double>) as vector")
    assert whitening.dimension_sums(rows, 6) == (n, sums)
    found = whitening.squares(rows, 6, n, sums)
    assert whitening.covariance(found, 6, n).tolist() == [[float(c) for c in r] for r in cov]
    values, axes = np.linalg.eigh(np.array(cov, dtype=float))
    expected = own @ axes[:, ::-1] / np.sqrt(values[::-1])
    out = sorted(whitening.whiten(df, components=4).collect(), key=lambda r: r["vec_id"])
    assert [int(r["deviation"]) for r in out] == deviations and {r["n"] for r in out} == {n}
    white = np.array([r["whitened"] for r in out])
    signs = np.sign((white * expected[:, :4]).sum(axis=0))
    assert np.allclose(white, expected[:, :4] * signs, atol=1e-9)
    assert np.allclose(out[0]["explained"], values[::-1][:4] / values.sum(), rtol=1e-12)
    assert out[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("top", [1 << 20, 1 << 40, 1 << 60])
def test_squares_are_exact_at_any_size(top):
    rng = np.random.default_rng(4)
    values = rng.integers(-top, top, size=(1024, 5))
    values[0] = [top, -top, 0, 1, -1]
    assert whitening.square_sums(values).tolist() == [sum(int(x) ** 2 for x in values[:, j]) for j in range(5)]
    assert whitening.square_sums_of_rows(values) == [sum(int(x) ** 2 for x in r) for r in values]


def test_large_offsets_cost_no_digit(spark):
    vectors = draw() / 100 + np.float32(1000)
    out = whitening.whiten(frame(spark, vectors)).first()
    assert out["identity_error"] < 1e-9
    values = np.linalg.eigvalsh(np.array(plain(vectors)[2], dtype=float))[::-1]
    kept = values[values > values[0] * 1e-13]
    assert np.allclose(out["explained"], kept / values.sum(), rtol=1e-9)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = draw(20, 3)
    bad = [None, [], [1.0, None, 2.0], [nan, 0.0, 0.0], [inf, 0.0, 0.0], [1.0, 2.0], [0.0, 0.0, 0.0]]
    ids = [*range(20), 20, 21, 22, 23, 24, 25, None]
    out = whitening.whiten(frame(spark, [*good, *bad], ids)).collect()
    assert sorted(str(r["vec_id"]) for r in out) == sorted(map(str, [*range(20), None]))
    n, _, _, deviations, _ = plain([*good, [0.0] * 3])
    assert {r["n"] for r in out} == {n} and sorted(int(r["deviation"]) for r in out) == sorted(deviations)
    twice = frame(spark, good).union(frame(spark, good))
    assert whitening.whiten(twice).count() == 40 and whitening.whiten(twice).first()["n"] == 40


def test_without_variance_and_empty(spark):
    same = whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert [(int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(0, [], [], 0.0)] * 3
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [None])).collect() == []


def test_query_on_the_whole_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    kept = [r for r in vectors if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    n, _, cov, deviations, own = plain([r["embedding"] for r in kept])
    values, axes = np.linalg.eigh(np.array(cov, dtype=float))
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    found = {(r["vec_id"], r["component"]): r for r in QUERIES["op11_whitening"](spark, sf_dir).collect()}
    assert len(found) == 8 * n
    by_component = []
    for k in range(8):
        own_rows = [found[r["vec_id"], k + 1] for r in kept]
        white = np.array([r["whitened"] for r in own_rows])
        expected = own @ axes[:, k] / np.sqrt(values[k])
        assert np.allclose(white, expected * np.sign(white @ expected), atol=1e-6)
        assert [r["deviation"] for r in own_rows] == deviations
        assert abs(own_rows[0]["explained"] / (values[k] / float(sum(cov[i][i] for i in range(len(cov))))) - 1) < 1e-9
        by_component.append(own_rows[0]["explained"])
    assert by_component == sorted(by_component, reverse=True)
    assert all(r["identity_error"] < 1e-8 and r["n"] == n for r in found.values())
