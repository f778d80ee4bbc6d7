"""Whitening against the covariance and eigenvectors that numpy gives for the whole table."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tableload.llm import embedding_whitening as W
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component int, whitened double"


def x_of(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def check(got, rows, components=8):
    """``got`` (collected rows) against plain numpy over ``rows`` [(id, vector)]."""
    x = np.array([x_of(v) for _, v in rows], float)
    n, d = x.shape
    sums = [sum(x_of(v)[j] for _, v in rows) for j in range(d)]
    centred = np.array([[float(Fraction(a * n - s, n)) for a, s in zip(x_of(v), sums, strict=True)] for _, v in rows])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, d)
    assert len(got) == n * count
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    for i, (vec_id, v) in enumerate(rows):
        mine = sorted(by[vec_id], key=lambda r: r.component)[:count] if len(by[vec_id]) == count else None
        if mine is None:
            continue  # repeated ids are compared by number only
        assert [r.component for r in mine] == list(range(1, count + 1))
        assert {r.n for r in mine} == {n}
        assert {r.deviation for r in mine} == {sum((n * a - s) ** 2 for a, s in zip(x_of(v), sums, strict=True))}
        for k, r in enumerate(mine):
            assert r.explained == pytest.approx(max(values[k], 0) / values.sum(), rel=1e-9, abs=1e-13)
            if values[k] < 1e-9 * values[0]:
                assert r.whitened is None
            elif min(abs(values[k] - values[j]) for j in range(d) if j != k) > 1e-4 * values[0]:
                want = centred[i] @ vectors[:, k] / math.sqrt(values[k])
                assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-8, abs=1e-8)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(1, count + 1):
        column = [r.whitened for r in got if r.component == k]
        if column[0] is not None:
            assert np.var(column) == pytest.approx(1, rel=1e-9)


@pytest.mark.parametrize("name", ["plain", "hot", "few", "low_rank", "wide_range"])
def test_equals_numpy(spark, name):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 12)) * np.linspace(0.05, 1, 12)
    if name == "hot":  # a third of the rows are one vector
        data[:100] = data[0]
    if name == "few":
        data = data[:5]
    if name == "low_rank":
        data = (rng.integers(-50, 50, size=(200, 3)) @ rng.integers(-3, 4, size=(3, 10))) / 64
    if name == "wide_range":
        data[:, 0] *= 1e4
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame([(i, v, 1, 5, 6, 0.5) for i, v in rows], SCHEMA).repartition(37)  # two rounds of combining
    check(W.whiten(df).collect(), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [0.1 * i, 0.2 - i * i / 50, math.sin(i)]) for i in range(20)]
    twice = [(None, [0.5, 0.25, 0.125]), (None, [0.5, 0.25, 0.125]), (77, [1.0, 2.0, 3.0]), (77, [1.0, 2.0, 3.0])]
    bad = [(90, None), (91, [0.1, None, 0.2]), (92, [nan, 0.1, 0.2]), (93, [0.1, inf, 0.2]), (94, [-inf, 0.1, 0.2]), (95, []),
           (96, [1.0]), (97, [1e30, 0.0, 0.0]), (98, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, None, 5, 6, 0.5) for i, v in good + twice + bad], SCHEMA).repartition(4)
    rows = W.whiten(df).collect()
    check(rows, good + twice)
    assert sorted({r.vec_id for r in rows if r.vec_id is not None}) == [*range(20), 77]
    assert sum(r.vec_id is None for r in rows) == 6
    empty = W.whiten(df.filter("vec_id > 89 AND vec_id NOT IN (96, 98)"))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_vectors_have_no_direction(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    got = W.whiten(df).collect()
    assert len(got) == 8
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(4, 0, None, None, None)}


def test_deviations_beyond_a_long():
    x = np.array([[3 * 2**40, 0], [0, 1]])
    whole = W._scaled(x, 2, [3 * 2**40, 1])
    assert W._deviations(whole) == [None, None]
    big = W._scaled(np.array([[2**52, 7]]), 2**20, [5, 6])
    assert big.dtype == object and big[0, 0] == 2**72 - 5
    assert W._deviations(np.array([[3 * 10**9, 10**9]])) == [None] and W._deviations(np.array([[3 * 10**9, 3]])) == [9 * 10**18 + 9]


@pytest.mark.parametrize("seed", range(6))
def test_updates_and_merges_keep_the_spectrum(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 30))
    data = np.floor(rng.normal(size=(int(rng.integers(2, 200)), d)) * rng.choice([1, 100, 1e4], size=d))
    if seed % 2:
        data = np.repeat(data[:4], 20, axis=0)  # many equal eigenvalues and zero terms
    cut = len(data) // 3
    one, two, whole = W.Spectrum(d), W.Spectrum(d), W.Spectrum(d)
    for r in data[:cut]:
        one.add(r)
    for r in data[cut:]:
        two.add(r)
    for r in data:
        whole.add(r)
    one.merge(two)
    want = (data - data.mean(0)).T @ (data - data.mean(0))
    size = max(np.abs(want).max(), 1)
    for s in (one, whole):
        assert np.abs(s.vectors * s.values @ s.vectors.T - want).max() < 1e-11 * size
        assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-11
        assert s.n == len(data) and np.allclose(s.mean, data.mean(0))


def test_secular_roots_are_eigenvalues():
    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 20):
        d = np.sort(rng.random(k)) + np.arange(k) * 10.0 ** rng.integers(-9, 3)
        z = rng.normal(size=k) * 10.0 ** rng.integers(-6, 2, size=k)
        pole, t = W.secular_roots(d, z * z)
        assert np.allclose(np.sort(d[pole] + t), np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), rtol=1e-12)


def test_query_on_the_small_table(spark):
    from tableload.llm.queries import REGISTRY
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(REGISTRY["op11_embedding_whitening"].build(spark, SF).collect(), [(r.vec_id, r.embedding) for r in source])
