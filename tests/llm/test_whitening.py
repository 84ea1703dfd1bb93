"""Whitening against numpy's symmetric eigensolver."""

import math

import numpy as np
import pytest

from riskloom.llm import queries, whitening


@pytest.mark.parametrize("kind", ["random", "geometric", "repeated", "diagonal", "indefinite"])
def test_spectrum_is_that_of_the_eigensolver(kind):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((48, 48)))[0]
    values = {
        "random": rng.random(48), "geometric": 3.0 ** -np.arange(48), "repeated": np.repeat([9, 4, 4, 1], 12), "diagonal": np.arange(48) % 7, "indefinite": rng.standard_normal(48)
    }[kind]
    a = np.diag(values.astype(float)) if kind == "diagonal" else q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, v = whitening.spectrum(a, 48)
    assert np.allclose(got, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * np.abs(values).max())
    assert np.abs(v.T @ v - np.eye(48)).max() < 1e-13 and np.linalg.norm(a @ v - v * got) < 1e-12 * np.linalg.norm(a)
    assert np.allclose(whitening.spectrum(a, 4)[0], got[:4])


def reference(vectors):
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, s = len(fit), fit.sum(axis=0)
    apart = fit - s / n
    values, v = np.linalg.eigh(apart.T @ apart / n)
    values, v = values[::-1][:4], v[:, ::-1][:, :4]
    exact = [(i, sum((n * c - int(t)) ** 2 for c, t in zip(x, s))) for i, x in kept]
    return kept, n, exact, values, values / np.trace(apart.T @ apart / n), (np.array([x for _, x in kept]) - s / n) @ v / np.sqrt(values)


def compare(rows, vectors):
    kept, n, exact, values, share, white = reference(vectors)
    k = len(values)
    assert len(rows) == k * len(kept)
    assert sorted({(r.vec_id, r.deviation) for r in rows}) == sorted(set(exact)) and {r.n for r in rows} == {n}
    for c in range(1, k + 1):
        own = sorted((r.vec_id, r.whitened) for r in rows if r.component == c)
        one = next(x for x in own if x[0] != 7 and abs(x[1]) > 0.5)
        ids = [i for i, _ in kept]
        sign = np.sign(one[1] * white[ids.index(one[0]), c - 1])
        want = sorted(zip(ids, sign * white[:, c - 1]))
        assert np.allclose([a for _, a in own], [b for _, b in want], atol=1e-8)
        assert np.allclose([r.explained for r in rows if r.component == c], share[c - 1], rtol=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whole_table(spark, small):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    compare(queries.op13_whitening(spark, small).collect(), vectors)


SCHEMA = "vec_id long, embedding array<float>, component string"


def test_copies_weigh_nothing_and_odd_rows_go(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(np.float32(c)) for c in rng.standard_normal(6)]) for i in range(60)]
    vectors += [(100 + i, vectors[0][1]) for i in range(300)] + [(7, vectors[3][1])]
    odd = [(900, None), (901, [None] * 6), (902, [math.nan] + [1.0] * 5), (903, [math.inf] * 6), (904, [-math.inf] + [0.0] * 5)]
    df = spark.createDataFrame([(*v, "x") for v in vectors + odd], SCHEMA)
    compare(whitening.whiten(df).collect(), vectors)
    short = spark.createDataFrame([(905, [1.0, 2.0], "x"), (906, [], "x")], SCHEMA)
    compare(whitening.whiten(df.union(short)).collect(), vectors)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]], ids=range(5))
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_components_without_variance_do_not_appear(spark):
    out = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], "x") for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in out} == {1} and out[0].explained == pytest.approx(1.0)


def test_large_distances_are_exact_or_null(spark):
    rows = [(i, [float(2.0**i)] * 2, "x") for i in (1, 20, 40, 50)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, c string")).collect()
    s, want = sum(256 * 2**i for i in (1, 20, 40, 50)), {}
    for i in (1, 20, 40, 50):
        d = 2 * (4 * 256 * 2**i - s) ** 2
        want[i] = d if d < 1 << 63 else None
    assert {r.vec_id: r.deviation for r in out} == want
