"""Hard negatives and whitening against plain Python over whole small tables, odd rows included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import negatives, whitening
from farebox.tables import SCHEMAS

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(0, 0.2, 24).astype(np.float32).tolist(), int(k) % 3) for k in range(0, 420)]
    rows += [(1000 + k, rows[5][1], 1) for k in range(30)]  # copies
    rows += [
        (500, None, 1),
        (501, [0.5] * 23 + [None], 1),
        (502, [0.5] * 23 + [NAN], 1),
        (503, [INF] * 24, 2),
        (504, rows[0][1], None),
        (None, rows[0][1], 0),
        (None, rows[1][1], 1),
        (7, rows[7][1], 1),  # repeated
        (100, rows[100][1], 1),  # a repeated anchor
        (600, [0.0] * 24, 5),  # an anchor that scores zero
    ]
    data = spark.createDataFrame(rows, SCHEMAS["embeddings"])
    return data.select("*", *(F.lit("keep").alias(c) for c in ("row", "x", "slot", "kind", "n", "windows"))).repartition(3).cache()


def known(data):
    out = []
    for r in data.collect():
        if r.label is not None and r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding):
            label = (r.label + 1) % 10 if r.vec_id is not None and r.vec_id % 7 == 0 else r.label
            out.append((r.vec_id, label, [int(np.floor(256 * float(c))) for c in r.embedding]))
    return out


def mined(data, top=5):
    rows = known(data)
    out = []

    def order(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0]))[:top]

    for vec_id, label, x in rows:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(v, lab == label, sum(p * q for p, q in zip(x, y))) for v, lab, y in rows]
        for positive, score in order([(v, s) for v, same, s in scored if same and v != vec_id]):
            hard = [(v, s) for v, same, s in scored if not same and 80 * score <= 100 * s <= 100 * score]
            out += [(vec_id, positive, k, v, score, s) for k, (v, s) in enumerate(order(hard), 1)]
    return sorted(out, key=repr)


def test_negatives_of_odd_rows(odd_vectors, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 64)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    got = sorted(map(tuple, negatives.judge(odd_vectors).collect()), key=repr)
    assert got == mined(odd_vectors) and len(got) > 20


def test_bounds_hold_and_leave_pairs_out():
    draw = np.random.default_rng(5)
    steps = np.repeat(draw.integers(-90, 90, (200, 16)), 4, axis=1) + draw.integers(-3, 4, (200, 64))
    rows = negatives.Rows(steps.astype(float))
    exact = steps @ steps.T
    for low, high in ((-np.inf, np.inf), (50_000, np.inf), (10_000, 60_000)):
        everywhere = np.full(200, low), np.full(200, high)
        left = negatives.still_open(rows, rows, np.ones((200, 200), bool), *everywhere)
        assert left[(exact >= low) & (exact <= high)].all()
    assert left.mean() < 0.6


def test_large_components_are_exact(spark):
    rows = [(0, [2.0**40, 3.0], 1), (1, [2.0**40, 5.0], 1), (2, [2.0**40, 4.0], 2), (3, [1e30, 0.0], 2), (4, [1.0], 1)]
    wide = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = [tuple(r) for r in negatives.mine(wide, F.col("label"), F.expr("vec_id = 0")).collect()]
    a, b = 2**48, 256
    positive, negative = a * a + 3 * b * 5 * b, a * a + 3 * b * 4 * b
    assert positive > 1 << 63 and negative < positive  # told apart beyond 64 bits
    assert got == [(0, 1, 1, 2, (1 << 63) - 1, (1 << 63) - 1)]


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], SCHEMAS["embeddings"])
    assert negatives.judge(nothing).count() == 0 and whitening.judge(nothing).count() == 0


def whitened(data):
    rows = [
        (r.vec_id, [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding])
        for r in data.collect()
        if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)
    ]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return rows, n, sums, values, vectors


def test_whitening_of_odd_rows(odd_vectors):
    rows, n, sums, values, vectors = whitened(odd_vectors)
    got = whitening.judge(odd_vectors).toPandas()
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    shares = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(shares, values[:16] / values.sum(), rtol=1e-10)
    want = {}
    for vec_id, x in rows:
        white = (np.array(x) - sums / n) @ vectors[:, :16] / np.sqrt(values[:16])
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        want.setdefault(vec_id, []).append((deviation, np.abs(white)))
    for vec_id, part in got.groupby("vec_id", dropna=False):
        wanted = want[None if np.isnan(vec_id) else int(vec_id)]
        assert sorted(set(part["deviation"])) == sorted({d for d, _ in wanted})
        for component, values_of in part.groupby("component"):
            near = sorted(abs(v) for v in values_of["whitened"])
            assert np.allclose(near, sorted(w[component - 1] for _, w in wanted), atol=1e-7)


def test_fewer_components_than_dimensions(spark):
    base = np.random.default_rng(1).integers(-40, 40, (60, 3))
    flat = np.concatenate([base, base[:, :1] + base[:, 1:2], np.zeros((60, 2))], axis=1) / 64
    rows = [(k, v.tolist(), 0) for k, v in enumerate(flat)] + [(99, [0.0] * 4, 0)]  # one of another length
    got = whitening.judge(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).toPandas()
    assert set(got["component"]) == {1, 2, 3} and 99 not in set(got["vec_id"])
    assert got["identity_error"][0] < 1e-10 and abs(got.groupby("component")["explained"].first().sum() - 1) < 1e-10


def test_one_vector_has_no_variance(spark):
    rows = [(k, [0.5, 0.25], 0) for k in range(4)]
    assert whitening.judge(spark.createDataFrame(rows, SCHEMAS["embeddings"])).count() == 0


def test_factor_and_rotations_give_the_eigenvectors():
    draw = np.random.default_rng(2)
    root = draw.normal(size=(9, 5)) * [1, 1e-3, 1, 1e-6, 1]
    factor = whitening.pivoted_cholesky(root @ root.T)
    assert factor.shape == (9, 5) and np.allclose(factor @ factor.T, root @ root.T)
    rotated = whitening.jacobi(factor)
    assert np.allclose((rotated**2).sum(0), np.linalg.svd(root)[1] ** 2, rtol=1e-3)
    gram = rotated.T @ rotated
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-14 * gram.max()
