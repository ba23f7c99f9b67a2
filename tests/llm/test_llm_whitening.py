"""Whitening against the singular vectors of the exactly centred rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from conftest import CLASHING
from pyspark.sql import functions as F

from flatproof.llm import whitening as w

ROWS = "vec_id bigint, embedding array<double>"


def usable(v):
    return v is not None and v != [] and all(c is not None and math.isfinite(c) and abs(c) <= w.GREATEST for c in v)


def brute(rows, components=16):
    """id -> [deviation] and, if it can be told, singular vectors."""
    whole = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows if usable(v)]
    fit = sorted({x for _, x in whole})
    sizes = [len(x) for x in fit]
    dimension = max(set(sizes), key=lambda s: (sizes.count(s), s))
    fit = [x for x in fit if len(x) == dimension]
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = [[n * a - s for a, s in zip(x, sums)] for x in fit]
    exact = np.array([[float(Fraction(v, n)) for v in r] for r in centred])
    _, singular, turned = np.linalg.svd(exact, full_matrices=False)
    values, vectors = singular**2 / n, turned.T
    own = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), [float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
           for i, x in whole if len(x) == dimension]
    return n, own, values[:components], vectors[:, :components], values.sum()


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    df = df.selectExpr("*", *[f"vec_id as `{c}`" for c in extra])
    model = w.fit_whitening(df)
    got = w.whiten(df, model)
    assert got.columns == [*[c for c in df.columns if c not in ("deviation", "whitened")], "deviation", "whitened"]
    n, own, values, vectors, trace = brute(rows)
    kept = int((values > 1e-12 * values[0]).sum())
    assert (model.n, len(model.components)) == (n, kept)
    assert model.identity_error < 1e-9
    assert np.allclose(model.explained, values[:kept] / trace, rtol=1e-9)
    answers = sorted(((r.vec_id, r.deviation, r.whitened) for r in got.collect()), key=lambda r: (repr(r[0]), r[1] or 0, r[2]))
    signs = np.sign((model.components * vectors[:, :kept].T).sum(axis=1))
    want = [(i, d if d < 2**63 else None, (np.array(x) @ vectors[:, :kept] / np.sqrt(values[:kept]) * signs)) for i, d, x in own]
    want.sort(key=lambda r: (repr(r[0]), r[1] or 0, r[2].tolist()))
    assert [a[:2] for a in answers] == [b[:2] for b in want]
    assert np.allclose([a[2] for a in answers], [b[2] for b in want], atol=1e-7)
    return model


def vectors_of(rng, n, d, stretch=2.0):
    return [[rng.gauss(0, 1) * stretch ** -(j % 7) for j in range(d)] for _ in range(n)]


def test_against_exact_covariance(spark):
    rng = random.Random(1)
    rows = list(enumerate(vectors_of(rng, 300, 20)))
    rows += [(i + 1000, v) for i, v in rows[:40]] + [(5, rows[0][1])] * 60  # copies count once
    rows += [(None, rows[3][1]), (2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] * 20), (2004, [float("inf")] + [0.0] * 19),
             (2005, [1e300] * 20), (2006, [1.0, 2.0]), (2007, [0.5] * 21)]
    model = check(spark, rows, [c for c in CLASHING if c != "tie"] + ["deviation", "whitened", "component"])
    assert len(model.components) == 16


def test_directions_without_variance(spark):
    rng = random.Random(2)
    rows = [(i, [v[0], 3.0, v[1], -7.25, v[2]]) for i, v in enumerate(vectors_of(rng, 100, 3))]
    assert len(check(spark, rows).components) == 3
    # One column is the sum of two others, in whole numbers.
    rows = [(i, [a / 64, b / 64, (a + b) / 64]) for i, (a, b) in enumerate((rng.randrange(900), rng.randrange(9)) for _ in range(200))]
    assert len(check(spark, rows).components) == 2


def test_badly_scaled_columns(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1e6), rng.gauss(0, 1), rng.gauss(0, 1e3), 1e6 * (i % 2) + rng.gauss(0, 0.1)]) for i in range(250)]
    check(spark, rows)


def test_one_vector_and_none(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 3):
        df = spark.createDataFrame(rows, ROWS)
        model = w.fit_whitening(df)
        assert len(model.components) == 0
        assert [(r.deviation, r.whitened) for r in w.whiten(df, model).collect()] == [(0, [])] * (3 if model.n else 0)


def test_sums_and_deviations_are_exact():
    x = np.array([[2**50, -(2**50), 7], [3, 4, 5]])
    sums = [2**50 + 3, -(2**50) + 4, 12]
    d = w.numerators(x, 2**13, sums)
    assert d.tolist() == [[2**13 * int(a) - s for a, s in zip(row, sums)] for row in x]
    root = math.isqrt(2**63 - 1)
    rows = [[root, 0], [root + 1, 0], [1, 2], [2**62, 1], [root, 5]]
    want = [sum(v * v for v in r) for r in rows]
    assert w.deviations(np.array(rows, object)) == [v if v < 2**63 else None for v in want]


def test_fit_list_sums(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * 2.0**54, rng.random()]) for i in range(50)]
    fit = w.fit_list(spark.createDataFrame(rows, ROWS), "embedding")
    xs = {tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows}
    assert {tuple(r.x) for r in fit.collect()} == xs
    assert w.exact_sums(fit) == (len(xs), 2, [sum(c) for c in zip(*xs)])


@pytest.mark.parametrize("kind", ["array<float>", "array<int>", "array<decimal(10,3)>"])
def test_other_number_types(spark, kind):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, [float(rng.randrange(9)), float(rng.randrange(5))]) for i in range(60)], ROWS)
    model = w.fit_whitening(df.select("vec_id", F.col("embedding").cast(kind).alias("embedding")))
    assert model.components.shape == (2, 2) and model.identity_error < 1e-9


def test_query_on_whole_vectors(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, own, values, vectors, trace = brute(rows)
    got = w.op12_embedding_whitening(spark, sf_dir).collect()
    assert len(got) == len(own) * 16 and {r.n for r in got} == {n} and {r.identity_error for r in got}.pop() < 1e-9
    by_id = {i: (d, x) for i, d, x in own}
    signs = {}
    for r in got:
        deviation, x = by_id[r.vec_id]
        want = float(np.dot(x, vectors[:, r.component - 1])) / math.sqrt(values[r.component - 1])
        sign = signs.setdefault(r.component, 1 if want * r.whitened > 0 else -1)
        assert r.deviation == deviation and abs(r.whitened - sign * want) < 1e-6
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 * r.explained + 1e-12
