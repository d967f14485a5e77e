"""Whitening against whole-number arithmetic in plain Python."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import whitening
from tidelake.llm.queries import QUERIES


def plain(vectors, scale=256):
    """Distinct vectors, sums and the exact covariance."""
    fit = sorted({tuple(math.floor(scale * c) for c in v) for v in vectors})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    y = [[n * v[i] - sums[i] for i in range(d)] for v in fit]
    covariance = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    return n, sums, covariance


def check(rows, vectors, components):
    """``rows`` of whiten() against the plain fit of ``vectors`` (id -> vector)."""
    n, sums, covariance = plain(vectors.values())
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    got = {(r.id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(vectors) * components
    for c in range(components):
        sign = {1.0, -1.0}
        for i, v in vectors.items():
            x = [math.floor(256 * e) for e in v]
            r = got[i, c + 1]
            assert r.n == n and r.deviation == sum((n * e - s) ** 2 for e, s in zip(x, sums))
            want = sum(float(Fraction(n * e - s, n)) * a for e, s, a in zip(x, sums, axes[:, c])) / math.sqrt(values[c])
            assert r.explained == pytest.approx(values[c] / np.trace(covariance), rel=1e-9) and r.identity_error < 1e-9
            sign &= {s for s in (1.0, -1.0) if r.whitened == pytest.approx(s * want, rel=1e-6, abs=1e-9)}
        assert sign, c


def test_query(spark, folder):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    check(QUERIES["op11_whitening"](spark, folder).withColumnRenamed("vec_id", "id").collect(), vectors, 4)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit("c").alias(c) for c in ("id", "x", "v", "p", "n", "whitened")])


def test_covariance_is_exact_for_large_entries(spark):
    draw = np.random.default_rng(3)
    data = [[float(v) for v in row] for row in draw.integers(-(2**40), 2**40, (40, 3))]
    distinct = whitening.integer_vectors(frame(spark, list(enumerate(data))).select("vec_id", "embedding"), "embedding", 256).select("x").distinct()
    model = whitening.fit(distinct)
    n, sums, covariance = plain(data)
    assert (model.n, model.sums) == (n, sums) and (model.covariance == covariance).all()
    mixed = [[float(2**44 if i == j else i + j) for j in range(3)] for i in range(20)]
    model = whitening.fit(whitening.integer_vectors(frame(spark, list(enumerate(mixed))).select("embedding"), "embedding").distinct())
    assert (model.covariance == plain(mixed)[2]).all()


def test_copies_nulls_and_other_lengths(spark):
    draw = np.random.default_rng(4)
    data = {i: [float(v) for v in row] for i, row in enumerate(draw.normal(size=(30, 5)))}
    hot = [(i, data[0]) for i in range(100, 200)]
    out = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [float("inf")] + [0.0] * 4), (905, [1.0])]
    rows = whitening.whiten(frame(spark, [*data.items(), *hot, *out])).collect()
    check(rows, {**data, **dict(hot)}, 4)
    again = [(None, data[3]), (7, data[7])]
    rows = whitening.whiten(frame(spark, [*data.items(), *again])).collect()
    assert sum(r.id is None for r in rows) == 4 and sum(r.id == 7 for r in rows) == 8 and {r.n for r in rows} == {30}


def test_without_variance(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert {(r.id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    flat = whitening.whiten(frame(spark, [(i, [float(i), 1.0, 3.0]) for i in range(5)])).collect()
    assert {(r.component, r.whitened is None, r.explained) for r in flat} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    assert all(r.identity_error < 1e-9 for r in flat)
    tie = whitening.whiten(frame(spark, [(i, [float(i % 2), float(i // 2)]) for i in range(4)])).collect()
    assert all(r.identity_error < 1e-9 and r.explained == pytest.approx(0.5) for r in tie)


def test_empty(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0])]).limit(0)).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_deviation_beyond_64_bits_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)overflow|too (big|large)|not in range|int"):
        whitening.whiten(frame(spark, [(1, [1e15, 0.0]), (2, [-1e15, 1.0])])).collect()
