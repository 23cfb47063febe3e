"""Whitening, against exact fractions over all rows."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from starmart.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, label int, whitened string, n int"


def brute(rows: list[tuple]) -> tuple[list, list, np.ndarray]:
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
            for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[k] for _, x in kept) for k in range(d)]
    away = [[n * x[k] - sums[k] for k in range(d)] for _, x in kept]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in away), n**3)) for j in range(d)] for i in range(d)])
    return kept, [sum(a * a for a in row) for row in away], cov


def check(spark, rows: list[tuple], parts: int = 3) -> None:
    kept, deviations, cov = brute(rows)
    d, n = len(cov), len(kept)
    got = W.whitened_components(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert len(got) == n * min(d, 32)
    found = W.fit(W.vectors(spark.createDataFrame(rows, SCHEMA)))
    assert found.n == n
    values = np.linalg.eigvalsh(cov)[::-1][:32]
    assert np.allclose(found.variances, np.maximum(values, 0), rtol=1e-9, atol=1e-9 * max(values[0], 1e-300))
    assert np.allclose(cov @ found.components.T, found.components.T * values, atol=1e-8 * max(values[0], 1e-9))
    mean = np.array([float(Fraction(sum(x[k] for _, x in kept), n)) for k in range(d)])
    want = {}
    for (vec_id, x), deviation in zip(kept, deviations, strict=True):
        w = found.components @ (np.array(x, float) - mean)
        w = [a / math.sqrt(v) if v > 0 else 0.0 for a, v in zip(w, found.variances, strict=True)]
        want.setdefault(vec_id, []).append((deviation, w))
    total = np.trace(cov)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(found.variances[r.component - 1] / total if total else 0, rel=1e-9, abs=1e-12)
        assert any(abs(r.deviation - deviation) == 0 and abs(r.whitened - w[r.component - 1]) < 1e-5 for deviation, w in want[r.vec_id])


@pytest.mark.parametrize(("seed", "d", "n"), [(1, 6, 60), (2, 40, 90), (3, 5, 4), (4, 3, 1)])
def test_equals_exact_covariance(spark, seed, d, n):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(3 * (k % 2), 1 + k) for k in range(d)], 1, "w", 2) for i in range(n)]
    rows += [(900, None, 0, "", 1), (901, [None] * d, 1, None, 1), (902, [float("nan")] * d, 1, None, 1),
             (903, [1.0] * (d - 1) + [float("-inf")], 1, None, 1), rows[0], rows[0], (None, rows[0][1], None, None, None)]
    check(spark, rows)


def test_hot_vector_and_equal_vectors(spark):
    rows = [(i, [0.5, 2.0, -1.0], 1, "", 1) for i in range(50)] + [(i, [0.1 * i, 0.3, 0.2 * i], 1, "", 1) for i in range(9)]
    check(spark, rows)
    got = W.whitened_components(spark.createDataFrame(rows[:50], SCHEMA)).collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, 0.0, 0.0, 0.0)}


def test_large_entries_stay_exact(spark):
    """Beyond 64-bit squares the sums are Python's; a deviation no long holds is NULL in the query."""
    rows = [(i, [1e9 * i, 3.0, -2e9 + i], 1, "", 1) for i in range(20)]
    _, deviations, cov = brute(rows)
    table = W.vectors(spark.createDataFrame(rows, SCHEMA))
    found = W.fit(table)
    assert np.allclose(found.variances[:1], np.linalg.eigvalsh(cov)[-1:], rtol=1e-12)
    got = {r.vec_id: int(r.deviation) for r in W.whiten(table, found).collect()}
    assert got == dict(enumerate(deviations))
    assert {r.deviation for r in W.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}


def test_nothing_and_ragged(spark):
    for rows in ([], [(1, None, 1, "", 1)], [(1, [], 1, "", 1)]):
        assert W.whitened_components(spark.createDataFrame(rows, SCHEMA)).collect() == []
    rows = [(1, [1.0], 1, "", 1), (2, [1.0, 2.0], 1, "", 1)]
    with pytest.raises(Exception, match="cannot share a covariance"):
        W.whitened_components(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = W.whitened_components(table).toPandas()
    assert len(got) == 32 * table.count() and got.identity_error.max() < 1e-9
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(wide.T @ wide / len(wide) - np.eye(32)).max() < 1e-9
    assert got.explained.between(0, 1).all()
