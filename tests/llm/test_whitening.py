"""Whitening: numpy's eigenvectors on the same list, exact deviations, edge rows, degenerate spectra."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlife.llm import whitening as W
from loanlife.llm.queries import op12_whitening

DDL = "vec_id bigint, embedding array<float>, label int"


def vectors(n, d, seed=1, scale=None):
    rng = np.random.default_rng(seed)
    scale = np.linspace(2, 0.3, d) if scale is None else scale
    turn, _ = np.linalg.qr(rng.standard_normal((d, d)))
    return ((rng.standard_normal((n, d)) * scale) @ turn).astype(np.float32)


def brute_force(rows, wanted=16):
    """rows: (id, list of floats) that remain.  Everything from the whole covariance matrix."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], object)
    fit = sorted({tuple(r) for r in x.tolist()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(c - m) for c, m in zip(r, mean)] for r in fit])
    v = centred.T @ centred / n
    values, vec = np.linalg.eigh(v)
    values, vec = values[::-1][:wanted], vec[:, ::-1][:, :wanted]
    keep = values > 1e-10 * max(values[0], 0) if values[0] > 0 else np.zeros(len(values), bool)
    values, vec = values[keep], vec[:, keep]
    out = []
    for (name, _), r in zip(rows, x.tolist()):
        off = np.array([float(c - m) for c, m in zip(r, mean)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(r, sums))
        out.append((name, n, deviation, off @ vec / np.sqrt(values)))
    return out, values / np.trace(v) if values.size else values


def agree(got, rows, wanted=16, tolerance=1e-6):
    told, explained = brute_force(rows, wanted)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    sign = None
    for name, n, deviation, whitened in told:
        own = sorted(by_id[name], key=lambda r: r["component"])[:len(whitened)]
        assert [r["component"] for r in own] == list(range(1, len(whitened) + 1))
        assert {r["n"] for r in own} == {n} and {r["deviation"] for r in own} == {deviation}
        mine = np.array([r["whitened"] for r in own])
        if sign is None and np.abs(whitened).min() > 1e-3:
            sign = np.sign(mine * whitened)
        if sign is not None:
            assert np.allclose(mine, sign * whitened, atol=tolerance)
        assert np.allclose([r["explained"] for r in own], explained, rtol=1e-9)
        assert max(r["identity_error"] for r in own) <= 1e-9
    assert sign is not None and len(got) == len(told) * len(explained)


def frame(spark, data, first=0):
    return spark.createDataFrame([(first + i, [float(c) for c in v], 0) for i, v in enumerate(data)], DDL).repartition(3)


def test_query_equals_brute_force(spark, as_tables):
    data = vectors(600, 40)
    got = op12_whitening(spark, as_tables(embeddings=frame(spark, data))).collect()
    agree(got, [(i, v) for i, v in enumerate(data.astype(float))])


def test_edge_rows(spark, as_tables):
    data = vectors(300, 34, seed=5)
    extra = [(1000, None, 0), (1001, [None] + [0.0] * 33, 0), (1002, [float("nan")] * 34, 0), (1003, [float("-inf")] * 34, 0),
             (1004, [], 0), (1005, [1.0] * 12, 0), (1006, [float(c) for c in data[0]], 0), (1006, [float(c) for c in data[0]], 0),
             (None, [float(c) for c in data[1]], 0)]
    docs = frame(spark, data).unionByName(spark.createDataFrame(extra, DDL)).withColumns({"id": F.lit(1), "x": F.lit("y"), "component": F.lit(2)})
    got = op12_whitening(spark, as_tables(embeddings=docs)).collect()
    ids = [r["vec_id"] for r in got]
    assert not set(ids) & {1000, 1001, 1002, 1003, 1004, 1005} and ids.count(1006) == 32 and ids.count(None) == 16
    assert {r["n"] for r in got} == {300}
    kept = [(i, v) for i, v in enumerate(data.astype(float))]
    agree([r for r in got if r["vec_id"] is not None and r["vec_id"] < 1000], kept)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]])
def test_nothing_to_whiten(spark, as_tables, rows):
    got = op12_whitening(spark, as_tables(embeddings=spark.createDataFrame(rows, DDL)))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components_and_low_rank(spark, as_tables):
    few = vectors(200, 5, seed=2)
    agree(op12_whitening(spark, as_tables(embeddings=frame(spark, few))).collect(), [(i, v) for i, v in enumerate(few.astype(float))])
    rng = np.random.default_rng(8)      # 40 dimensions, 6 of them vary
    low = np.zeros((150, 40), np.float32)
    low[:, 3:9] = rng.integers(-200, 200, (150, 6)) / 64
    got = op12_whitening(spark, as_tables(embeddings=frame(spark, low))).collect()
    agree(got, [(i, v) for i, v in enumerate(low.astype(float))])


class InMemory(W.Covariance):
    """The same iteration over a matrix at hand."""

    def __init__(self, v):
        self.v, self.dims, self.passes, self.trace = v, len(v), 0, float(np.trace(v))

    def times(self, q):
        self.passes += 1
        return self.v @ q


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 120), np.geomspace(1e-8, 1, 200), np.r_[np.full(100, 1.0), np.full(4, 1.01)],
    np.r_[np.zeros(80), np.arange(1, 10)], np.r_[np.full(60, 5.0)], 1 + 1e-4 * np.arange(90.0)])
def test_iteration_finds_the_largest(values):
    rng = np.random.default_rng(0)
    turn, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    v = InMemory((turn * values) @ turn.T)
    found, vec = W.eigenpairs(v)
    truth = np.sort(values)[::-1][:16]
    assert np.allclose(found, truth, rtol=1e-9, atol=1e-12 * truth[0])
    assert np.allclose(vec.T @ vec, np.eye(16), atol=1e-10)
    assert np.linalg.norm(v.v @ vec - vec * found) <= 1e-10 * truth[0]


def test_huge_entries_and_deviations_beyond_a_long(spark, as_tables):
    data = [(i, [float(c) for c in row], 0) for i, row in enumerate(vectors(50, 4, seed=3) * 1e9)] + [(99, [3e38, 0.0, 0.0, 0.0], 0)]
    got = op12_whitening(spark, as_tables(embeddings=spark.createDataFrame(data, DDL))).collect()
    assert {r["deviation"] for r in got if r["vec_id"] == 99} == {None} and len(got) % 51 == 0
