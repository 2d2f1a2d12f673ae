"""Operator 12 against the dense eigenvectors of the exact covariance."""

import math

import numpy as np
import pytest

from tidewater.llm import whitening as W

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<double>, component int, whitened string, Y int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VEC)


def run(spark, rows, **kw):
    y = W.scaled(frame(spark, rows), "vec_id", "embedding")
    return W.digest(y, W.fit(y, **kw))


def brute(rows, wanted=32):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    z = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    return n, dev, values, (z @ axes) / np.sqrt(values), float(np.trace(z.T @ z / n))


def check(out, rows, wanted=32, tol=1e-8):
    n, dev, values, white, trace = brute(rows, wanted)
    got = sorted(out.collect(), key=lambda r: (r.component, r.vec_id))
    assert len(got) == len(rows) * len(values)
    table = np.array([r.whitened for r in got]).reshape(-1, len(rows)).T
    order = np.argsort([r[0] for r in rows], kind="stable")
    sign = np.sign((table * white[order]).sum(axis=0))
    assert np.abs(table * sign - white[order]).max() < tol
    assert [r.deviation for r in got[:len(rows)]] == [dev[i] for i in order]
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, len(values) + 1))
    assert np.allclose([r.explained for r in got[::len(rows)]], values / trace, rtol=1e-9)
    assert all(r.identity_error < 1e-8 for r in got)


def test_query_against_dense_eigenvectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(W.op12_embedding_whitening(spark, SF), rows)


def test_more_dimensions_than_the_block(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 90)) * np.linspace(3, 0.2, 90) + 5
    check(run(spark, [(i, r.tolist()) for i, r in enumerate(x)], components=6, guard=4), [(i, r.tolist()) for i, r in enumerate(x)], 6)


def test_filter_finds_close_and_hidden_values():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    spectrum = np.concatenate(([1e6, 1e3, 1.02, 1.01, 1.0], np.linspace(0.97, 0, 115)))
    v = (turn * spectrum) @ turn.T
    passes = []
    values, axes = W.eigenpairs(lambda q: passes.append(q) or v @ q, 120, 5, guard=8)
    assert np.allclose(values, spectrum[:5], rtol=1e-9)
    assert np.abs(np.abs((turn[:, :5] * axes).sum(axis=0)) - 1).max() < 1e-10
    assert all(q.shape[1] <= 21 for q in passes)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(3, [0.1, -0.5, 2.0]), (1, [0.7, 0.2, -1.0]), (1, [0.7, 0.2, -1.0]), (2, [-0.3, 0.9, 0.4]), (9, [1.5, 0.0, 0.25])]
    bad = [(4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 0.0, 0.0]), (8, [0.0, -inf, 0.0]), (10, [1e300, 0.0, 0.0]), (11, [1.0, 2.0])]
    check(run(spark, good + bad), good)


def test_null_ids_stay(spark):
    out = run(spark, [(None, [0.0, 1.0]), (None, [1.0, 3.0]), (1, [2.0, 0.0])]).collect()
    assert sorted(str(r.vec_id) for r in out) == ["1", "1", "None", "None", "None", "None"]


def test_dimensions_without_variance_are_left_out(spark):
    out = run(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]).collect()
    assert {r.component for r in out} == {1} and len(out) == 9
    assert abs(sum(r.whitened**2 for r in out) / 9 - 1) < 1e-9
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**40), 3.0]), (3, [5.0, 2.0**30])]
    got = {r.vec_id: r.deviation for r in run(spark, rows).collect()}
    assert got == {1: None, 2: None, 3: None}
    rows = [(1, [2.0**20, 1.0]), (2, [-(2.0**20), 3.0]), (3, [5.0, 2.0**10])]
    assert {r.vec_id: r.deviation for r in run(spark, rows).collect()} == dict(zip((1, 2, 3), brute(rows)[1]))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])]])
def test_nothing_to_whiten(spark, rows):
    assert run(spark, rows).collect() == []
