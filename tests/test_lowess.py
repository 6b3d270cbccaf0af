"""Distributed LOWESS against a plain loop over sorted points."""

import numpy as np
import pytest

from statloom.operators.lowess import lowess


def lowess_loop(x, y, frac=2 / 3, iterations=3):
    order = np.lexsort((y, x))
    xs, ys = x[order], y[order]
    n = len(xs)
    k = int(frac * n + 1e-10)
    r = np.ones(n)
    fit = np.empty(n)
    for it in range(iterations + 1):
        left = 0
        for i in range(n):
            while left + k < n and xs[i] > (xs[left] + xs[left + k]) / 2:
                left += 1
            right = left + k
            h = max(xs[i] - xs[left], xs[right - 1] - xs[i])
            h = h if h > 0 else 1.0  # all points of the window share x_i
            d = np.abs(xs[left:right] - xs[i]) / h
            w = (1 - d ** 3) ** 3 * r[left:right]
            tot = w.sum()
            if tot <= 0:
                fit[i] = ys[i]
                continue
            w = w / tot
            xw = xs[left:right]
            xm = (w * xw).sum()
            ym = (w * ys[left:right]).sum()
            var = (w * (xw - xm) ** 2).sum()
            if var <= 1e-12 * h * h:
                fit[i] = ym
            else:
                fit[i] = ym + (xs[i] - xm) * (w * (xw - xm) * ys[left:right]).sum() / var
        if it == iterations:
            break
        e = ys - fit
        s = np.median(np.abs(e))
        if s <= 0:
            continue
        u = e / (6 * s)
        r = np.where(np.abs(u) < 1, (1 - u ** 2) ** 2, 0.0)
    return xs, ys, fit


def run(spark, x, y, **kw):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = sorted((r.x, r.y, r.trend) for r in lowess(df, "x", "y", **kw).collect())
    xs, ys, fit = lowess_loop(np.asarray(x, float), np.asarray(y, float), **kw)
    want = sorted(zip(xs, ys, fit))
    return got, want


def test_straight_line_is_returned(spark):
    x = np.arange(20.0)
    got, _ = run(spark, x, 3 * x + 2)
    assert [g[2] for g in got] == pytest.approx([3 * a + 2 for a in x], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("seed,n,frac,iters", [(1, 37, 2 / 3, 3), (2, 64, 0.3, 1), (3, 25, 0.5, 0)])
def test_matches_loop(spark, seed, n, frac, iters):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 40, n), 1)  # ties on purpose
    y = 20000 - 150 * x + rng.normal(0, 800, n)
    y[3] += 20000  # an outlier for the robustness passes
    got, want = run(spark, x, y, frac=frac, iterations=iters)
    assert len(got) == len(want)
    for (gx, gy, gf), (wx, wy, wf) in zip(got, want):
        assert gx == wx and gy == pytest.approx(wy, rel=1e-12, abs=1e-9)
        assert gf == pytest.approx(wf, rel=1e-8, abs=1e-6)


def test_nulls_dropped_and_outlier_damped(spark):
    x = [float(a) for a in range(15)] + [None]
    y = [2.0 * a for a in range(15)] + [5.0]
    y[7] = 500.0
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double")
    out = {r.x: r.trend for r in lowess(df, "x", "y").collect()}
    assert len(out) == 15
    assert out[7.0] == pytest.approx(14.0, abs=1.0)


def assert_close(got, want):
    assert len(got) == len(want)
    for (gx, gy, gf), (wx, wy, wf) in zip(got, want):
        assert gx == wx and gy == pytest.approx(wy, rel=1e-12, abs=1e-9)
        assert gf == pytest.approx(wf, rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("iters", [0, 1])
def test_isolated_points_far_from_the_rest(spark, iters):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.uniform(0, 1, 57), [999.0, 1000.0, 1001.0]])
    y = np.concatenate([rng.normal(0, 1, 57), [1700.0, 1750.0, 1790.0]])
    got, want = run(spark, x, y, iterations=iters)
    assert_close(got, want)


@pytest.mark.parametrize("frac", [0.05, 0.4, 2 / 3, 1.0])
def test_many_blocks(spark, monkeypatch, frac):
    import statloom.operators.lowess as lw

    monkeypatch.setattr(lw, "BLOCK", 8)  # windows then span whole blocks and tree nodes
    rng = np.random.default_rng(5)
    x = np.concatenate([np.round(rng.uniform(0, 10, 90), 1), rng.lognormal(3, 2, 40)])
    y = 3 * x + rng.normal(0, 1, len(x))
    got, want = run(spark, x, y, frac=frac, iterations=2)
    assert_close(got, want)


def test_all_x_tied_over_several_blocks(spark, monkeypatch):
    import statloom.operators.lowess as lw

    monkeypatch.setattr(lw, "BLOCK", 4)
    y = np.arange(30.0)
    got, want = run(spark, np.full(30, 2.0), y, iterations=1)
    assert_close(got, want)


def test_tree_cover_is_exact():
    import statloom.operators.lowess as lw

    n = 37
    edges = np.arange(n, dtype=float)
    m = np.zeros((n, lw.DEGREE))
    m[:, 0] = 2.0 ** np.arange(n)  # each block's weight is a bit of its own
    tree = lw.Tree(edges, edges + 0.5, m, m.copy())
    for a in range(n):
        for b in range(a, n):
            assert sum(z[2][0] for z in tree.cover(a, b)) == sum(2.0**i for i in range(a, b + 1))


def test_block_at_a_gap_reads_few_blocks(spark, monkeypatch):
    import statloom.operators.lowess as lw

    rng = np.random.default_rng(8)
    # two dense clusters and a few points between them: the window starts of one block run over a third of all points
    x = np.concatenate([rng.uniform(0, 1, 119), [20.0, 50.0, 51.0, 80.0], rng.uniform(100, 101, 117)])
    y = x + rng.normal(0, 1, len(x))
    k, size, xs = 160, 8, np.sort(x)
    lo = np.searchsorted((xs[: len(xs) - k] + xs[k:]) / 2, xs)
    whole = [lw._needed(b, lo[b * size : (b + 1) * size], size, k) for b in range(30)]
    assert max(map(len, whole)) > 15
    for b in range(30):
        own = lo[b * size : (b + 1) * size]
        parts = lw._parts(own, size)
        assert [i for p, e in parts for i in range(p, e)] == list(range(size))
        assert all(len(lw._needed(b, own[p:e], size, k)) <= 6 for p, e in parts)
    monkeypatch.setattr(lw, "BLOCK", size)
    got, want = run(spark, x, y, iterations=1)
    assert_close(got, want)
