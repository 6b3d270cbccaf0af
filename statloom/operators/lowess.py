"""Exact LOWESS trend (local linear regression, tricube weights, bisquare
robustness passes) as Spark jobs, with no all-pairs step.

Definition (the usual one): with points sorted by x and k = floor(frac * n),
each point i has a window of k consecutive points (its k nearest in x, chosen
by sliding the window right while x_i is past the midpoint of the window's
left end and the first point after it); h_i is the larger distance to the
window's ends; weights are w_j = r_j (1 - |x_j - x_i|^3 / h_i^3)^3 with
robustness weights r_j (all 1 in the first pass); the fit at x_i is the
weighted least-squares line evaluated at x_i. Each robustness pass sets
r_j = B(e_j / (6 median|e|)) with bisquare B(u) = (1 - u^2)^2 for |u| < 1,
else 0, from the residuals e of the previous fit.

How it runs without comparing every pair of points:

1. ``global_rank`` numbers the points by x; blocks of consecutive points are
   rows of arrays. There are at most ``MAX_BLOCKS`` blocks, so one row per
   block is a bounded table.
2. The window start of point i is the number of midpoints
   m_l = (x_l + x_{l+k}) / 2 below x_i. Midpoints are blocks too; a block of
   points meets the few midpoint blocks its range of x overlaps.
3. Each pass takes one row of moments per block to the driver (power sums of
   (x - c) and (x - c) y around the block's centre, weighted by r; bounded),
   adds them up a binary tree of blocks, and broadcasts the tree.
4. A block is split where its window starts leave two neighbouring blocks (at
   a gap in x they jump far), so that a part reads six blocks at most. A part
   shares its windows' interior: O(log n) tree nodes cover the whole blocks
   inside all its windows. The points at the windows' ends and around the part
   itself are read as points, from the blocks concerned.
5. Each node or point gives weight, means and centred second moments, which
   combine to the weighted line.

Numerical form: inside a node the tricube weight is expanded around the
node's centre, in u = |x_c - x_i| / h near the point and in t = 1 - u, where
the weight is t^3 (3 - 3 t + t^2)^3, near the window's end. Nodes combine as
(weight, mean, centred moments), so nothing is lost when most of a window lies
at its far end.

Edge cases, defined here: points tied in x are ordered by y; a window whose
points all share x_i is weighted uniformly; a window with zero x-spread gives
the weighted mean of y; zero total weight keeps y_i; a zero median residual
leaves the robustness weights unchanged.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.ranking import global_rank

DEGREE = 12  # moments 0..11: tricube (degree 9) times up to x^2
#: Points of a block, while that makes at most MAX_BLOCKS blocks.
BLOCK = 512
MAX_BLOCKS = 65_536
#: Values around the median that are ranked exactly, as a share of all.
BRACKET = 0.002
_BINOM = np.array([[comb(e, t) if t <= e else 0 for t in range(DEGREE)] for e in range(DEGREE)], dtype=float)
# tricube as a polynomial in u, and in t = 1 - u (ascending coefficients)
_IN_U = np.array([1.0, 0, 0, -3, 0, 0, 3, 0, 0, -1])
_IN_T = np.array([0.0, 0, 0, 27, -81, 108, -81, 36, -9, 1])


def _taylor(u: np.ndarray) -> np.ndarray:
    """Coefficients [..., m] of the tricube weight around u in powers of (u' - u)."""
    out = np.empty((*u.shape, 10))
    for near, coef, at, sign in ((u < 0.5, _IN_U, u, 1.0), (u >= 0.5, _IN_T, 1.0 - u, -1.0)):
        x = at[near]
        for m in range(10):
            value = np.zeros_like(x)
            for e in range(9, m - 1, -1):
                value = value * x + coef[e] * comb(e, m)
            out[..., m][near] = value * sign**m
    return out


def _moments(x: np.ndarray, y: np.ndarray, r: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(centre, half width, power sums of w, of w y) with w = (x - centre) / half width."""
    c, rho = (x[0] + x[-1]) / 2, (x[-1] - x[0]) / 2
    w = (x - c) / rho if rho > 0 else np.zeros_like(x)
    powers = w[None, :] ** np.arange(DEGREE)[:, None]
    return c, rho, powers @ r, powers @ (r * y)


class Tree:
    """Binary tree over blocks: for each level the nodes' centre, half width and moments."""

    def __init__(self, first: np.ndarray, last: np.ndarray, m: np.ndarray, my: np.ndarray):
        self.levels = [(((first + last) / 2), (last - first) / 2, m, my)]
        while len(first) > 1:
            left, right = np.arange(0, len(first), 2), np.minimum(np.arange(0, len(first), 2) + 1, len(first) - 1)
            c, rho, m, my = self.levels[-1]
            first, last = first[left], last[right]
            pc, prho = (first + last) / 2, (last - first) / 2
            pm, pmy = self._shift(c[left], rho[left], m[left], my[left], pc, prho)
            both = left != right
            other = self._shift(c[right], rho[right], m[right], my[right], pc, prho)
            pm[both] += other[0][both]
            pmy[both] += other[1][both]
            self.levels.append((pc, prho, pm, pmy))

    @staticmethod
    def _shift(c, rho, m, my, pc, prho):
        """Moments of children around their parents' centres."""
        scale = np.where(prho > 0, prho, 1.0)
        a, b = rho / scale, (c - pc) / scale
        k = np.arange(DEGREE)
        ap, bp = a[:, None] ** k, b[:, None] ** k
        out, out_y = np.zeros_like(m), np.zeros_like(my)
        for e in range(DEGREE):
            coef = _BINOM[e, : e + 1] * ap[:, : e + 1] * bp[:, e::-1][:, : e + 1]
            out[:, e] = (coef * m[:, : e + 1]).sum(axis=1)
            out_y[:, e] = (coef * my[:, : e + 1]).sum(axis=1)
        return out, out_y

    def cover(self, a: int, b: int) -> list[tuple[float, float, np.ndarray, np.ndarray]]:
        """Nodes that cover the blocks a..b."""
        out, level = [], 0
        while a <= b:
            if a % 2 or a == b:
                out.append((level, a))
                a += 1
            if a <= b and (b % 2 == 0):
                out.append((level, b))
                b -= 1
            a, b, level = a // 2, b // 2 if b % 2 else (b - 1) // 2, level + 1
        return [tuple(x[k] for x in self.levels[lev]) for lev, k in out]


def _line(x: np.ndarray, h: np.ndarray, nodes, side, px, py, pw) -> tuple[np.ndarray, np.ndarray]:
    """(fit, total weight) at points x from nodes (with the side they lie on) and weighted points."""
    s0, d, y0, xx, xy = [pw], [px[None, :] - x[:, None]], [np.broadcast_to(py, pw.shape)], [np.zeros_like(pw)], [np.zeros_like(pw)]
    if nodes:
        c, rho = (np.array([n[i] for n in nodes]) for i in (0, 1))
        m, my = (np.stack([n[i] for n in nodes]) for i in (2, 3))
        s = np.array(side, float)
        gap = c[None, :] - x[:, None]
        u = np.clip(s * gap / h[:, None], 0.0, 1.0)
        a = _taylor(u) * ((s * rho)[None, :] / h[:, None])[..., None] ** np.arange(10)
        w0, w1, w2, t0, t1 = (np.einsum("ijm,jm->ij", a, z[:, q : q + 10]) for z, q in ((m, 0), (m, 1), (m, 2), (my, 0), (my, 1)))
        ok = w0 > 0
        safe = np.where(ok, w0, 1.0)
        s0.append(np.where(ok, w0, 0.0))
        d.append(gap + rho * w1 / safe)
        y0.append(t0 / safe)
        xx.append(np.where(ok, rho * rho * np.maximum(w2 - w1 * w1 / safe, 0.0), 0.0))
        xy.append(np.where(ok, rho * (t1 - w1 * t0 / safe), 0.0))
    s0, d, y0, xx, xy = (np.concatenate(z, axis=1) for z in (s0, d, y0, xx, xy))
    total = s0.sum(axis=1)
    some = np.where(total > 0, total, 1.0)
    dm, ym = (s0 * d).sum(axis=1) / some, (s0 * y0).sum(axis=1) / some
    dd = d - dm[:, None]
    var = (xx + s0 * dd * dd).sum(axis=1) / some
    cov = (xy + s0 * dd * (y0 - ym[:, None])).sum(axis=1) / some
    steep = var > 1e-12 * h * h
    return np.where(steep, ym - dm * cov / np.where(steep, var, 1.0), ym), total


def _fit_block(q: int, at: int, lo: np.ndarray, blocks: dict[int, tuple], tree: Tree, size: int, k: int) -> np.ndarray:
    """Fits at the points of block q from its point ``at`` on; ``blocks`` holds (x, y, r) of the blocks that are read as points."""
    x, y = (blocks[q][i][at : at + len(lo)] for i in range(2))
    hi = lo + k - 1
    point = sorted(blocks)
    px, py, pr = (np.concatenate([blocks[b][i] for b in point]) for i in range(3))
    pos = np.concatenate([b * size + np.arange(len(blocks[b][0])) for b in point])
    # window ends are among the points read: the distance to the farther one
    ends = np.searchsorted(pos, np.stack([lo, hi]))
    radius = np.maximum(x - px[ends[0]], px[ends[1]] - x)
    h = np.where(radius > 0, radius, 1.0)
    inside = (pos >= lo[:, None]) & (pos <= hi[:, None])
    u = np.abs(px[None, :] - x[:, None]) / h[:, None]
    t = np.clip(1.0 - u, 0.0, 1.0)
    w = np.where(inside, (t * (3 - 3 * t + t * t)) ** 3, 0.0) * pr
    first, last = lo.max() // size + 1, hi.min() // size - 1
    nodes, side = [], []
    for a, b, s in ((first, min(last, q - 1), -1.0), (max(first, q + 1), last, 1.0)):
        found = tree.cover(a, b) if a <= b else []
        nodes += found
        side += [s] * len(found)
    fit, total = _line(x, h, nodes, side, px, py, w)
    return np.where(total > 0, fit, y)


def _fitter(tree, size: int, k: int):
    def fit(key, left, right):
        q, at = key
        held = {r.b: (np.asarray(r.xs), np.asarray(r.ys), np.asarray(r.rs)) for r in right.itertuples()}
        return pd.DataFrame({"b": [q], "at": [at], "fits": [_fit_block(q, at, np.asarray(left["lo"].iloc[0]), held, tree.value, size, k)]})

    return fit


def _parts(lo: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(first, end) of the runs of a block's points whose windows start in the same two blocks."""
    block, out, first = lo // size, [], 0
    while first < len(lo):
        end = int(np.searchsorted(block, block[first] + 1, "right"))
        out.append((first, end))
        first = end
    return out


def _needed(q: int, lo: np.ndarray, size: int, k: int) -> list[int]:
    """Blocks that a part of block q reads as points: those of its window ends and itself (six at most)."""
    hi = lo + k - 1
    out = set(range(lo.min() // size, lo.max() // size + 1)) | set(range(hi.min() // size, hi.max() // size + 1)) | {q}
    return sorted(out)


def _median(blocks: DataFrame, column: str, n: int) -> float:
    """Exact median of the absolute values of an array column."""
    values = blocks.select(F.explode(column).alias("v")).select(F.abs("v").alias("v"))
    ranks = [(n - 1) // 2, n // 2]
    if n <= 10_000:  # the sketch holds that many values exactly
        return float(np.mean(values.agg(F.percentile_approx("v", [(r + 0.5) / n for r in ranks], 1_000_000)).first()[0]))
    low, high = values.agg(F.percentile_approx("v", [0.5 - BRACKET, 0.5 + BRACKET], 10_000)).first()[0]
    below = values.filter(F.col("v") < low).count()
    middle = values.filter(F.col("v").between(low, high)).orderBy("v").offset(ranks[0] - below).limit(ranks[1] - ranks[0] + 1)
    return float(np.mean([r.v for r in middle.collect()]))


def lowess(
    df: DataFrame,
    x: str,
    y: str,
    frac: float = 2.0 / 3.0,
    iterations: int = 3,
    out: str = "trend",
) -> DataFrame:
    """Rows (x, y, out) for every point with both values present."""
    spark = df.sparkSession
    pts = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    # A row id breaks ties, so even one point repeated a million times spreads
    # over many range partitions; ties in x are ordered by y, then by that id.
    pts = pts.withColumn("_u", F.monotonically_increasing_id())
    pts = global_rank(pts, ["x", "y", "_u"], "pos").drop("_u")  # frozen: built on a checkpoint
    n, mean = pts.agg(F.count(F.lit(1)), F.avg("y")).first()
    if n == 0:
        return pts.select(F.col("x").alias(x), F.col("y").alias(y), F.lit(None).cast("double").alias(out))
    k = min(max(int(frac * n + 1e-10), 1), n)
    size = max(BLOCK, -(-n // MAX_BLOCKS))

    # blocks of consecutive points; y is centred, which keeps sums small
    row = F.sort_array(F.collect_list(F.struct("pos", "x", (F.col("y") - F.lit(mean)).alias("y"))))
    blocks = pts.withColumn("b", (F.col("pos") / size).cast("long")).groupBy("b").agg(row.alias("p"))
    blocks = blocks.select("b", F.col("p.x").alias("xs"), F.col("p.y").alias("ys")).checkpoint(eager=True)

    # midpoints (x_l + x_{l+k}) / 2 of each block of l < n - k, and where the blocks' values lie
    shift, rest = k // size, k % size
    nxt = blocks.select((F.col("b") - shift).alias("b"), F.col("xs").alias("x1"))
    after = blocks.select((F.col("b") - shift - 1).alias("b"), F.col("xs").alias("x2"))
    mids = blocks.select("b", "xs").join(nxt, "b").join(after, "b", "left")

    def midpoints(batches):
        for pdf in batches:
            found = []
            for r in pdf.itertuples():
                far = np.concatenate([r.x1, r.x2 if r.x2 is not None else []])[rest : rest + len(r.xs)]
                found.append((np.asarray(r.xs)[: len(far)] + far) / 2)
            yield pd.DataFrame({"b": pdf["b"], "mids": found})

    mids = mids.mapInPandas(midpoints, "b long, mids array<double>").filter(F.size("mids") > 0).checkpoint(eager=True)
    ends = mids.select("b", F.element_at("mids", -1).alias("last")).collect()  # one row per block
    last_mid = np.array([r.last for r in sorted(ends, key=lambda r: r.b)])

    # window starts: the midpoint blocks that a block's range of x overlaps
    def meets(batches):
        for pdf in batches:
            rows = [(r.b, m) for r in pdf.itertuples() for m in range(
                int(np.searchsorted(last_mid, r.xs[0])), min(int(np.searchsorted(last_mid, r.xs[-1])), len(last_mid) - 1) + 1)]
            yield pd.DataFrame(rows, columns=["b", "m"]).astype("int64")

    met = blocks.select("b", "xs").mapInPandas(meets, "b long, m long").join(mids.select(F.col("b").alias("m"), "mids"), "m")

    def starts(key, left, right):
        (b,) = key
        if left.empty:
            return pd.DataFrame({"b": [], "at": [], "lo": []})
        xs = np.asarray(left["xs"].iloc[0])
        lo = np.searchsorted(last_mid, xs[:1]).astype(np.int64) * size * np.ones(len(xs), np.int64)
        for r in right.sort_values("m").itertuples():
            lo += np.searchsorted(r.mids, xs)
        full = n - k
        lo = np.minimum(lo, full)
        parts = _parts(lo, size)
        return pd.DataFrame({"b": [b] * len(parts), "at": [p for p, _ in parts], "lo": [lo[p:e] for p, e in parts]})

    windows = blocks.select("b", "xs").groupBy("b").cogroup(met.groupBy("b")).applyInPandas(starts, "b long, at long, lo array<long>")
    windows = windows.checkpoint(eager=True)

    def wants(batches):
        for pdf in batches:
            rows = [(r.b, r.at, need) for r in pdf.itertuples() for need in _needed(r.b, np.asarray(r.lo), size, k)]
            yield pd.DataFrame(rows, columns=["q", "at", "b"]).astype("int64")

    wanted = windows.mapInPandas(wants, "q long, at long, b long")

    def leaf(batches):
        for pdf in batches:
            made = [_moments(np.asarray(r.xs), np.asarray(r.ys), np.asarray(r.rs)) for r in pdf.itertuples()]
            yield pd.DataFrame({"b": pdf["b"], "first": [r[0] for r in pdf["xs"]], "last": [r[-1] for r in pdf["xs"]],
                                "m": [z[2] for z in made], "my": [z[3] for z in made]})

    state = blocks.withColumn("rs", F.array_repeat(F.lit(1.0), F.size("xs")))
    for it in range(iterations + 1):
        leaves = state.mapInPandas(leaf, "b long, first double, last double, m array<double>, my array<double>").collect()  # one row per block
        leaves.sort(key=lambda r: r.b)
        tree = spark.sparkContext.broadcast(
            Tree(*(np.array([r[c] for r in leaves], dtype=float) for c in ("first", "last", "m", "my")))
        )

        read = wanted.join(state, "b").select("q", "at", "b", "xs", "ys", "rs")
        fitted = windows.groupBy("b", "at").cogroup(read.groupBy("q", "at")).applyInPandas(_fitter(tree, size, k), "b long, at long, fits array<double>")
        fitted = fitted.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("at", "fits"))).alias("parts")).select("b", F.flatten("parts.fits").alias("fits"))
        fitted = blocks.join(fitted, "b").withColumn("es", F.zip_with("ys", "fits", lambda a, b: a - b)).checkpoint(eager=True)
        if it == iterations:
            break
        med = _median(fitted, "es", n)
        if med <= 0.0:  # weights stay as they are, so further passes give this same fit
            break
        scale = 6.0 * med
        weight = lambda e: F.when(F.abs(e) < scale, F.pow(1 - (e / scale) * (e / scale), F.lit(2.0))).otherwise(F.lit(0.0))
        state = fitted.select("b", "xs", "ys", F.transform("es", weight).alias("rs"))
    rows = fitted.select(F.explode(F.arrays_zip("xs", "ys", "fits")).alias("p"))
    return rows.select(F.col("p.xs").alias(x), (F.col("p.ys") + F.lit(mean)).alias(y), (F.col("p.fits") + F.lit(mean)).alias(out))
