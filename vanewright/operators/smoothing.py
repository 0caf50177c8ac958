"""Locally weighted regression (LOWESS) per unit.

The fit at a point depends on the points only through, for each distinct x, the
sum of weights and the weighted sum of y.  So the rows are aggregated to one row
per (unit, x) first - a unit's rows never meet in a task - and only that reduced
series is fitted.  A robust pass re-weights the rows by their residuals, which is
again an aggregation: medians by value counts, weights per row, sums per x.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.operators.quantiles import exact_quantiles
from vanewright.plans.lineage import cut
from vanewright.plans.ordered import running_sum
from vanewright.plans.sizing import SizePolicy, is_small, lookup_join, split_by_heat

MIN_POINTS = 5       # fixed value: shorter series are returned as they are
MIN_NEIGHBOURS = 2


#: Series with fewer neighbours a point are summed directly, one point after another.
DIRECT_NEIGHBOURS = 64
#: Blocks of moments in a neighbourhood, about.
PIECES = 8
#: A block this many times as wide as a neighbourhood has no useful moments for it.
WIDE_BLOCK = 2.0
POWERS = 12   # the kernel has degree 9, sums need two powers of x more
CHOOSE = np.array([[comb(q, m) for m in range(POWERS)] for q in range(POWERS)], float)
# The kernel (1 - |d|^3)^3 by powers of d, right and left of the point.
RIGHT, LEFT = ((0, 1.0), (3, -3.0), (6, 3.0), (9, -1.0)), ((0, 1.0), (3, 3.0), (6, 3.0), (9, 1.0))
INNER, OUTER = 0.001, 0.999   # fixed values: nearer points weigh 1, farther ones 0


def reaches(x: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Distance of the k-th nearest point from each distinct x (sorted), ``n`` points at each.

    The k nearest lie in a run of consecutive x.  Over the runs by their start, the left side
    of the reach shrinks and the right side grows, so the best start is found by bisection, for all points at once.
    """
    m = len(x)
    before = np.concatenate([[0], np.cumsum(n)])
    ends = np.searchsorted(before, before[:-1] + k, side="left")   # exclusive, of the run from each start
    firsts = np.maximum(np.searchsorted(before, before[1:] - k, side="right") - 1, 0)
    last = int(np.searchsorted(ends, m, side="right")) - 1         # starts after it have too few points
    i = np.arange(m)
    low, high = firsts.copy(), np.minimum(i, last)
    sides = lambda s: (x - x[s], x[np.minimum(np.maximum(ends[s], i + 1), m) - 1] - x)
    held = firsts <= high
    lo, hi = low.copy(), np.maximum(high, low)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        left, right = sides(mid)
        open_, up = lo < hi, right >= left
        lo, hi = np.where(open_ & ~up, mid + 1, lo), np.where(open_ & up, mid, hi)
    best = np.minimum(np.maximum(*sides(lo)), np.maximum(*sides(np.maximum(lo - 1, low))))
    return np.where(held, best, np.maximum(x - x[0], x[-1] - x))


def _zones(x: np.ndarray, reach: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Index ranges of the weights: from, core from, core to, to."""
    return (np.searchsorted(x, at - OUTER * reach, "right"), np.searchsorted(x, at - INNER * reach, "left"),
            np.searchsorted(x, at + INNER * reach, "right"), np.searchsorted(x, at + OUTER * reach, "left"))


def _line(s0: np.ndarray, s1: np.ndarray, s2: np.ndarray, t0: np.ndarray, t1: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Value at 0 of the weighted line through points, from sums of w, w u, w u^2, w y, w y u, where u counts in units of ``unit``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_u, mean_y = s1 / s0, t0 / s0
        spread = s2 - s1 * mean_u
        slope = np.where(spread > 1e-12 * np.maximum(1.0 / np.maximum(unit * unit, 1e-300), s0), (t1 - t0 * mean_u) / spread, 0.0)
        return np.where(s0 > 0, mean_y - slope * mean_u, np.nan)


def _direct(x: np.ndarray, w: np.ndarray, wy: np.ndarray, reach: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), 5))
    a, c0, c1, b = _zones(x, reach[points], x[points])
    for j, i in enumerate(points):
        unit = reach[i] or 1.0
        lo, hi = min(a[j], c0[j]), max(b[j], c1[j])
        u = (x[lo:hi] - x[i]) / unit
        kernel = np.clip(1 - np.abs(u) ** 3, 0, 1) ** 3
        kernel[c0[j] - lo:c1[j] - lo] = 1.0
        kw, ky = kernel * w[lo:hi], kernel * wy[lo:hi]
        out[j] = kw.sum(), (kw * u).sum(), (kw * u * u).sum(), ky.sum(), (ky * u).sum()
    return out


class _Moments:
    """Prefix moments of a series inside blocks of consecutive points, each in the block's own coordinate in [-1, 1]."""

    def __init__(self, x: np.ndarray, values: list[np.ndarray], size: int) -> None:
        self.size, m = size, len(x)
        blocks = -(-m // size)
        edge = np.minimum(np.arange(blocks + 1) * size, m)
        low, high = x[edge[:-1]], x[edge[1:] - 1]
        self.centre, self.half = (low + high) / 2, np.where(high > low, (high - low) / 2, 1.0)
        block = np.arange(m) // size
        power = ((x - self.centre[block]) / self.half[block])[:, None] ** np.arange(POWERS)
        self.sums = []
        for v in values:
            padded = np.zeros((blocks * size, POWERS))
            padded[:m] = power * v[:, None]
            rows = np.zeros((blocks, size + 1, POWERS))
            np.cumsum(padded.reshape(blocks, size, POWERS), axis=1, out=rows[:, 1:])
            self.sums.append(rows)

    def between(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, unit: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Sums of v u^q, u = (x - at) / unit, over the points from a to b, for each series; and whether a block that
        a range only cuts is too wide for it."""
        out = [np.zeros((len(a), POWERS)) for _ in self.sums]
        wide = np.zeros(len(a), bool)
        first, final = a // self.size, np.maximum(b - 1, a) // self.size
        for step in range(int((final - first).max(initial=0)) + 1):
            block = first + step
            rows = np.flatnonzero((block <= final) & (a < b))
            if not len(rows):
                continue
            k = block[rows]
            lo, hi = np.maximum(a[rows] - k * self.size, 0), np.minimum(b[rows] - k * self.size, self.size)
            alpha, beta = (self.centre[k] - at[rows]) / unit[rows], self.half[k] / unit[rows]
            wide[rows] |= (beta > WIDE_BLOCK) & (hi - lo > 0)
            up = alpha[:, None] ** np.arange(POWERS)
            scale = beta[:, None] ** np.arange(POWERS)
            for sums, total in zip(self.sums, out):
                own = (sums[k, hi] - sums[k, lo]) * scale
                for q in range(POWERS):
                    total[rows, q] += (own[:, :q + 1] * up[:, q::-1] * CHOOSE[q, :q + 1]).sum(axis=1)
        return out, wide


def _by_moments(x: np.ndarray, w: np.ndarray, wy: np.ndarray, reach: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """As ``_direct``, in a number of steps a point that does not depend on how many neighbours it has."""
    moments = _Moments(x, [w, wy], max(8, k // PIECES))
    at, unit = x[points], np.where(reach[points] > 0, reach[points], 1.0)
    a, c0, c1, b = _zones(x, reach[points], at)
    out, direct = np.zeros((len(points), 5)), np.zeros(len(points), bool)
    for lo, hi, kernel in ((a, c0, LEFT), (c0, c1, ((0, 1.0),)), (c1, b, RIGHT)):
        (sw, sy), wide = moments.between(lo, np.maximum(lo, hi), at, unit)
        direct |= wide
        for q, c in kernel:
            for p in range(3):
                out[:, p] += c * sw[:, p + q]
            for p in range(2):
                out[:, 3 + p] += c * sy[:, p + q]
    if direct.any():  # gaps in x: such points are few or lie in short neighbourhoods
        out[direct] = _direct(x, w, wy, reach, points[direct])
    return out


def fit_series(x: np.ndarray, n: np.ndarray, w: np.ndarray, wy: np.ndarray, k: int,
               wanted: np.ndarray | None = None) -> np.ndarray:
    """Local linear fit at each distinct x (sorted), or at the wanted ones.

    ``n`` points lie at each x (they count as neighbours), with total robustness
    weight ``w`` and weighted sum ``wy``.  The tricube kernel is a polynomial on either side of a point, so
    its sums come from prefix moments of x, whatever the number of neighbours is.
    """
    x = np.asarray(x, float)
    fitted = np.full(len(x), np.nan)
    points = np.arange(len(x)) if wanted is None else np.flatnonzero(wanted)
    if len(points):
        reach = reaches(x, n, k)
        sums = _direct(x, w, wy, reach, points) if k <= DIRECT_NEIGHBOURS else _by_moments(x, w, wy, reach, points, k)
        fitted[points] = _line(*sums.T, reach[points])
    return fitted


def _neighbours(total: int, frac: float) -> int:
    return min(total, max(MIN_NEIGHBOURS, int(frac * total + 1e-10)))


def _fit(sums: DataFrame, group: Sequence[str], frac: float, small: bool) -> DataFrame:
    """Fit every reduced series.

    A series longer than a task should hold is cut into blocks of consecutive
    points, each at least as wide as the neighbourhood; a block is fitted with
    the blocks beside it at hand, which hold all its neighbours.
    """
    keys = list(group)
    schema = sums.select(*keys, "__x").schema.add("__fit", "double").add("__total", "long")

    def fitted(pdf: pd.DataFrame, total: int, own: np.ndarray | None) -> pd.DataFrame:
        fit = fit_series(pdf["__x"].to_numpy(float), pdf["__n"].to_numpy(float),
                         pdf["__w"].to_numpy(float), pdf["__wy"].to_numpy(float),
                         _neighbours(total, frac), own)
        out = pdf[[*keys, "__x"]].assign(__fit=fit, __total=total)
        return out if own is None else out[own]

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return fitted(pdf.sort_values("__x"), int(pdf["__n"].sum()), None)

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__x")
        own = (pdf["__blk"] == pdf["__home"]).to_numpy()
        return fitted(pdf, int(pdf["__all"].iloc[0]), own)

    def plain(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys).applyInPandas(whole, schema)

    def hot(big: DataFrame, _: DataFrame) -> DataFrame:
        rows = SizePolicy.of(big.sparkSession).hot_rows
        placed = running_sum(big, keys, ["__x"], "__n", "__cum", "__all")
        width = F.greatest(F.lit(rows), F.ceil(F.col("__all") * frac), F.lit(MIN_NEIGHBOURS))
        own = F.floor((F.col("__cum") - 1) / width).cast("long")
        first = F.floor((F.col("__cum") - F.col("__n")) / width).cast("long")
        # A point reaches from the block of its first copy to that of its last.
        copies = placed.withColumns({"__blk": own, "__home": F.sequence(first - 1, own + 1)})
        spread = copies.withColumn("__home", F.explode("__home"))
        return spread.groupBy(*keys, "__home").applyInPandas(block, schema)

    return split_by_heat(sums, keys, plain, hot, small)


def lowess(df: DataFrame, x: str, y: str, frac: float = 0.02, group: Sequence[str] = ("unit",),
           iters: int = 3, name: str | None = None) -> DataFrame:
    """Add the smoothed ``y`` to every row (column ``<y>_smooth``).

    ``iters`` robust passes follow the first fit.  Groups with fewer than five
    points keep their values.  The number of neighbours is ``frac`` of the group's
    points, at least two.  A row without x or y (null or NaN) is no point: it has no
    weight, is no neighbour, and keeps its y.  A null group is a group.
    """
    keys = list(group)
    out_name = name or f"{y}_smooth"
    # Residuals have the rows of the input, so its size decides for all passes.
    small = is_small(df, SizePolicy.of(df.sparkSession).broadcast_bytes)
    rows = df.withColumns({"__x": F.col(x).cast("double"), "__y": F.col(y).cast("double")})
    rows = rows.withColumn("__ok", F.coalesce(~F.isnan("__x") & ~F.isnan("__y") & F.col("__x").isNotNull()
                                              & F.col("__y").isNotNull(), F.lit(False)))
    points = rows.where("__ok")
    weighted = points.withColumn("__u", F.lit(1.0))
    fit = None
    for step in range(iters + 1):
        sums = weighted.groupBy(*keys, "__x").agg(
            F.count(F.lit(1)).alias("__n"), F.sum("__u").alias("__w"),
            F.sum(F.col("__u") * F.col("__y")).alias("__wy"))
        fit = _fit(sums, keys, frac, small)
        # Fits and medians are small next to the rows: once on storage, a bounded
        # read of them decides on a broadcast, which spares shuffling the rows.
        if step < iters or not small:
            fit = cut(fit)
        if step < iters:
            resid = lookup_join(points, fit, [*keys, "__x"], probe=not small).withColumn(
                "__r", F.abs(F.col("__y") - F.coalesce("__fit", "__y")))
            medians = exact_quantiles(resid, ["__r"], {"__m": 0.5}, keys, small).drop("feature")
            scaled = lookup_join(resid, medians if small else cut(medians), keys, probe=not small)
            ratio = F.col("__r") / (F.col("__m") * 6)
            u = (F.when(F.col("__m") == 0, F.when(F.col("__r") == 0, 1.0).otherwise(0.0))
                  .when(ratio >= 0.999, 0.0).when(ratio <= 0.001, 1.0)
                  .otherwise(F.pow(1 - ratio * ratio, 2)))
            weighted = scaled.withColumn("__u", u)
    joined = lookup_join(rows, fit, [*keys, "__x"], "left", probe=not small)
    smooth = F.when(~F.col("__ok") | (F.col("__total") < MIN_POINTS), F.col("__y")).otherwise(
        F.coalesce(F.nanvl("__fit", "__y"), "__y"))
    return joined.select(*df.columns, smooth.alias(out_name))
