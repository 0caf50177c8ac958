"""Exact quantiles with linear interpolation, without sorting a group in a task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here equal values are first counted (partial aggregation, shuffled on the value,
so a repeated value or a single feature is no hot key); the running count over
the sorted values then tells which values hold the two ranks around a quantile.

In a large table without groups the ranks are selected by histograms: the values of a box, at first all, are
counted in bins by map-side aggregation, with the least and greatest value of each bin; the bin that
holds a wanted rank is the next box, until its values are few enough to be listed.  No value is shuffled before
that, and the driver sees at most ``BINS`` numbers a box.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.plans.ordered import running_sum
from vanewright.plans.sizing import SizePolicy, is_small, lookup_join

BINS = 4096
# Boxes of at most this many values are listed.
LISTED = 10_000


def _value(f: str) -> Column:
    c = F.col(f).cast("double")
    return F.when(~F.isnan(c), c)


def _pick(ranked: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """All quantiles from rows (value, n, first rank, last rank, total) in one pass."""
    aggs, needed = [], F.lit(False)
    for name, p in probs.items():
        spot = (F.col("total") - 1) * F.lit(p)
        low, high = F.floor(spot), F.ceil(spot)
        needed = needed | (F.col("lo") <= high) & (low <= F.col("hi"))
        at_low = F.max(F.when((F.col("lo") <= low) & (low <= F.col("hi")), F.col("value")))
        at_high = F.max(F.when((F.col("lo") <= high) & (high <= F.col("hi")), F.col("value")))
        share = F.max(spot - low)
        aggs.append((at_low + (at_high - at_low) * share).alias(name))
    return ranked.where(needed).groupBy(*keys).agg(*aggs)


def _in_one_buffer(df: DataFrame, features: Sequence[str], probs: Mapping[str, float],
                   by: Sequence[str]) -> DataFrame:
    """The built-in exact percentile; for inputs whose values fit a task."""
    points = F.array(*[F.lit(p) for p in probs.values()])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.percentile(_value(f), points).alias("q"))
                     for f in features])
    wide = (df.groupBy(*by) if by else df.groupBy()).agg(rows.alias("__rows"))
    return wide.select(*by, F.inline("__rows")).select(
        *by, "feature", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(probs)])


def _by_counts(df: DataFrame, features: Sequence[str], probs: Mapping[str, float],
               by: Sequence[str]) -> DataFrame:
    long = df.select(*by, *[_value(f).alias(f) for f in features]) \
             .unpivot(list(by), list(features), "feature", "value")
    keys = [*by, "feature"]
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sum(counts.where(F.col("value").isNotNull()), keys, ["value"], "n", "cum", "total")
    ranked = ranked.withColumns({"lo": F.col("cum") - F.col("n"), "hi": F.col("cum") - 1})
    picked = _pick(ranked, keys, probs)
    if not by:
        return _for_all(picked, features, probs)
    # Groups without values stay, with null quantiles.
    return lookup_join(counts.select(*keys).distinct(), picked, keys, "left")


def _for_all(picked: DataFrame, features: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """A row for every feature, also for those without values."""
    every = picked.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return lookup_join(every, picked.select("feature", *probs), ["feature"], "left")


@dataclass
class _Box:
    """Values of a feature from ``low`` to ``high``, both taken: ``n`` of them, after ``below`` smaller ones."""
    feature: str
    low: float
    high: float
    below: int
    n: int
    ranks: set[int]

    def known(self) -> dict[int, float]:
        """Ranks that need no further look."""
        ends = {self.below: self.low, self.below + self.n - 1: self.high}
        return {r: self.low if self.low == self.high else ends[r] for r in self.ranks if self.low == self.high or r in ends}

    def bin(self, value: Column) -> Column:
        """Monotone in the value, whatever rounding does; halves, as the width of all doubles is none."""
        low, high = max(self.low, -sys.float_info.max), min(self.high, sys.float_info.max)
        width = high / 2 - low / 2
        if width == 0:
            inner = (value > F.lit(low)).cast("long")
        else:
            inner = F.floor((value / 2 - F.lit(low / 2)) / F.lit(width) * BINS).cast("long")
        return F.when(value < F.lit(low), -1).when(value > F.lit(high), BINS + 1).otherwise(inner)


def _by_histograms(df: DataFrame, features: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    one = df.agg(*[c for i, f in enumerate(features) for c in (
        F.count(_value(f)).alias(f"n{i}"), F.min(_value(f)).alias(f"a{i}"), F.max(_value(f)).alias(f"b{i}"))]).first()
    totals = {f: one[f"n{i}"] for i, f in enumerate(features)}
    spots = {(f, name): (n - 1) * p for f, n in totals.items() if n for name, p in probs.items()}
    boxes = [_Box(f, one[f"a{i}"], one[f"b{i}"], 0, totals[f],
                  {r for name in probs for r in (math.floor(spots[f, name]), math.ceil(spots[f, name]))})
             for i, f in enumerate(features) if totals[f]]
    found: dict[tuple[str, int], float] = {}
    while boxes:
        for box in boxes:
            known = box.known()
            found |= {(box.feature, r): x for r, x in known.items()}
            box.ranks -= known.keys()
        boxes = [b for b in boxes if b.ranks]
        if boxes:
            boxes = _narrowed(df, boxes, found)
    rows = []
    for f in features:
        row = [f]
        for name in probs:
            if totals[f]:
                spot = spots[f, name]
                low, high = found[f, math.floor(spot)], found[f, math.ceil(spot)]
                row.append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
            else:
                row.append(None)
        rows.append(tuple(row))
    return df.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(f"`{n}` double" for n in probs))


def _narrowed(df: DataFrame, boxes: list[_Box], found: dict[tuple[str, int], float]) -> list[_Box]:
    """One scan over all boxes: smaller boxes for the wide ones, the answers of the others."""
    tags = []
    for i, box in enumerate(boxes):
        x = _value(box.feature)
        wide = box.n > LISTED
        tags.append(F.when(x.between(F.lit(box.low), F.lit(box.high)), F.struct(
            F.lit(i).alias("box"), (box.bin(x) if wide else F.lit(None).cast("long")).alias("bin"),
            (F.lit(None).cast("double") if wide else x).alias("listed"), x.alias("value"))))
    # The outer form keeps the tags from being computed twice (see text operators).
    inside = df.select(F.inline_outer(F.array_compact(F.array(*tags)))).where("box is not null")
    counted = inside.groupBy("box", "bin", "listed").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    parts: dict[int, list] = {}
    for r in counted.toArrow().to_pylist():
        parts.setdefault(r["box"], []).append(r)
    out = []
    for i, box in enumerate(boxes):
        below = box.below
        for r in sorted(parts[i], key=lambda r: (r["low"], r["high"])):
            ranks = {k for k in box.ranks if below <= k < below + r["n"]}
            if ranks:
                out.append(_Box(box.feature, r["low"], r["high"], below, r["n"], ranks))
            below += r["n"]
    return out


def exact_quantiles(df: DataFrame, features: Sequence[str], probs: Mapping[str, float],
                    by: Sequence[str] = (), small: bool = False) -> DataFrame:
    """One row per (group, feature) with a column per named quantile.  ``small``
    as in ``split_by_heat``."""
    policy = SizePolicy.of(df.sparkSession)
    if small or is_small(df, policy.broadcast_bytes):
        return _in_one_buffer(df, features, probs, by)
    if by or is_small(df, policy.small_bytes):
        return _by_counts(df, features, probs, by)
    return _by_histograms(df, features, probs)
