"""Projections, filters and predicates."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.scalars import col_of
from vanewright.schemas import META_PATTERN, PHYSICAL_ABOVE

Stats = Mapping[str, tuple[float, float]]


def filter_unit(df: DataFrame, unit: int, cycle: int | None = None, fc: int | None = None,
                unit_col: str = "unit", cycle_col: str = "cycle", fc_col: str = "fc") -> DataFrame:
    """Rows of a unit, optionally of one cycle or flight class; all three reach
    the parquet scan as pushed filters."""
    out = df.where(F.col(unit_col) == unit)
    if cycle is not None:
        out = out.where(F.col(cycle_col) == cycle)
    if fc is not None:
        out = out.where(F.col(fc_col) == fc)
    return out


def feature_columns(df: DataFrame, exclude: str = META_PATTERN,
                    meta: Sequence[str] = ()) -> list[str]:
    """Columns to scale: not matching the pattern anywhere, not in ``meta``."""
    return [c for c in df.columns if not re.search(exclude, c) and c not in meta]


def stats_map(stats: DataFrame | Stats) -> dict[str, tuple[float, float]]:
    """(mean, std) per feature; a stats table has one row per feature column."""
    if isinstance(stats, DataFrame):
        return {r["feature"]: (r["mean"], r["std"])
                for r in stats.select("feature", "mean", "std").collect()}
    return dict(stats)


def _z(c: Column, mean: float, std: float) -> Column:
    return (c - F.lit(mean)) / F.lit(std)


def zscore(df: DataFrame, stats: DataFrame | Stats, features: Sequence[str],
           suffix: str = "") -> DataFrame:
    """(x - mean) / std for each feature, in one projection."""
    known = stats_map(stats)
    return df.withColumns({f"{f}{suffix}": _z(F.col(f), *known[f]) for f in features})


def unzscore(df: DataFrame, stats: DataFrame | Stats, features: Sequence[str],
             suffix: str = "") -> DataFrame:
    """x * std + mean for each feature."""
    known = stats_map(stats)
    return df.withColumns({f"{f}{suffix}": F.col(f) * F.lit(known[f][1]) + F.lit(known[f][0])
                           for f in features})


def dual_domain(df: DataFrame, stats: DataFrame | Stats, features: Sequence[str],
                threshold: float = PHYSICAL_ABOVE, mode: str = "per_value") -> DataFrame:
    """Physical value in ``f`` and z-score in ``f_z`` for every feature.

    ``per_value`` decides for each value alone: above the threshold it is
    physical, otherwise a z-score.  ``per_row`` takes the whole row as physical
    when any feature is above the threshold.
    """
    known = stats_map(stats)
    if mode == "per_value":
        physical = {f: F.abs(F.col(f)) > threshold for f in features}
    elif mode == "per_row":
        row = F.greatest(*[F.abs(F.col(f)) for f in features]) > threshold \
            if len(features) > 1 else F.abs(F.col(features[0])) > threshold
        physical = dict.fromkeys(features, row)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out: dict[str, Column] = {}
    for f in features:
        mean, std = known[f]
        c = F.col(f)
        out[f] = F.when(physical[f], c).otherwise(c * F.lit(std) + F.lit(mean))
        out[f"{f}_z"] = F.when(physical[f], _z(c, mean, std)).otherwise(c)
    return df.withColumns(out)


def confidence_band(df: DataFrame, k: float = 1.96, mean: str = "predicted_rul",
                    std: str = "predicted_std") -> DataFrame:
    """mean +- k std; only the lower bound is clipped at 0."""
    spread = F.lit(k) * F.col(std)
    return df.withColumns({"ci_lower": F.greatest(F.lit(0.0), F.col(mean) - spread),
                           "ci_upper": F.col(mean) + spread})


def flag_threshold(df: DataFrame, col: str, t: float, name: str,
                   by: Sequence[str] | None = None) -> DataFrame:
    """``col > t`` per row, or ``max(col) > t`` per group."""
    if by is None:
        return df.withColumn(name, F.col(col) > t)
    return df.groupBy(*by).agg((F.max(col) > t).alias(name))


def piecewise_linear(x: Column | str, knots: Sequence[tuple[float, float]]) -> Column:
    """Linear interpolation between sorted knots, null outside their range."""
    c = col_of(x)
    out = F.when(c == knots[-1][0], F.lit(float(knots[-1][1])))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        slope = (y1 - y0) / (x1 - x0)
        out = out.when((c >= x0) & (c < x1), F.lit(y0) + (c - F.lit(x0)) * F.lit(slope))
    return out


# Flight envelope, (Mach, ft).
ENVELOPE_UPPER = [(0.0, 17000.0), (0.2, 17000.0), (0.4, 40000.0), (0.6, 40000.0), (0.8, 40000.0)]
ENVELOPE_LOWER = [(0.0, 0.0), (0.2, 0.0), (0.4, 0.0), (0.6, 0.0), (0.8, 10000.0)]


def in_envelope(df: DataFrame, x: str, y: str,
                lower: Sequence[tuple[float, float]] = ENVELOPE_LOWER,
                upper: Sequence[tuple[float, float]] = ENVELOPE_UPPER,
                name: str = "in_envelope") -> DataFrame:
    """Whether y lies between the two bounds at x; false outside the knots."""
    inside = F.col(y).between(piecewise_linear(x, lower), piecewise_linear(x, upper))
    return df.withColumn(name, F.coalesce(inside, F.lit(False)))


def range_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Per rule (name to SQL predicate): number of violating rows and a flag,
    all rules in one pass."""
    counts = df.agg(*[F.count_if(F.expr(p)).alias(n) for n, p in rules.items()])
    return (counts.unpivot([], list(rules), "rule", "violations")
                  .withColumn("violated", F.col("violations") > 0))


def normalization_audit(df: DataFrame, col: str, t: float = 100.0,
                        by: str = "src_file") -> DataFrame:
    """Average and maximum per file; a small maximum suggests z-scored data."""
    return (df.groupBy(by).agg(F.avg(col).alias("avg_value"), F.max(col).alias("max_value"))
              .withColumn("looks_normalized", F.col("max_value") < t))


def find_columns(schema: DataFrame, terms: Sequence[str], name: str = "column_name") -> DataFrame:
    """Column names containing any term, case-insensitive."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    return schema.where(F.exists(wanted, lambda t: F.contains(F.lower(name), t)))


def normalize_keys(df: DataFrame, col: str, strip: Sequence[str] = (),
                   drop_suffixes: Sequence[str] = ()) -> DataFrame:
    """Strip key prefixes and drop keys with given suffixes (parameter tables)."""
    out = df
    for suffix in drop_suffixes:
        out = out.where(~F.col(col).endswith(suffix))
    if strip:
        pattern = "^(?:" + "|".join(re.escape(p) for p in strip) + ")"
        out = out.withColumn(col, F.regexp_replace(col, pattern, ""))
    return out


def verdict(df: DataFrame, col: str, t: float, name: str = "verdict",
            below: str = "READY", otherwise: str = "NOT_READY") -> DataFrame:
    return df.withColumn(name, F.when(F.col(col) < t, below).otherwise(otherwise))
