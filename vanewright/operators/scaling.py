"""Global scalers, normalisation solving and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.scalars import field_of
from vanewright.operators.profile import clean, per_feature
from vanewright.operators.project import Stats, zscore
from vanewright.plans.sizing import lookup_join

VARIANCE_FLOOR = 1e-9  # fixed value


def compute_scalers(df: DataFrame, features: Sequence[str], by: str = "dataset",
                    pooled: str = "within") -> DataFrame:
    """Global mean and std per feature.

    ``within`` pools the centred sums of squares of each dataset, leaving out
    differences between dataset means; ``total`` is the spread over all rows.
    Both are one partial/final aggregation.  Nulls and NaNs are left out.
    """
    if pooled == "total":
        flat = per_feature(df, features, {"mean": lambda f: F.avg(clean(f)), "var": lambda f: F.var_pop(clean(f))})
        return flat.select("feature", "mean", _floored(F.col("var")).alias("std"))
    if pooled != "within":
        raise ValueError(f"unknown pooling {pooled!r}")
    local = per_feature(df, features, {
        "total": lambda f: F.sum(clean(f)), "n": lambda f: F.count(clean(f)),
        "ss": lambda f: F.coalesce(F.var_samp(clean(f)), F.lit(0.0)) * (F.count(clean(f)) - 1)}, [by])
    rows = F.sum("n")
    return local.groupBy("feature").agg(F.try_divide(F.sum("total"), rows).alias("mean"),
                                        _floored(F.try_divide(F.sum("ss"), rows)).alias("std"))


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows, values, mean and centred sum of squares per group and feature."""
    return per_feature(df, features, {
        "rows": lambda f: F.count(F.lit(1)), "n": lambda f: F.count(clean(f)), "mean": lambda f: F.avg(clean(f)),
        "ss": lambda f: F.var_pop(clean(f)) * F.count(clean(f))}, by)


def pool_moments(parts: DataFrame, by: str = "dataset", pooled: str = "within") -> DataFrame:
    """``compute_scalers`` from moments of any finer groups, without the rows."""
    keys = [by, "feature"] if pooled == "within" else ["feature"]
    centre = parts.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("__c"))
    moved = lookup_join(parts, centre, keys)
    per_set = moved.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("__c").alias("c"),
        F.sum(F.col("ss") + F.col("n") * F.pow(F.col("mean") - F.col("__c"), 2)).alias("ss"))
    rows = F.sum("n")
    return per_set.groupBy("feature").agg(
        F.try_divide(F.sum(F.col("n") * F.col("c")), rows).alias("mean"),
        _floored(F.try_divide(F.sum("ss"), rows)).alias("std"))


def _floored(variance: Column) -> Column:
    return F.sqrt(F.greatest(variance, F.lit(VARIANCE_FLOOR)))


def window_minmax(windows: DataFrame, features: Sequence[str], col: str = "window") -> DataFrame:
    """Smallest and largest value of each feature over all windows, 0 if there
    are none.  Each window is reduced in its row before the aggregation."""
    values = {f: field_of(col, f) for f in features}
    return per_feature(
        windows.select(*[F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi")).alias(f)
                         for f, v in values.items()]),
        features, {"min_sample": lambda f: F.coalesce(F.min(f"{f}.lo"), F.lit(0.0)),
                   "max_sample": lambda f: F.coalesce(F.max(f"{f}.hi"), F.lit(0.0))})


def solve_affine(pairs: DataFrame, features: Sequence[str], by: Sequence[str] = (),
                 order: str = "row_no") -> DataFrame:
    """(mean, std) per feature from raw/normalised pairs of the same rows.

    Uses the first and last row; if either side is equal there, the rows with
    the smallest and largest raw value.  A flat signal gives std 1, mean raw.
    """
    def raw(f: str) -> str:
        return f"raw.{f}"

    def norm(f: str) -> str:
        return f"norm.{f}"

    def at(f: str) -> Column:
        return F.struct(F.col(raw(f)), F.col(order))

    def at_late_tie_first(f: str) -> Column:
        return F.struct(F.col(raw(f)), -F.col(order))

    ends = per_feature(pairs, features, {
        "r1": lambda f: F.min_by(raw(f), order), "r2": lambda f: F.max_by(raw(f), order),
        "n1": lambda f: F.min_by(norm(f), order), "n2": lambda f: F.max_by(norm(f), order),
        "rlo": lambda f: F.min(raw(f)), "rhi": lambda f: F.max(raw(f)),
        "nlo": lambda f: F.min_by(norm(f), at(f)),
        "nhi": lambda f: F.max_by(norm(f), at_late_tie_first(f))}, by)
    level = (F.col("r1") == F.col("r2")) | (F.col("n1") == F.col("n2"))

    def pick(ends_value: str, range_value: str) -> Column:
        return F.when(level, F.col(range_value)).otherwise(F.col(ends_value))

    picked = ends.select(*by, "feature", pick("r1", "rlo").alias("ra"), pick("r2", "rhi").alias("rb"),
                         pick("n1", "nlo").alias("na"), pick("n2", "nhi").alias("nb"))
    flat = F.col("ra") == F.col("rb")
    std = F.when(flat, F.lit(1.0)).otherwise(
        F.try_divide(F.col("rb") - F.col("ra"), F.col("nb") - F.col("na")))
    solved = picked.withColumn("std", std)
    mean = F.when(flat, F.col("ra")).otherwise(F.col("ra") - F.col("na") * F.col("std"))
    return solved.select(*by, "feature", mean.alias("mean"), "std")


def check_normalization(df: DataFrame, stats: DataFrame | Stats, features: Sequence[str],
                        stored_suffix: str = "_z", tol: float = 1e-6) -> DataFrame:
    """Largest deviation per feature between computed and stored z-scores."""
    scaled = zscore(df, stats, features, "__calc")
    return per_feature(scaled, features, {
        "max_abs_diff": lambda f: F.max(F.abs(F.col(f"{f}__calc") - F.col(f"{f}{stored_suffix}")))
    }).withColumn("ok", F.col("max_abs_diff") < tol)
