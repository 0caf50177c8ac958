"""Joins, reconciliations and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.operators.profile import normalization_params
from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join

SECONDS_PER_CYCLE = 5.5  # fixed value: nominal replay pace
FRESH_SECONDS = 86_400   # fixed value: one day


def pair_by_row(raw: DataFrame, norm: DataFrame, unit: str, order: Sequence[str],
                n: int = 1000) -> DataFrame:
    """Raw and normalised readings of the first ``n`` rows of each unit side by
    side (``raw``/``norm`` structs).  Both sides are cut to ``n`` rows per unit
    before the join."""
    def numbered(df: DataFrame, name: str) -> DataFrame:
        body = [c for c in df.columns if c != unit]
        return (take_per_group(df, [unit], list(order), n, "row_no")
                .select(unit, "row_no", F.struct(*body).alias(name)))
    return lookup_join(numbered(raw, "raw"), numbered(norm, "norm"), [unit, "row_no"])


def compare_domains(ref: DataFrame, live: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and std per feature of two tables side by side."""
    def renamed(df: DataFrame, tag: str) -> DataFrame:
        return normalization_params(df, features).select(
            "feature", F.col("mean").alias(f"{tag}_mean"), F.col("std").alias(f"{tag}_std"))
    return renamed(ref, "ref").join(renamed(live, "live"), "feature", "full")


def unsigned_artifacts(files: DataFrame, path: str = "path", suffix: str = ".sig") -> DataFrame:
    """Artifacts without a signature file beside them."""
    return _by_signature(files, path, suffix, "left_anti")


def signed_artifacts(files: DataFrame, path: str = "path", suffix: str = ".sig") -> DataFrame:
    return _by_signature(files, path, suffix, "left_semi")


def _by_signature(files: DataFrame, path: str, suffix: str, how: str) -> DataFrame:
    is_sig = F.col(path).endswith(suffix)
    stem = F.expr(f"substr({path}, 1, length({path}) - {len(suffix)})")
    signed = files.where(is_sig).select(stem.alias(path))
    return files.where(~is_sig).join(signed, path, how)


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Counts of expected, recovered, missing and extra keys.  ``passes`` only
    compares totals, so it can hide missing keys; ``complete`` does not."""
    sides = (expected.select(key).distinct().withColumn("side", F.lit(1))
             .unionByName(actual.select(key).distinct().withColumn("side", F.lit(2))))
    per_key = sides.groupBy(key).agg(F.sum("side").alias("seen"))
    out = per_key.agg(
        F.count_if(F.col("seen") != 2).alias("expected"),
        F.count_if(F.col("seen") != 1).alias("recovered"),
        F.count_if(F.col("seen") == 1).alias("missing"),
        F.count_if(F.col("seen") == 2).alias("extra"))
    return out.withColumns({"passes": F.col("recovered") >= F.col("expected"),
                            "complete": F.col("missing") == 0})


def missing_keys(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    return lookup_join(expected.select(key).distinct(), actual.select(key), [key], "left_anti")


def split_by_units(df: DataFrame, val_units: DataFrame, unit: str = "unit"
                   ) -> tuple[DataFrame, DataFrame]:
    """(rest, hold-out) by a table of chosen units."""
    chosen = val_units.select(unit).distinct()
    return tuple(lookup_join(df, chosen, [unit], how, probe=True) for how in ("left_anti", "left_semi"))


def mission_progress(telemetry: DataFrame, lifecycle: DataFrame, unit: str = "unit",
                     cycle: str = "cycle", total: str = "total_cycles") -> DataFrame:
    """Progress and remaining seconds per unit.  Units without a known positive
    total have no row."""
    current = telemetry.groupBy(unit).agg(F.max(cycle).alias("current_cycle"))
    joined = lookup_join(current, lifecycle.where(F.col(total) > 0).select(unit, total), [unit])
    left = (F.col(total) - F.col("current_cycle")) * SECONDS_PER_CYCLE
    return joined.withColumns({
        "remaining_sec": F.greatest(F.lit(0.0), left),
        "progress": F.least(F.lit(1.0), F.col("current_cycle") / F.col(total))})


def latest_fresh(files: DataFrame, now_s: float, horizon_s: float = FRESH_SECONDS,
                 path: str = "path", mtime_s: str = "mtime_s",
                 by: Sequence[str] = ()) -> DataFrame:
    """Newest artifact (per group) and whether it is younger than the horizon."""
    newest = F.max(F.struct(mtime_s, path)).alias("n")
    agg = files.groupBy(*by).agg(newest) if by else files.agg(newest)
    return agg.select(*by, F.col("n")[path].alias("path"), F.col("n")[mtime_s].alias("mtime_s"),
                      (F.col("n")[mtime_s] > F.lit(now_s - horizon_s)).alias("fresh"))


def union_splits(dev: DataFrame, test: DataFrame) -> DataFrame:
    assert_aligned([dev, test])
    return (dev.withColumn("split", F.lit("dev"))
               .unionByName(test.withColumn("split", F.lit("test"))))


def synthesis(reports: Sequence[DataFrame]) -> DataFrame:
    """One table out of per-file reports with the same columns."""
    assert_aligned(reports)
    return reduce(DataFrame.unionByName, reports)


def dropped_inputs(requested: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    return lookup_join(requested.select(key).distinct(), valid.select(key), [key], "left_anti")


def assert_aligned(frames: Sequence[DataFrame]) -> None:
    """Raise unless all frames have the same column names and types in order."""
    want = [(f.name, f.dataType) for f in frames[0].schema]
    for i, frame in enumerate(frames[1:], start=1):
        got = [(f.name, f.dataType) for f in frame.schema]
        if got != want:
            raise ValueError(f"input {i} is not aligned with input 0: {got} != {want}")


def check_dual_schema(columns: DataFrame, k: int = 18, name: str = "column_name",
                      suffix: str = "_z") -> DataFrame:
    """Number of z-space columns of a table against the expected number."""
    return (columns.agg(F.count_if(F.col(name).endswith(suffix)).alias("z_columns"))
                   .withColumn("complete", F.col("z_columns") == k))


def join_constants(df: DataFrame, constants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-key constants (unit configuration, bounds) on every row."""
    return lookup_join(df, constants, keys, "left")
