"""Profiles and audits.

Per-feature reports aggregate all features in one wide partial aggregation and
turn the finished rows into long form, so the detail rows are never multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.operators.quantiles import exact_quantiles
from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join

Aggs = dict[str, Callable[[str], Column]]


def per_feature(df: DataFrame, features: Sequence[str], aggs: Aggs,
                by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, feature) with the given aggregates."""
    packed = [F.struct(F.lit(f).alias("feature"), *[fn(f).alias(n) for n, fn in aggs.items()])
              for f in features]
    grouped = df.groupBy(*by) if by else df.groupBy()
    # Struct of aggregates per feature; inlined only on the aggregated rows.
    wide = grouped.agg(F.array(*packed).alias("__rows"))
    return wide.select(*by, F.inline("__rows"))


def clean(f: str) -> Column:
    """The value as a double, null for NaN."""
    return F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))


def state_audit(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.round(F.avg(col), 2).alias("mean"),
                  F.round(F.stddev_samp(col), 2).alias("std"),
                  F.min(col).alias("min"), F.max(col).alias("max"))


def unit_distribution(df: DataFrame, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    return df.groupBy(unit).agg(F.count(F.lit(1)).alias("rows"), F.max(cycle).alias("max_cycle"))


def cycle_density(df: DataFrame, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    return df.groupBy(unit, cycle).agg(F.count(F.lit(1)).alias("rows"))


def cycle_density_summary(df: DataFrame, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    """Distribution of rows per cycle, per unit."""
    density = cycle_density(df, unit, cycle)
    return describe_features(density, ["rows"], [unit]).drop("feature")


def describe_features(df: DataFrame, features: Sequence[str],
                      group: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quartiles (linear interpolation) and
    max per feature; nulls and NaNs are left out."""
    moments = per_feature(df, features, {
        "count": lambda f: F.count(clean(f)), "mean": lambda f: F.avg(clean(f)),
        "std": lambda f: F.stddev_samp(clean(f)),
        "min": lambda f: F.min(clean(f)), "max": lambda f: F.max(clean(f))}, group)
    quartiles = exact_quantiles(df, features, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, group)
    out = lookup_join(moments, quartiles, [*group, "feature"], "left")
    return out.select(*group, "feature", "count", "mean", "std", "min",
                      "q25", "q50", "q75", "max")


def hygiene(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return per_feature(df, features, {
        "null_count": lambda f: F.count_if(F.col(f).isNull()),
        "nan_count": lambda f: F.count_if(F.isnan(F.col(f).cast("double"))),
        "zero_count": lambda f: F.count_if(F.col(f) == 0)})


def operational_envelopes(df: DataFrame, cols: Sequence[str], unit: str = "unit") -> DataFrame:
    """min, max, mean and population std per unit and operating condition."""
    return per_feature(df, cols, {"min": F.min, "max": F.max, "mean": F.avg,
                                  "std": F.stddev_pop}, [unit])


def sensor_fidelity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_feature(df, cols, {
        "min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_pop,
        "nan_count": lambda f: F.count_if(F.isnan(F.col(f).cast("double"))),
        "zero_count": lambda f: F.count_if(F.col(f) == 0)})


def first_where(df: DataFrame, cond: Column, value: str, order: Sequence[str],
                keys: Sequence[str], name: str = "first_value", default: int = -1) -> DataFrame:
    """Value at the first row in order that satisfies the condition, per group."""
    at = F.struct(*order)
    first = F.min_by(value, F.when(cond, at))
    return df.groupBy(*keys).agg(F.coalesce(first, F.lit(default)).alias(name))


def unit_profiles(df: DataFrame, order: Sequence[str], unit: str = "unit",
                  cycle: str = "cycle", hs: str = "hs", fc: str = "fc") -> DataFrame:
    """Rows, cycles, cycle range, first degraded cycle in row order (-1 if none)
    and the sorted flight classes of each unit."""
    at = F.struct(*order)
    # Pre-aggregated per cycle: the distinct count becomes a plain count.
    per_cycle = df.groupBy(unit, cycle).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col(hs) == 1, at)).alias("hs_at"),
        F.collect_set(fc).alias("classes"))
    return per_cycle.groupBy(unit).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("cycles"),
        F.min(cycle).alias("min_cycle"), F.max(cycle).alias("max_cycle"),
        F.coalesce(F.min_by(cycle, "hs_at"), F.lit(-1)).alias("hs_start_cycle"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("classes")))).alias("classes"))


def segment_integrity(parts: dict[str, DataFrame], label_part: str, label: str) -> DataFrame:
    """Row count of each part, whether all agree, and the label range."""
    counts = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("part", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    checked = counts.agg(F.max("rows").alias("total_rows"),
                         (F.min("rows") == F.max("rows")).alias("aligned"))
    span = parts[label_part].agg(F.min(label).alias("label_min"), F.max(label).alias("label_max"))
    one = F.lit(1).alias("__k")
    return (checked.select("*", one).join(span.select("*", one), "__k").drop("__k"))


def fleet_stats(df: DataFrame, split: str = "split", unit: str = "unit") -> DataFrame:
    """Units and rows per split and in total (split ``all``)."""
    per_unit = df.groupBy(split, unit).agg(F.count(F.lit(1)).alias("n"))
    return (per_unit.rollup(split)
            .agg(F.countDistinct(unit).alias("units"), F.sum("n").alias("rows"))
            .withColumn(split, F.coalesce(split, F.lit("all"))))


def split_units(df: DataFrame, split: str = "split", unit: str = "unit") -> DataFrame:
    """The unit ids of each split, one row each."""
    return df.select(split, unit).distinct().orderBy(split, unit)


def flight_conditions(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    return per_feature(df, cols, {"min": F.min, "max": F.max, "mean": F.avg}, [by])


def label_profile(df: DataFrame, unit: str = "unit", cycle: str = "cycle",
                  label: str = "rul") -> DataFrame:
    per_cycle = df.groupBy(unit, cycle).agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi"))
    return per_cycle.groupBy(unit).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("cycles"),
        F.min("lo").alias("min_label"), F.max("hi").alias("max_label"))


def normalization_params(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and sample std per feature; nulls and NaNs are left out."""
    return per_feature(df, features, {"mean": lambda f: F.avg(clean(f)), "std": lambda f: F.stddev_samp(clean(f))})


def domain_identifiers(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Distinct values of the identifier columns as (column, value) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("value"))
        for c in ids]))).distinct()


def table_shape(df: DataFrame, cycle: str = "cycle") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(cycle).alias("max_cycle")) \
             .withColumn("columns", F.lit(len(df.columns)))


def end_of_failure(df: DataFrame, unit: str = "unit", cycle: str = "cycle",
                   approx: bool = False) -> DataFrame:
    """Number of distinct cycles per unit.  Exact by de-duplicating first, which
    spreads a hot unit over its cycles; ``approx`` uses a sketch."""
    if approx:
        return df.groupBy(unit).agg(F.approx_count_distinct(cycle).alias("eof_cycles"))
    return (df.select(unit, cycle).distinct()
              .groupBy(unit).agg(F.count(cycle).alias("eof_cycles")))


def constant_label_audit(df: DataFrame, label: str, unit: str = "unit") -> DataFrame:
    """Units and whether their label takes only one value."""
    span = df.groupBy(unit).agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
    return span.select(unit, F.coalesce(F.col("lo") == F.col("hi"), F.lit(False))
                       .alias("constant_label"))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(*cols).distinct() if cols else df.distinct()


def intensity_ratio(df: DataFrame, a: int, b: int, unit: str = "unit",
                    cycle: str = "cycle") -> DataFrame:
    """Rows per cycle of unit ``a`` over rows per cycle of unit ``b``."""
    density = cycle_density(df.where(F.col(unit).isin(a, b)), unit, cycle)
    mean_of = {k: F.avg(F.when(F.col(unit) == k, F.col("rows"))) for k in (a, b)}
    return density.agg(mean_of[a].alias("rows_per_cycle_a"),
                       mean_of[b].alias("rows_per_cycle_b"),
                       F.try_divide(mean_of[a], mean_of[b]).alias("ratio"))


def domain_shift(df: DataFrame, col: str, split: str = "split", train: str = "dev",
                 test: str = "test") -> DataFrame:
    """Values of ``col`` that occur in test and not in train."""
    seen = df.groupBy(col).agg(F.bool_or(F.col(split) == train).alias("in_train"),
                               F.bool_or(F.col(split) == test).alias("in_test"))
    return seen.where(F.col("in_test") & ~F.col("in_train")).select(col)


def lifecycle_totals(df: DataFrame, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    """Number of cycles per unit, the registration table of a replay."""
    return end_of_failure(df, unit, cycle).withColumnRenamed("eof_cycles", "total_cycles")


def lifecycle_document(df: DataFrame, units: Sequence[int] | None = None, unit: str = "unit",
                       cycle: str = "cycle") -> DataFrame:
    """The registration document of a fleet, all units or the given ones: one row with a map."""
    totals = lifecycle_totals(df if units is None else df.where(F.col(unit).isin(*units)), unit, cycle)
    entry = F.struct(F.col(unit).cast("string").alias("key"), F.col("total_cycles").alias("value"))
    return totals.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("total_cycles"))


def dataset_fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive digest of the rows: their MD5 numbers combined in two ways, and a count.  A row is
    its columns as text in order, each with its length; null is a dash."""
    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    row = F.md5(F.concat(*[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in text]))
    half = [F.conv(F.substring(row, at, 15), 16, 10).cast("long") for at in (1, 17)]
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.bit_xor(half[0]).alias("row_xor"), F.sum(half[1].cast("decimal(20,0)")).cast("decimal(38,0)").alias("row_sum"),
                       F.count(F.lit(1)).alias("rows"))


def recent_describe(df: DataFrame, features: Sequence[str], order: Sequence[Column],
                    n: int = 100) -> DataFrame:
    """``describe_features`` of the latest ``n`` rows."""
    return describe_features(df.orderBy(*order).limit(n), features)


def latest(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps only ``k`` rows."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, n: int, order: Sequence[Column | str],
                where: Column | None = None) -> DataFrame:
    return latest(df if where is None else df.where(where), n, order)


def trajectory(df: DataFrame, unit: int, order: Sequence[str] = ("cycle", "timestamp_ms"),
               unit_col: str = "unit") -> DataFrame:
    return df.where(F.col(unit_col) == unit).orderBy(*order)


def head_tail(df: DataFrame, part: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First and last ``n`` rows of each group, tagged ``head`` / ``tail``."""
    first = take_per_group(df, part, list(order), n).withColumn("end", F.lit("head"))
    last = take_per_group(df, part, [F.desc(c) for c in order], n).withColumn("end", F.lit("tail"))
    return first.unionByName(last)
