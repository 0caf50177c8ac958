"""Prediction quality, calibration, densities and training-log metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.scalars import normal_quantiles
from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join


def _observed(num_bins: int, kind: str, residual: Column) -> list[tuple[float, Column]]:
    """(expected proportion, observed proportion aggregate) per bin."""
    half = {p: z for p, z in normal_quantiles(2 * num_bins - 1)}
    grid = sorted(half)
    out = []
    for i in range(num_bins):
        p = i / (num_bins - 1)
        if kind == "quantile":
            z = half[grid[2 * i]]
            hit = F.lit(z > 0) if z in (float("-inf"), float("inf")) else residual <= z
        elif kind == "interval":
            z = half[grid[num_bins - 1 + i]]
            hit = F.lit(True) if z == float("inf") else F.abs(residual) <= z
        else:
            raise ValueError(f"unknown kind {kind!r}")
        out.append((p, F.avg(F.when(hit, 1.0).otherwise(0.0))))
    return out


def _residual(pred: str, true: str, std: str) -> Column:
    return (F.col(pred) - F.col(true)) / F.col(std)


def calibration_curve(df: DataFrame, num_bins: int = 11, kind: str = "interval",
                      by: Sequence[str] = (), pred: str = "y_pred", true: str = "y_true",
                      std: str = "y_std") -> DataFrame:
    """Expected and observed share of residuals per bin, all bins in one pass.

    ``interval``: residuals inside the central interval of probability p;
    ``quantile``: residuals below the p quantile.
    """
    residuals = df.select(*by, _residual(pred, true, std).alias("r"))
    bins = _observed(num_bins, kind, F.col("r"))
    grouped = residuals.groupBy(*by) if by else residuals.groupBy()
    rows = grouped.agg(F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(p).alias("expected"), c.alias("observed"))
        for i, (p, c) in enumerate(bins)]).alias("b"))
    return rows.select(*by, F.inline("b"))


def rul_metrics(df: DataFrame, by: Sequence[str] = (), num_bins: int = 11,
                kind: str = "interval", pred: str = "y_pred", true: str = "y_true",
                std: str = "y_std") -> DataFrame:
    """MSE, RMSE, calibration error (RMSCE) and sharpness per group, one pass."""
    base = df.select(*by, (F.col(pred) - F.col(true)).alias("e"), F.col(std).alias("s"),
                     _residual(pred, true, std).alias("r"))
    bins = _observed(num_bins, kind, F.col("r"))
    squares = [F.pow(c - F.lit(p), 2) for p, c in bins]
    total = squares[0]
    for c in squares[1:]:
        total = total + c
    grouped = base.groupBy(*by) if by else base.groupBy()
    mse = F.avg(F.col("e") * F.col("e"))
    return grouped.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"),
                       F.sqrt(total / len(bins)).alias("rmsce"),
                       F.sqrt(F.avg(F.col("s") * F.col("s"))).alias("sharpness"))


def asymmetric_score(df: DataFrame, a_under: float, a_over: float, by: Sequence[str] = (),
                     pred: str = "y_pred", true: str = "y_true") -> DataFrame:
    """Sum of exp(penalty) - 1 with separate slopes for early and late errors."""
    d = F.col(pred) - F.col(true)
    cost = F.exp(F.when(d < 0, -d * a_under).otherwise(d * a_over)) - 1
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.sum(cost).alias("score"))


def kde(df: DataFrame, col: str, group: Sequence[str], gridsize: int = 100,
        bw: float | str = "scott", bins: int = 512, cut: float = 3.0) -> DataFrame:
    """Gaussian density on a grid per group.

    Values are first counted in equal bins per group (a partial aggregation), so
    the kernel sum costs bins x gridsize per group however many rows there are.
    The bandwidth is Scott's rule or a fixed number; the grid reaches ``cut``
    bandwidths beyond the data.
    """
    v = F.col(col).cast("double")
    # Group keys keep their names; the value is renamed to keep it apart.
    base = df.select(*group, v.alias("__v")).where(F.col("__v").isNotNull())
    stats = base.groupBy(*group).agg(
        F.count("__v").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
        F.stddev_samp("__v").alias("__sd"))
    span = F.col("__hi") - F.col("__lo")
    slot = F.least(F.floor((F.col("__v") - F.col("__lo")) / F.nullif(span, F.lit(0.0)) * bins),
                   F.lit(bins - 1))
    counted = (lookup_join(base, stats, group)
               .groupBy(*group, F.coalesce(slot, F.lit(0)).alias("__slot"))
               .agg(F.count(F.lit(1)).alias("__c")))
    histogram = counted.groupBy(*group).agg(     # at most `bins` entries
        F.collect_list(F.struct("__slot", "__c")).alias("__h"))
    width = (F.col("__sd") * F.pow(F.col("__n"), -0.2)) if bw == "scott" else F.lit(float(bw))
    lined = lookup_join(histogram, stats, group).withColumn("__bw", width) \
                     .where(F.col("__bw") > 0)
    start = F.col("__lo") - F.col("__bw") * cut
    step = (span + F.col("__bw") * (2 * cut)) / (gridsize - 1)
    points = lined.select(
        *group, "__h", "__n", "__bw", (span / bins).alias("__w"), "__lo",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(gridsize - 1)),
                                 lambda i: start + step * i)).alias("grid_idx", "x"))

    def kernel(acc: Column, b: Column) -> Column:
        center = F.col("__lo") + (b["__slot"] + 0.5) * F.col("__w")
        z = (F.col("x") - center) / F.col("__bw")
        return acc + b["__c"] * F.exp(z * z * -0.5)

    norm = F.col("__n") * F.col("__bw") * 2.5066282746310002
    return points.select(*group, "grid_idx", "x",
                         (F.aggregate("__h", F.lit(0.0), kernel) / norm).alias("density"))


def _ends(log: DataFrame) -> DataFrame:
    """First and last value of each tag by step."""
    return log.groupBy("tag").agg(F.min_by("value", "step").alias("initial"),
                                  F.max_by("value", "step").alias("current"))


def _percent(c: Column, digits: int) -> Column:
    return F.format_string(f"%+.{digits}f%%", c)


def kpi_table(log: DataFrame, targets: Mapping[str, float], variant: str = "final",
              error_marker: str = "mse", error_target: float | None = None,
              rising: Sequence[str] = ()) -> DataFrame:
    """Initial, current, target, distance to target and trend per tag.

    ``final`` compares each tag to its own target.  ``live`` compares every tag
    whose name contains ``error_marker`` to ``error_target``.  A tag improves
    when it falls; tags in ``rising`` also improve when they rise.
    """
    ends = _ends(log)
    tag = F.col("tag")
    own = F.lit(None).cast("double")
    if targets:
        known = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
        own = F.try_element_at(known, tag).cast("double")
    if variant == "live":
        compared = F.when(F.contains(tag, F.lit(error_marker)), F.lit(error_target).cast("double"))
    elif variant == "final":
        compared = F.when(own != 0, own)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    gap = F.col("current") - compared
    pct = gap / compared * 100
    improving = F.col("current") < F.col("initial")
    if rising:
        improving = improving | (tag.isin(*rising) & (F.col("current") > F.col("initial")))
    return ends.select(
        "tag", "initial", "current", own.alias("target"),
        F.when(gap > 0, pct).alias("distance_pct"),
        F.when(gap > 0, F.concat(_percent(pct, 1), F.lit(" to target")))
         .when(gap <= 0, "REACHED").otherwise("").alias("distance"),
        F.when(improving, "IMPROVING").otherwise("STABLE").alias("trend"))


def generalization(log: DataFrame, train: str = "mse/train", val: str = "mse/val") -> DataFrame:
    """Validation gap in percent and RMSE of the last values."""
    def last(tag: str) -> Column:
        mine = F.col("tag") == tag
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("step")))
    ends = log.where(F.col("tag").isin(train, val)).agg(
        last(train).alias("train_mse"), last(val).alias("val_mse"))
    gap = F.try_divide(F.col("val_mse") - F.col("train_mse"), F.col("train_mse")) * 100
    return ends.select("train_mse", "val_mse", F.sqrt("train_mse").alias("train_rmse"),
                       F.sqrt("val_mse").alias("val_rmse"), gap.alias("gap_pct"),
                       _percent(gap, 2).alias("gap"))


def eta(log: DataFrame, tag: str, steps_per_epoch: int, epochs: int, base: int = 0) -> DataFrame:
    """Progress of a run: epoch, steps per second, remaining steps and seconds."""
    ends = log.where(F.col("tag") == tag).agg(
        F.min("step").alias("s0"), F.max("step").alias("s1"),
        F.min_by("wall_time", "step").alias("t0"), F.max_by("wall_time", "step").alias("t1"))
    elapsed = F.col("t1") - F.col("t0")
    moving = elapsed > 0
    rate = F.when(moving, (F.col("s1") - F.col("s0")) / elapsed).otherwise(F.lit(0.0))
    left = F.when(moving, F.lit((epochs - base) * steps_per_epoch) - F.col("s1")).otherwise(F.lit(0))
    run_epoch = F.floor(F.col("s1") / steps_per_epoch)
    return ends.where(F.col("s1").isNotNull()).select(
        F.col("s1").alias("last_step"), run_epoch.alias("epoch"),
        (run_epoch + base).alias("total_epoch"), rate.alias("steps_per_sec"),
        left.cast("long").alias("steps_remaining"),
        F.when(rate > 0, left / rate).otherwise(F.lit(0.0)).alias("eta_seconds"))


def recent_slope(log: DataFrame, n: int = 50) -> DataFrame:
    """Slope per point over the last ``n`` points of tags with more than ``n``.

    One point more than needed is kept per tag, which tells whether the tag is
    long enough without counting it.
    """
    tail = take_per_group(log, ["tag"], [F.desc("step")], n + 1, "__back")
    used = F.col("__back") <= n
    x = F.when(used, F.lit(n) - F.col("__back")).cast("double")
    return (tail.groupBy("tag")
                .agg(F.max("__back").alias("__len"),
                     F.regr_slope(F.when(used, F.col("value")), x).alias("slope"))
                .where(F.col("__len") > n).drop("__len"))
