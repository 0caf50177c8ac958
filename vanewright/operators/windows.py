"""Ordered per-unit operators.  Every one takes an explicit order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.plans.ordered import dense_index, framed, running_sum, take_per_group
from vanewright.plans.sizing import attach_group, hot_groups, lookup_join


def moving_average(df: DataFrame, features: Sequence[str], order: Sequence[str], n: int = 10,
                   keys: Sequence[str] = ("unit", "cycle"), suffix: str = "") -> DataFrame:
    """Mean of the last ``n`` rows inside (unit, cycle); partial frames count.
    Replaces the features, or adds columns when a suffix is given."""
    def exprs(spec):
        frame = spec.rowsBetween(-(n - 1), 0)
        return {f"{f}__ma": F.avg(f).over(frame) for f in features}
    out = framed(df, keys, order, n - 1, exprs)
    kept = [F.col(f"{c}__ma").alias(c) if c in features and not suffix else F.col(c)
            for c in df.columns]
    extra = [F.col(f"{f}__ma").alias(f"{f}{suffix}") for f in features] if suffix else []
    return out.select(*kept, *extra)


def session_ids(df: DataFrame, order: Sequence[str], unit: str = "unit", cycle: str = "cycle",
                name: str = "session_id") -> DataFrame:
    """Session number per row: a new one begins when the cycle falls."""
    def exprs(spec):
        fell = F.coalesce(F.col(cycle) < F.lag(cycle).over(spec), F.lit(False))
        return {"__fell": fell.cast("long")}
    flagged = framed(df, [unit], order, 1, exprs)
    return running_sum(flagged, [unit], order, "__fell", name).drop("__fell")


def sliding_windows(df: DataFrame, features: Sequence[str], order: Sequence[str],
                    size: int = 30, keys: Sequence[str] = ("unit",), name: str = "window",
                    compat_drop_first: bool = False, session: str = "session_id") -> DataFrame:
    """The last ``size`` rows of each row as an array of feature structs, for
    rows that have that many.

    ``compat_drop_first`` leaves the first row of every later session out of
    all windows (the row on which a reset happens).
    """
    source = df
    if compat_drop_first:
        numbered = dense_index(df, keys, order, "__p")
        source = numbered.where((F.col("__p") > 0) | (F.col(session) == 0)).drop("__p")

    def exprs(spec):
        frame = spec.rowsBetween(-(size - 1), 0)
        return {name: F.collect_list(F.struct(*features)).over(frame)}
    out = framed(source, keys, order, size - 1, exprs)
    return out.where(F.size(name) == size)


def stride_sample(df: DataFrame, order: Sequence[str], k: int | str = 10,
                  keys: Sequence[str] = ("unit", "cycle")) -> DataFrame:
    """Every step-th row of a group, ``step = max(1, n div k)``, at most ``k``
    rows.  ``k`` is a number or a column."""
    want = F.col(k) if isinstance(k, str) else F.lit(k)
    placed = dense_index(df, keys, order, "__i", "__n")
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / want))
    keep = (F.col("__i") % step == 0) & (F.floor(F.col("__i") / step) < want)
    return placed.where(keep).drop("__i", "__n")


def training_windows(df: DataFrame, features: Sequence[str], order: Sequence[str],
                     win_length: int = 30, win_step: int = 10, skip_obs: int = 10,
                     label: str = "rul", keys: Sequence[str] = ("unit",)) -> DataFrame:
    """Full windows of ``win_length`` thinned rows, one every ``win_step`` rows.

    Keeps every ``skip_obs``-th row of a group.  Rows are packed into blocks of
    gcd(length, step) rows; a window is a run of consecutive blocks, so rows are
    not multiplied before they are packed.  The label is that of the last row.
    """
    g = math.gcd(win_length, win_step)
    per_window = win_length // g
    # Blocks are fewer than rows: where no group of rows is hot, none of blocks is, and counting them again
    # would compute all of this twice.
    small = hot_groups(df, keys) is None
    placed = dense_index(df, keys, order, "__i", small=small)
    thin = placed.where(F.col("__i") % skip_obs == 0) \
                 .withColumn("__t", F.floor(F.col("__i") / skip_obs).cast("long"))
    row = F.struct("__t", F.struct(*features).alias("x"), F.col(label).alias("y"))
    blocks = (thin.groupBy(*keys, F.floor(F.col("__t") / g).cast("long").alias("__b"))
                  .agg(F.sort_array(F.collect_list(row)).alias("__rows"))
                  .where(F.size("__rows") == g))

    def exprs(spec):
        frame = spec.rowsBetween(-(per_window - 1), 0)
        return {"__run": F.collect_list("__rows").over(frame)}
    runs = framed(blocks, keys, ["__b"], per_window - 1, exprs, small)
    start = (F.col("__b") - (per_window - 1)) * g
    return (runs.where((F.size("__run") == per_window) & (start % win_step == 0))
                .select(*keys, start.alias("window_start"),
                        F.transform(F.flatten("__run"), lambda r: r["x"]).alias("window"),
                        F.element_at(F.element_at("__run", -1), -1)["y"].alias("label")))


def label_jitter(df: DataFrame, order: Sequence[str], label: str, unit: str = "unit") -> DataFrame:
    """Rows whose label is above that of the row before."""
    out = framed(df, [unit], order, 1,
                 lambda spec: {"label_diff": F.col(label) - F.lag(label).over(spec)})
    return out.where(F.col("label_diff") > 0)


def latest_status(df: DataFrame, order: Sequence[str], k: float = 1.96, unit: str = "unit",
                  cycle: str = "cycle", pred: str = "predicted_rul", true: str = "true_rul",
                  std: str = "predicted_std") -> DataFrame:
    """Last scored row per unit, with the band width and the change of the
    uncertainty since the row before (0 if there is none)."""
    two = take_per_group(df, [unit], [F.desc(c) for c in order], 2, "__back")

    def at(back: int, c: str) -> Column:
        return F.max(F.when(F.col("__back") == back, F.col(c)))
    return two.groupBy(unit).agg(
        at(1, cycle).alias("current_cycle"), at(1, pred).alias("predicted_rul"),
        at(1, true).alias("true_rul"), at(1, std).alias("predicted_std"),
        (at(1, std) * k).alias("uncertainty"),
        F.coalesce(at(1, std) - at(2, std), F.lit(0.0)).alias("uncertainty_delta"))


def elapsed_index(df: DataFrame, order: Sequence[str], unit: str = "unit",
                  name: str = "elapsed") -> DataFrame:
    return dense_index(df, [unit], order, name)


def chart_buckets(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str,
                  width: int = 60, height: int = 10) -> DataFrame:
    """A series reduced to ``width`` points and ``height`` levels.

    Column i shows element ``i * n div width``; each row knows from its position
    which columns show it, so nothing is joined.  ``level`` is the number of
    filled cells, the cell at level h being filled when the value is above
    ``min + h / height * range``.
    """
    span = df.groupBy(*part).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    placed = dense_index(df.select(*dict.fromkeys([*part, *order, value])), part, order,
                         "__i", "__n")
    first = F.ceil(F.col("__i") * width / F.col("__n"))
    last = F.ceil((F.col("__i") + 1) * width / F.col("__n")) - 1
    shown = placed.where(first <= last).select(
        *part, F.explode(F.sequence(first, last)).alias("column_idx"),
        F.col(value).alias("value"))
    rng = F.when(F.col("__hi") == F.col("__lo"), F.lit(1.0)).otherwise(F.col("__hi") - F.col("__lo"))
    level = F.ceil((F.col("value") - F.col("__lo")) / rng * height)
    return lookup_join(shown, span, part).select(
        *part, "column_idx", "value", level.alias("level"))


def piecewise_rul(df: DataFrame, healthy: Column, label: str = "rul", unit: str = "unit",
                  name: str = "rul_capped") -> DataFrame:
    """Label capped at its largest value among the degraded rows of the unit."""
    out = attach_group(df, [unit], __cap=F.max(F.when(~healthy, F.col(label))))
    return out.withColumn(name, F.least(label, "__cap")).drop("__cap")


def raw_rul(df: DataFrame, unit: str = "unit", cycle: str = "cycle", name: str = "rul") -> DataFrame:
    """Cycles left until the unit's last cycle."""
    out = attach_group(df, [unit], __last=F.max(cycle))
    return out.withColumn(name, F.col("__last") - F.col(cycle)).drop("__last")


def reservoir(df: DataFrame, part: Sequence[str], n: int, seed: int = 0,
              on: Sequence[str] = ("step",)) -> DataFrame:
    """At most ``n`` rows per key, chosen by the MD5 of the seed and the columns ``on``: the
    same rows in every run, for every partitioning and on any engine."""
    spot = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in on]))
    return take_per_group(df, part, [spot, *on], n)
