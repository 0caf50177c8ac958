"""Training-data preparation: fleet selection, splits, scaling, window sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vanewright.functions.scalars import extract_key, flatten_window
from vanewright.operators.project import stats_map, zscore
from vanewright.operators.scaling import moments, pool_moments
from vanewright.operators.windows import moving_average, stride_sample, training_windows
from vanewright.plans.sizing import lookup_join, pinned
from vanewright.schemas import REPLAY_FLEET
from vanewright.sources.sinks import write_splits


@dataclass(frozen=True)
class PrepConfig:
    features: Sequence[str]
    order: Sequence[str]
    val_fraction: float = 0.1
    seed: int | None = 0          # None: highest unit ids first
    pooled: str = "within"
    smooth: bool = False
    win_length: int = 30
    win_step: int = 10
    skip_obs: int = 10
    label: str = "rul"
    window_keys: Sequence[str] = field(default_factory=lambda: ["dataset", "split", "unit"])


def fleet_sample(df: DataFrame, order: Sequence[str],
                 config: Mapping[int, int] = REPLAY_FLEET) -> DataFrame:
    """Strided sample of the configured units, points per cycle by unit.  The
    unit filter reaches the scan; the configuration is a literal table."""
    points = F.create_map(*[F.lit(x) for kv in config.items() for x in kv])
    chosen = df.where(F.col("unit").isin(*config)) \
               .withColumn("__k", F.try_element_at(points, F.col("unit").cast("int")))
    return stride_sample(chosen, order, "__k").drop("__k")


def choose_validation_units(df: DataFrame, fraction: float = 0.1, seed: int | None = 0,
                            unit: str = "unit") -> DataFrame:
    """Units in hash order (or by descending id) as long as their rows stay
    within the fraction; at least one.

    """
    counts = df.groupBy(unit).agg(F.count(F.lit(1)).alias("rows"))
    return choose_by_count(counts, fraction, seed, unit)


def choose_by_count(counts: DataFrame, fraction: float, seed: int | None,
                    unit: str = "unit") -> DataFrame:
    """The choice from a table of rows per unit.

    Units are ordered in pieces: summed per range of the order first, then inside
    a range.
    """
    if seed is None:
        spot = -F.col(unit).cast("long")
    else:
        spot = F.xxhash64(F.lit(seed), F.col(unit))
    placed = counts.withColumn("__at", spot) \
                   .withColumn("__range", F.shiftright("__at", 52) if seed is not None
                               else F.floor(F.col("__at") / 4096))
    ranges = placed.groupBy("__range").agg(F.sum("rows").alias("__sum"))
    one = F.lit(1)
    upto = W.partitionBy(one).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(
        "__range", F.coalesce(F.sum("__sum").over(upto), F.lit(0)).alias("__before"),
        F.sum("__sum").over(W.partitionBy(one)).alias("__total"))
    inside = W.partitionBy("__range").orderBy("__at", unit).rowsBetween(W.unboundedPreceding, 0)
    ranked = lookup_join(placed.withColumn("__here", F.sum("rows").over(inside)), ranges,
                         ["__range"], probe=False)
    running = F.col("__before") + F.col("__here")
    keep = (running <= F.col("__total") * fraction) | (running == F.col("rows"))
    return ranked.where(keep).select(unit, "rows")


def extract_splits(df: DataFrame, val_units: DataFrame, split: str = "split", test: str = "test",
                   unit: str = "unit", name: str = "part") -> DataFrame:
    """Tag rows as test (by their split), val (chosen units) or train."""
    chosen = val_units.select(unit).distinct().withColumn("__val", F.lit(True))
    tagged = lookup_join(df, chosen, [unit], "left")
    part = (F.when(F.col(split) == test, "test").when(F.col("__val"), "val").otherwise("train"))
    return tagged.withColumn(name, part).drop("__val")


def prepare(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Splits, scalers of the train rows only, optional smoothing, z-scores.

    Two scans.  The first reduces the rows to moments per unit, from which both
    the validation units and, without them, the scalers follow; the second is
    the rows themselves.  The scalers are one row per feature and enter the plan
    as literals.
    """
    dev = df.where(F.col("split") != "test")
    parts = pinned(moments(dev, cfg.features, ["dataset", "unit"]))
    counts = (parts.where(F.col("feature") == cfg.features[0])
                   .groupBy("unit").agg(F.sum("rows").alias("rows")))
    val_units = pinned(choose_by_count(counts, cfg.val_fraction, cfg.seed))
    # Null-safe: a null unit that is chosen for validation has no part in the scalers.
    train = lookup_join(parts, val_units.select("unit"), ["unit"], "left_anti", probe=True)
    stats = stats_map(pool_moments(train, pooled=cfg.pooled))
    tagged = extract_splits(df, val_units)
    rows = tagged.drop("split").withColumnRenamed("part", "split")
    if cfg.smooth:
        rows = moving_average(rows, cfg.features, cfg.order)
    return zscore(rows, stats, cfg.features)


def prepare_to(df: DataFrame, cfg: PrepConfig, path: str) -> DataFrame:
    """``prepare`` written as (dataset, split) partitions and read back."""
    write_splits(prepare(df, cfg), path)
    return df.sparkSession.read.parquet(path)


def window_dataset(prepared: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Feature-major flat windows with their label."""
    windows = training_windows(prepared, cfg.features, cfg.order, cfg.win_length, cfg.win_step,
                               cfg.skip_obs, cfg.label, cfg.window_keys)
    return windows.select(*cfg.window_keys, "window_start",
                          flatten_window("window", cfg.features).alias("values"), "label")


def window_counts(windows: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    return windows.groupBy(*by).agg(F.count(F.lit(1)).alias("nb_lines"))


# Patterns of the run parameters.
RUN_PATTERNS = {
    "prior_scale": r"prior_scale:\s*([\d\.]+)", "q_scale": r"q_scale:\s*([\d\.]+)",
    "dataset_size": r"dataset_size:\s*(\d+)", "model_name": r"model_name:\s*([\w-]+)",
    "pretrain_file": r"pretrain_file:\s*(.*)"}


def compare_runs(runs: DataFrame, run: str = "run", text: str = "text",
                 patterns: Mapping[str, str] = RUN_PATTERNS) -> DataFrame:
    """One row per run parameter: its value in each run as (run, value) rows."""
    pairs = F.array(*[F.struct(F.lit(k).alias("parameter"), extract_key(text, p).alias("value"))
                      for k, p in patterns.items()])
    return runs.select(run, F.inline(pairs))


def runs_side_by_side(runs: DataFrame, names: Sequence[str], run: str = "run",
                      text: str = "text", patterns: Mapping[str, str] = RUN_PATTERNS) -> DataFrame:
    """Parameters as rows, the given runs as columns."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col(run) == name, F.col("value"))).alias(name)
    return (compare_runs(runs.where(F.col(run).isin(*names)), run, text, patterns)
            .groupBy("parameter").agg(*[of(n) for n in names]))
