"""Scoring windows with a user model, vectorised over Arrow batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.functions.scalars import field_of, positive_head
from vanewright.plans.ordered import dense_index

# A scorer maps (batch, steps, features) to (batch, 2): mean and uncertainty.
Scorer = Callable[[np.ndarray], np.ndarray]


def _tensor(batch: pa.RecordBatch, col: str, steps: int, features: Sequence[str]) -> np.ndarray:
    """Window column (list<struct<features>>) as a (rows, steps, features) array."""
    rows = batch.column(col).flatten()
    planes = [np.asarray(rows.field(f).to_numpy(zero_copy_only=False), dtype=float)
              for f in features]
    return np.stack(planes, axis=-1).reshape(-1, steps, len(features))


def score_windows(df: DataFrame, scorer: Scorer, features: Sequence[str], size: int = 30,
                  window: str = "window", chunk: int = 1024) -> DataFrame:
    """Replace the window by ``predicted_rul``, ``predicted_std`` and the mean
    latency per window of its chunk in ``inference_latency_ms``."""
    kept = [c for c in df.columns if c != window]
    schema = df.select(*kept).schema
    for name in ("predicted_rul", "predicted_std", "inference_latency_ms"):
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, chunk):
                batch = whole.slice(start, chunk)
                began = time.perf_counter()
                y = scorer(_tensor(batch, window, size, features))
                each = (time.perf_counter() - began) * 1000 / max(1, batch.num_rows)
                cols = [batch.column(c) for c in kept]
                cols += [pa.array(y[:, 0], pa.float64()), pa.array(y[:, 1], pa.float64()),
                         pa.array(np.full(batch.num_rows, each))]
                yield pa.RecordBatch.from_arrays(
                    cols, names=[*kept, "predicted_rul", "predicted_std", "inference_latency_ms"])
    return df.mapInArrow(run, schema)


def score_series(df: DataFrame, scorer: Scorer, features: Sequence[str], order: Sequence[str], size: int = 30,
                 keys: Sequence[str] = ("unit",), block: int = 4096, chunk: int = 1024) -> DataFrame:
    """``sliding_windows`` and ``score_windows`` in one: rows that end a full window, with its scores.

    A row is sent to Python once, in a block of consecutive rows of its group, and the last ``size - 1`` rows
    of a block once more with the next; the windows are a view of the block's values, not copies.
    """
    if block < size:
        raise ValueError("a block has to hold a window")
    kept = df.columns
    schema = df.select("*").schema
    for name in ("predicted_rul", "predicted_std", "inference_latency_ms"):
        schema = schema.add(name, "double")
    own = F.floor(F.col("__i") / block).cast("long")
    placed = dense_index(df, keys, order, "__i")
    homes = F.when(F.col("__i") % block >= block - (size - 1), F.array(own, own + 1)).otherwise(F.array(own))
    rows = placed.withColumn("__home", F.explode(homes))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("__i").combine_chunks()
        at = table.column("__i").to_numpy()
        values = np.stack([table.column(f).to_numpy().astype(float) for f in features], axis=1)
        ends = np.flatnonzero(at // block == table.column("__home")[0].as_py())
        ends = ends[ends >= size - 1]
        y, each = np.zeros((len(ends), 2)), np.zeros(len(ends))
        if len(ends):
            windows = np.lib.stride_tricks.sliding_window_view(values, size, axis=0).transpose(0, 2, 1)
            for lo in range(0, len(ends), chunk):
                some = slice(lo, min(lo + chunk, len(ends)))
                began = time.perf_counter()
                y[some] = scorer(windows[ends[some] - (size - 1)])
                each[some] = (time.perf_counter() - began) * 1000 / (some.stop - lo)
        out = table.select(kept).take(pa.array(ends))
        for name, values in (("predicted_rul", y[:, 0]), ("predicted_std", y[:, 1]), ("inference_latency_ms", each)):
            out = out.append_column(name, pa.array(values))
        return out

    return rows.groupBy(*keys, "__home").applyInArrow(run, schema)


def linear_score(df: DataFrame, weights: dict[str, float], bias: float = 0.0,
                 std_bias: float = 0.0, window: str = "window") -> DataFrame:
    """A scorer that stays on the JVM side: weighted sum of the window means
    through the positive head, and the head of a constant as uncertainty."""
    total = F.lit(bias)
    for f, w in weights.items():
        mean = F.aggregate(field_of(window, f), F.lit(0.0),
                           lambda a, x: a + x) / F.size(window)
        total = total + mean * w
    return df.withColumns({"predicted_rul": positive_head(total),
                           "predicted_std": positive_head(F.lit(std_bias))}).drop(window)
