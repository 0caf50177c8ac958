"""Order-dependent operators that survive a group larger than a task.

A plain ``Window.partitionBy(unit)`` puts a whole unit in one task.  Units that
are too big (see ``sizing.hot_groups``) are cut into blocks that are contiguous
in the order, at tuple cut points taken from a hash sample.  Positions and
running sums are computed per block and shifted by the totals of the earlier
blocks - a table with one row per block.  Bounded frames are computed per block
with the preceding rows of the frame copied in as a halo.

``order`` is a list of column names, ascending, that orders a group totally.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from vanewright.plans.sizing import SizePolicy, same_keys, split_by_heat

SAMPLES_PER_BLOCK = 64


def _ordered(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*order)


def _cut_points(big: DataFrame, hot: DataFrame, keys: Sequence[str],
                order: Sequence[str]) -> tuple[DataFrame, int]:
    """Sorted cut tuples per hot group, and the longest list's length.

    The sample is chosen by a hash of the order tuple, so it is the same in
    every evaluation; its size is about 64 rows per block.
    """
    policy = SizePolicy.of(big.sparkSession)
    totals = hot.agg(F.sum("__n").alias("n")).first()["n"]
    rows_per_block = max(policy.hot_rows, totals // policy.max_blocks)
    every = max(1, rows_per_block // SAMPLES_PER_BLOCK)
    sample = (big.select(*keys, F.struct(*order).alias("__at"))
                 .where(F.pmod(F.xxhash64("__at"), F.lit(every)) == 0)
                 .withColumn("__r", F.row_number().over(_ordered(keys, ["__at"]))))
    stride = max(1, rows_per_block // every)
    cuts = (sample.where(F.col("__r") % stride == 0)
                  .groupBy(*keys)
                  .agg(F.sort_array(F.collect_set("__at")).alias("__cuts")))
    table = cuts.toArrow()
    longest = max((len(x) for x in table.column("__cuts").to_pylist()), default=0)
    return big.sparkSession.createDataFrame(table, schema=cuts.schema), longest


def _with_blocks(big: DataFrame, hot: DataFrame, keys: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """Add ``__blk``, the number of cut points at or before the row."""
    cuts, longest = _cut_points(big, hot, keys, order)
    joined = (big.join(F.broadcast(cuts), same_keys(big, cuts, keys), "left")
                 .select(*[big[c] for c in big.columns], cuts["__cuts"]))
    steps = [1 << b for b in range(longest.bit_length() - 1, -1, -1)] or [1]
    at = F.struct(*order)
    # Binary search: take each power of two that still stays at or before `at`.
    block = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda pos, step: F.when(F.get("__cuts", pos + step - 1) <= at, pos + step)
                           .otherwise(pos))
    return joined.withColumn("__blk", block).drop("__cuts")


def _block_offsets(blocked: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """Per block: sum of ``amount`` in earlier blocks, and the group's total."""
    sums = blocked.groupBy(*keys, "__blk").agg(amount.alias("__part"))
    before = W.partitionBy(*keys).orderBy("__blk").rowsBetween(W.unboundedPreceding, -1)
    return sums.select(
        *keys, "__blk",
        F.coalesce(F.sum("__part").over(before), F.lit(0)).alias("__before"),
        F.sum("__part").over(W.partitionBy(*keys)).alias("__total"))


def _join_offsets(df: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    # One row per block: about twice max_blocks rows by construction.
    on = same_keys(df, offsets, [*keys, "__blk"])
    return (df.join(F.broadcast(offsets), on, "inner")
              .select(*[df[c] for c in df.columns],
                      offsets["__before"], offsets["__total"]))


def dense_index(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                name: str = "row_idx", total: str | None = None, small: bool = False) -> DataFrame:
    """Zero-based position of each row in its group; optionally the group size.  ``small`` as in ``split_by_heat``."""

    def plain(part: DataFrame) -> DataFrame:
        spec = _ordered(keys, order)
        out = part.withColumn(name, (F.row_number().over(spec) - 1).cast("long"))
        if total:
            out = out.withColumn(total, F.count(F.lit(1)).over(W.partitionBy(*keys)))
        return out

    def hot(big: DataFrame, table: DataFrame) -> DataFrame:
        blocked = _with_blocks(big, table, keys, order)
        offsets = _block_offsets(blocked, keys, F.count(F.lit(1)))
        spec = _ordered([*keys, "__blk"], order)
        local = blocked.withColumn("__pos", F.row_number().over(spec) - 1)
        out = _join_offsets(local, offsets, keys).withColumn(
            name, (F.col("__before") + F.col("__pos")).cast("long"))
        if total:
            out = out.withColumn(total, F.col("__total").cast("long"))
        return out.drop("__blk", "__pos", "__before", "__total")

    return split_by_heat(df, keys, plain, hot, small)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: str, name: str, total: str | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in order; optionally the group total."""

    def plain(part: DataFrame) -> DataFrame:
        spec = _ordered(keys, order).rowsBetween(W.unboundedPreceding, 0)
        out = part.withColumn(name, F.sum(value).over(spec))
        if total:
            out = out.withColumn(total, F.sum(value).over(W.partitionBy(*keys)))
        return out

    def hot(big: DataFrame, table: DataFrame) -> DataFrame:
        blocked = _with_blocks(big, table, keys, order)
        offsets = _block_offsets(blocked, keys, F.sum(value))
        spec = _ordered([*keys, "__blk"], order).rowsBetween(W.unboundedPreceding, 0)
        local = blocked.withColumn("__pos", F.sum(value).over(spec))
        out = _join_offsets(local, offsets, keys).withColumn(
            name, F.col("__before") + F.col("__pos"))
        if total:
            out = out.withColumn(total, F.col("__total"))
        return out.drop("__blk", "__pos", "__before", "__total")

    return split_by_heat(df, keys, plain, hot)


def framed(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int,
           exprs: Callable[[WindowSpec], dict[str, Column]], small: bool = False) -> DataFrame:
    """Add window expressions that look back at most ``before`` rows.

    ``exprs`` receives the ordered window (no frame set) and returns the new
    columns.  For a hot group each block of consecutive positions receives a
    copy of the ``before`` rows ahead of it.  ``small`` as in ``split_by_heat``.
    """

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumns(exprs(_ordered(keys, order)))

    def hot(big: DataFrame, table: DataFrame) -> DataFrame:
        policy = SizePolicy.of(big.sparkSession)
        width = max(policy.hot_rows, before)
        cols = big.columns
        placed = dense_index(big, keys, order, "__i")
        own = F.floor(F.col("__i") / width).cast("long")
        near_end = (F.col("__i") % width) >= (width - before)
        homes = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
        spread = placed.withColumn("__home", F.explode(homes))
        out = spread.withColumns(exprs(_ordered([*keys, "__home"], ["__i"])))
        return (out.where(F.floor(F.col("__i") / width) == F.col("__home"))
                   .select(*cols, *[c for c in out.columns if c not in spread.columns]))

    return split_by_heat(df, keys, plain, hot, small)


def take_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  Up to Spark's limit for it
    (``spark.sql.optimizer.windowGroupLimitThreshold``, 1,000 by default) the rank filter
    prunes to ``n`` rows per group in every map task before the shuffle, so a hot key
    costs nothing; beyond it all rows of the group are shuffled."""
    name = rank or "__rank"
    out = (df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
             .where(F.col(name) <= n))
    return out if rank else out.drop(name)
