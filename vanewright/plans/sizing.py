"""Size checks: what may be broadcast, and which groups are too big for one task.

Nothing here changes a result.  The checks only choose between a plan for
groups that are known to fit a task and a plan that splits them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.plans.lineage import cut

CONF_PREFIX = "spark.vanewright."


@dataclass(frozen=True)
class SizePolicy:
    """Limits, each overridable as ``spark.vanewright.<name>`` in the session."""

    # An input Catalyst estimates below this fits one task whatever its keys are.
    small_bytes: int = 256 << 20
    # Rows one window task may own before its group is split into blocks.
    hot_rows: int = 4_000_000
    # Most groups treated as hot, the largest; 0: all above hot_rows.
    max_hot: int = 0
    # Blocks that the hot groups are cut into, about; blocks of a very large input get
    # longer, so that the table of their cut points stays this small.
    max_blocks: int = 20_000
    # Upper bounds of a broadcast side.
    broadcast_bytes: int = 32 << 20
    broadcast_rows: int = 200_000

    @classmethod
    def of(cls, spark: SparkSession) -> "SizePolicy":
        found = {}
        for f in fields(cls):
            value = spark.conf.get(CONF_PREFIX + f.name, None)
            if value is not None:
                found[f.name] = int(value)
        return cls(**found)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan, None if unavailable."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except (AttributeError, TypeError, ValueError):
        return None


def is_small(df: DataFrame, limit: int) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of few splits, such as one file with one row
    group.  Only for small inputs; a large one has enough splits and is left as
    it is."""
    if not is_small(df, SizePolicy.of(df.sparkSession).small_bytes):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def pinned(df: DataFrame) -> DataFrame:
    """A table that several later steps read, computed once: held by the driver
    if it is small enough, otherwise checkpointed."""
    copy = bounded_copy(df, SizePolicy.of(df.sparkSession).broadcast_rows)
    return copy if copy is not None else cut(df)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the key columns of two sides."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def bounded_copy(df: DataFrame, max_rows: int) -> DataFrame | None:
    """A driver-held copy of ``df`` when it has at most ``max_rows`` rows and its
    values at most ``broadcast_bytes`` bytes.

    Reads no more rows than fit that size by the widths of the column types, so the
    driver is safe even if the guess is wrong; None then tells the caller to take its
    shuffle plan.
    """
    most = SizePolicy.of(df.sparkSession).broadcast_bytes or (32 << 20)
    width = max(8, df._jdf.schema().defaultSize())
    rows = max(1, min(max_rows, most // width))
    table = df.limit(rows + 1).toArrow()
    if table.num_rows > rows or table.nbytes > most:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def checked_broadcast(df: DataFrame, probe: bool = True) -> DataFrame:
    """``df`` with a broadcast hint if a bounded read has shown its size, otherwise
    unchanged.  An estimate alone proves nothing: it counts compressed bytes."""
    policy = SizePolicy.of(df.sparkSession)
    if probe and policy.broadcast_bytes:
        copy = bounded_copy(df, policy.broadcast_rows)
        if copy is not None:
            return F.broadcast(copy)
    return df


def lookup_join(facts: DataFrame, side: DataFrame, keys: Sequence[str],
                how: str = "inner", probe: bool = False) -> DataFrame:
    """Join facts to a one-row-per-key side; null keys match each other.

    Without a probe nothing runs while the plan is built: adaptive execution turns
    the join into a broadcast once it has measured the side, or splits a hot key of
    the facts (the side has one row per key, so the copies it makes of it are cheap).
    """
    mine = {k: f"__side_{k}" for k in keys}
    rest = [c for c in side.columns if c not in mine]
    named = side.select(*[F.col(k).alias(a) for k, a in mine.items()], *rest)
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(a)) for k, a in mine.items()))
    joined = facts.join(checked_broadcast(named, probe), on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*keys, *[c for c in facts.columns if c not in mine], *rest)


def attach_group(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add per-group aggregates to every row.

    Aggregate-then-join instead of an unbounded window: the aggregate is
    partial before its shuffle and the detail rows stay where they are when
    the group table is small enough to broadcast.
    """
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return lookup_join(df, stats, keys)


def hot_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The groups that hold too many rows for one task, with their row count in
    ``__n``; None when there are none.  There are at most rows / ``hot_rows``."""
    policy = SizePolicy.of(df.sparkSession)
    if is_small(df, policy.small_bytes):
        return None
    top = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") > policy.hot_rows))
    if policy.max_hot:
        top = top.orderBy(F.desc("__n")).limit(policy.max_hot)
    # Held by the driver if its size is bounded, else a table on storage like any other.
    table = bounded_copy(top, policy.broadcast_rows)
    table = cut(top) if table is None else table
    return None if table.isEmpty() else table


def split_by_heat(df: DataFrame, keys: Sequence[str],
                  plain: Callable[[DataFrame], DataFrame],
                  hot: Callable[[DataFrame, DataFrame], DataFrame],
                  small: bool = False) -> DataFrame:
    """Run ``plain`` on groups that fit a task and ``hot`` on those that do not.

    ``small`` says the caller has already shown the whole input to fit: Catalyst's
    estimate multiplies the sides of a join, which hides that a lookup adds no rows.
    """
    table = None if small else hot_groups(df, keys)
    if table is None:
        return plain(df)
    names = table.select(*keys)
    rest = lookup_join(df, names, keys, "left_anti", probe=True)
    big = lookup_join(df, names, keys, "left_semi", probe=True)
    return plain(rest).unionByName(hot(big, table))
