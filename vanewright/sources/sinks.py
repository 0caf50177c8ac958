"""Sinks and table maintenance on plain parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join, split_by_heat
from vanewright.schemas import FEATURES, conform, fleet_schema


def create_fleet_table(spark: SparkSession, path: str, features: Sequence[str] = FEATURES) -> None:
    """Write an empty table with the fixed schema."""
    spark.createDataFrame([], fleet_schema(features)).write.mode("overwrite").parquet(path)


def append_scores(df: DataFrame, path: str, features: Sequence[str] = FEATURES) -> None:
    conform(df, fleet_schema(features)).write.mode("append").parquet(path)


def upsert_latest(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str]) -> DataFrame:
    """Union of both, one row per key: the latest by ``order_by``; between equal
    rows the new one wins."""
    both = (existing.withColumn("__new", F.lit(0))
                    .unionByName(new.withColumn("__new", F.lit(1))))
    newest = [F.desc(c) for c in [*order_by, "__new"]]
    return take_per_group(both, keys, newest, 1).drop("__new")


def drop_stale_sessions(df: DataFrame, unit: str = "unit", session: str = "session_id") -> DataFrame:
    """Rows of each unit's last session."""

    def plain(part: DataFrame) -> DataFrame:
        # Session ids come out of a window on the unit, so this one is free.
        last = F.max(session).over(W.partitionBy(unit))
        return (part.withColumn("__last", last)
                    .where(F.col(session) == F.col("__last")).drop("__last"))

    def hot(big: DataFrame, _: DataFrame) -> DataFrame:
        last = big.groupBy(unit).agg(F.max(session).alias(session))
        return lookup_join(big, last, [unit, session], "left_semi")

    return split_by_heat(df, [unit], plain, hot)


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy("dataset", "split").parquet(path)


def write_fragments(chunks: DataFrame, path: str) -> None:
    """One JSON document per line."""
    chunks.write.mode("overwrite").json(path)


def stage_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished stage output is present."""
    jvm = spark._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def materialize(df: DataFrame, path: str, reuse: bool = True) -> DataFrame:
    """Write a stage once and read it back; a finished output is reused."""
    spark = df.sparkSession
    if not (reuse and stage_exists(spark, path)):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_files_only(src: DataFrame, dst: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose keys the destination does not hold yet; null keys match each other."""
    return lookup_join(src, dst.select(*keys), list(keys), "left_anti")
