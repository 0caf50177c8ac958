"""Reading the given tables, and size checks of what is broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.plans.lineage import checkpoint_dir

#: Most bytes that a side may have to be broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``held``, for wide rows: compressed, and read by column."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """A materialised side with a broadcast hint if its counted rows, at most
    ``row_bytes`` each, stay below the limit; else unchanged."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
