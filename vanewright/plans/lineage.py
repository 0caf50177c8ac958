"""Cutting the lineage of iterative jobs on reliable storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a session that runs in
    this process alone gets its own if it names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="vanewright-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise on the checkpoint folder, so a lost executor costs no replay."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
