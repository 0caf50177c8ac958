"""Session defaults the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch is bounded in rows by default, which says nothing of its size where a row is a page.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

STATE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes; cluster sizing
    (executors, shuffle partitions, checkpoint folder) stays the caller's."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    return spark


def build_session(app: str = "vanewright", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
