"""Packet codec and packet streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.streaming import StreamingQuery

from vanewright.functions.scalars import safe_int
from vanewright.schemas import FEATURES, packet_schema
from vanewright.sources import packet_log

WIRE_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                            T.StructField("value", T.StringType())])


def packet_stream(spark: SparkSession, fmt: str = packet_log.FORMAT,
                  options: Mapping[str, str] | None = None,
                  schema: T.StructType | None = None, path: str | None = None) -> DataFrame:
    """Streaming ``(key, value)`` packets, from the earliest retained one.

    A packet log takes its folder; with Kafka the topic comes from ``options``; file formats
    take a schema and a path.
    """
    reader = spark.readStream.format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        raw = reader.option("startingOffsets", "earliest").load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if fmt == packet_log.FORMAT:
        packet_log.register(spark)
        return reader.load(path) if path else reader.load()
    return reader.schema(schema or WIRE_SCHEMA).load(path)


def _parsed(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumn("__p", F.from_json("value", packet_schema(features),
                                            {"mode": "PERMISSIVE"}))


def _well_formed() -> Column:
    return (F.col("__p").isNotNull() & safe_int(F.col("__p.unit")).isNotNull()
            & safe_int(F.col("__p.cycle")).isNotNull() & F.col("__p.timestamp_ms").isNotNull())


def decode_packets(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """JSON packets to columns.  A missing sensor reads 0, a missing label 0.0
    (either spelling is accepted); packets without ids or stamp are skipped."""
    p = F.col("__p")
    return _parsed(df, features).where(_well_formed()).select(
        safe_int(p["unit"]).alias("unit"), safe_int(p["cycle"]).alias("cycle"),
        p["timestamp_ms"].alias("timestamp_ms"),
        F.coalesce(p["rul"], F.get_json_object("value", "$.RUL").try_cast("double"),
                   F.lit(0.0)).alias("true_rul"),
        *[F.coalesce(p[f], F.lit(0.0)).alias(f) for f in features])


def dead_letters(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The packets ``decode_packets`` skips, unchanged."""
    return _parsed(df, features).where(~F.coalesce(_well_formed(), F.lit(False))).drop("__p")


def encode_packets(df: DataFrame, timestamp_ms: Column | str, unit: str = "unit") -> DataFrame:
    """Rows to bus messages: key is the unit, value the row as JSON plus a stamp."""
    stamp = F.col(timestamp_ms) if isinstance(timestamp_ms, str) else timestamp_ms
    body = [F.col(c) for c in df.columns if c != "timestamp_ms"]
    return df.select(F.col(unit).cast("string").alias("key"),
                     F.to_json(F.struct(*body, stamp.alias("timestamp_ms"))).alias("value"))


def send_packets(messages: DataFrame, fmt: str = packet_log.FORMAT, options: Mapping[str, str] | None = None) -> None:
    """Append messages to a bus.  For a packet log they are dealt by key first, so that the
    packets of a key are in one segment."""
    if fmt == packet_log.FORMAT:
        packet_log.register(messages.sparkSession)
        messages = messages.select("key", "value").repartition("key")
    messages.write.format(fmt).options(**dict(options or {})).mode("append").save()


def send_stream(messages: DataFrame, path: str, checkpoint: str, writer: str, trigger: Mapping | None = None,
                options: Mapping[str, str] | None = None) -> StreamingQuery:
    """A stream of messages into a packet log, each once whatever is repeated."""
    packet_log.register(messages.sparkSession)
    return (messages.select("key", "value").writeStream.format(packet_log.FORMAT)
            .options(path=path, writer=writer, checkpointLocation=checkpoint, **dict(options or {}))
            .trigger(**dict(trigger or {"availableNow": True})).start())
