"""Telemetry-shaped views over the given tables, for Spark and for the oracle.

Each view exists twice: a function returning a DataFrame and a SQL text for the
oracle's ``WITH`` clause.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.operators.windows import raw_rul, session_ids
from vanewright.plans.lineage import checkpoint_dir
from vanewright.plans.sizing import spread
from vanewright.session import configure


@dataclass(frozen=True)
class Entry:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the session's shared storage."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


SENSORS = ["s1", "s2", "s3", "s4"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
STATS = {"s1": (25.0, 14.0), "s2": (38000.0, 23000.0), "s3": (0.05, 0.03), "s4": (0.04, 0.025)}


def telemetry(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat(F.lit("DS0"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("dataset"),
        F.when(F.col("l_suppkey") % 5 == 0, "test").otherwise("dev").alias("split"),
        F.col("l_suppkey").alias("unit"), (F.year("l_shipdate") - 1994).alias("cycle"),
        *ORDER, F.col("l_quantity").alias("s1"), F.col("l_extendedprice").alias("s2"),
        F.col("l_discount").alias("s3"), F.col("l_tax").alias("s4"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .otherwise(3).alias("fc"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("hs"))


def telemetry_rul(spark: SparkSession, d: str) -> DataFrame:
    return raw_rul(telemetry(spark, d))


def packets(spark: SparkSession, d: str) -> DataFrame:
    return packets_of(table(spark, d, "events"))


def packets_of(ev: DataFrame) -> DataFrame:
    day = F.dayofmonth("ts")
    return ev.select(
        "event_id", F.col("user_id").alias("unit"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        day.alias("cycle"), ((day - 1) % 10 + 1).alias("cycle10"), F.col("value").alias("s1"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("s2"),
        F.col("event_type").alias("node"))


PACKET_ORDER = ["timestamp_ms", "event_id"]


def scores(spark: SparkSession, d: str) -> DataFrame:
    """Packets with a stand-in score, in the columns of the scored table."""
    return packets(spark, d).select(
        "unit", "cycle", "timestamp_ms", "event_id", F.col("s1").alias("predicted_rul"),
        (F.col("s2") / 10).alias("predicted_std"), (F.lit(31) - F.col("cycle")).alias("true_rul"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return session_ids(packets(spark, d).withColumn("cycle", F.col("cycle10")).drop("cycle10"),
                       PACKET_ORDER)


def metric_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("tag"), F.col("o_orderkey").alias("step"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double").alias("wall_time"),
        F.col("o_totalprice").alias("value"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("split"), F.col("l_suppkey").alias("unit"),
        F.col("l_quantity").alias("y_true"),
        (F.col("l_quantity") + (F.col("l_discount") - 0.05) * 100).alias("y_pred"),
        (1 + F.col("l_tax") * 10).alias("y_std"))


SUFFIXES = [".safetensors", ".pt", ".parquet", ".log", ".sig", ".cert", ".json", ".csv", ".bin"]


def artifacts(spark: SparkSession, d: str) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]),
                          (F.col("p_size") % 9 + 1).cast("int"))
    return table(spark, d, "part").select(
        F.concat(F.lit("runs/r"), (F.col("p_size") % 3).cast("string"), F.lit("/f"),
                 F.col("p_partkey").cast("string"), suffix).alias("path"),
        F.col("p_partkey").alias("mtime_s"), F.col("p_size").alias("length"))


def documents_with(spark: SparkSession, d: str, style: str) -> DataFrame:
    """Documents with a heading mark on every third line."""
    def mark(line, i):
        head = (F.concat(F.repeat(F.lit("#"), F.floor(i / 3).cast("int") % 6 + 1), F.lit(" "), line)
                if style == "headers"
                else F.concat(F.lit("Article "), i.cast("string"), F.lit(" "), line))
        return F.when(i % 3 == 0, head).otherwise(line)
    lines = F.transform(F.split("text", "\n"), mark)
    return spread(table(spark, d, "documents")).select("doc_id", "source",
                                               F.array_join(lines, "\n").alias("text"))


TELEMETRY = """
telemetry AS (
  SELECT concat('DS0', cast(l_suppkey % 3 + 1 AS varchar)) AS dataset,
         CASE WHEN l_suppkey % 5 = 0 THEN 'test' ELSE 'dev' END AS split,
         l_suppkey AS unit, cast(year(l_shipdate) - 1994 AS integer) AS cycle,
         l_shipdate, l_orderkey, l_linenumber, l_partkey,
         l_quantity AS s1, l_extendedprice AS s2, l_discount AS s3, l_tax AS s4,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS fc,
         CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS hs,
         cast(max(year(l_shipdate) - 1994) OVER (PARTITION BY l_suppkey)
              - (year(l_shipdate) - 1994) AS integer) AS rul
  FROM lineitem)"""

LONG_TELEMETRY = TELEMETRY + """,
long_telemetry AS (
  SELECT dataset, split, unit, cycle, 's1' AS feature, s1 AS v FROM telemetry UNION ALL
  SELECT dataset, split, unit, cycle, 's2', s2 FROM telemetry UNION ALL
  SELECT dataset, split, unit, cycle, 's3', s3 FROM telemetry UNION ALL
  SELECT dataset, split, unit, cycle, 's4', s4 FROM telemetry)"""

PACKETS = """
packets AS (
  SELECT event_id, user_id AS unit, epoch_us(ts) // 1000 AS timestamp_ms,
         cast(day(ts) AS integer) AS cycle, cast((day(ts) - 1) % 10 + 1 AS integer) AS cycle10,
         value AS s1, cast(regexp_extract(props, '([0-9]+)', 1) AS double) AS s2,
         event_type AS node
  FROM events)"""

SCORES = PACKETS + """,
scores AS (
  SELECT unit, cycle, timestamp_ms, event_id, s1 AS predicted_rul, s2 / 10 AS predicted_std,
         31 - cycle AS true_rul
  FROM packets)"""

SESSIONS = PACKETS + """,
flagged AS (
  SELECT event_id, unit, timestamp_ms, cycle10 AS cycle, s1, s2,
         CASE WHEN cycle10 < lag(cycle10) OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id)
              THEN 1 ELSE 0 END AS fell
  FROM packets),
sessions AS (
  SELECT event_id, unit, timestamp_ms, cycle, s1, s2,
         cast(sum(fell) OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id) AS bigint)
           AS session_id
  FROM flagged)"""

METRIC_LOG = """
metric_log AS (
  SELECT o_orderpriority AS tag, o_orderkey AS step,
         cast(epoch_us(o_orderdate) // 1000000 AS double) AS wall_time, o_totalprice AS value
  FROM orders)"""

PREDICTIONS = """
predictions AS (
  SELECT l_returnflag AS split, l_suppkey AS unit, l_quantity AS y_true,
         l_quantity + (l_discount - 0.05) * 100 AS y_pred, 1 + l_tax * 10 AS y_std
  FROM lineitem)"""

ARTIFACTS = """
artifacts AS (
  SELECT concat('runs/r', cast(p_size % 3 AS varchar), '/f', cast(p_partkey AS varchar),
           CASE p_size % 9 WHEN 0 THEN '.safetensors' WHEN 1 THEN '.pt' WHEN 2 THEN '.parquet'
                WHEN 3 THEN '.log' WHEN 4 THEN '.sig' WHEN 5 THEN '.cert' WHEN 6 THEN '.json'
                WHEN 7 THEN '.csv' ELSE '.bin' END) AS path,
         p_partkey AS mtime_s, p_size AS length
  FROM part)"""

_LINES = """
doc_lines AS (
  SELECT doc_id, source, pos, CASE WHEN pos % 3 = 0 THEN {mark} ELSE raw END AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents))"""
HEADER_LINES = _LINES.format(mark="concat(repeat('#', cast(1 + (pos // 3) % 6 AS integer)), ' ', raw)")
ARTICLE_LINES = _LINES.format(mark="concat('Article ', cast(pos AS varchar), ' ', raw)")


def oracle(select: str, *views: str) -> str:
    return ("WITH " + ",".join(dict.fromkeys(views)) + "\n" if views else "") + select
