"""Streaming entries (S4, M, K2).  Streams read the event file and run until it
is exhausted; results equal the batch operators."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from vanewright.catalog import views as v
from vanewright.catalog.ordered import WINDOW_FACTS, window_facts
from vanewright.catalog.profiles import r
from vanewright.catalog.views import Entry, oracle
from vanewright.operators import scoring
from vanewright.sources import packets as bus
from vanewright.streaming import pipeline

FEATS = ["s1", "s2"]
DOMAIN = {"s1": (50.0, 47.5), "s2": (40.0, 12.5)}


SLICES = 5
LATE_DAYS = 1
DELAY = f"{LATE_DAYS + 1} days"
BUCKET_MS = 6 * 3_600_000
ROW_GROUP = 4 << 20


def sliced(s, d, late=False):
    """The events in five slices by time.  ``late`` moves every other event of the last day of a slice
    to the next, and adds beats far ahead of all: the first lets the watermark pass the events, the
    second takes the batch in which it has."""
    ev = v.table(s, d, "events")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(at), F.max(at)).first()
    width = (hi - lo) // SLICES + 1
    part = F.floor((at - lo) / width)
    if not late:
        return ev.withColumn("slice", part.cast("int"))
    moved = (F.col("event_id") % 2 == 0) & ((at - lo) % width > width - LATE_DAYS * 86_400_000)
    ev = ev.withColumn("slice", F.least(part + moved.cast("int"), F.lit(SLICES - 1)).cast("int"))
    beat = ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(1)
    beat = beat.withColumns({"ts": F.col("ts") + F.expr("interval 40 days"), "user_id": F.lit(-1).cast(ev.schema["user_id"].dataType)})
    return ev.unionByName(beat.withColumn("slice", F.explode(F.array(F.lit(SLICES), F.lit(SLICES + 1)))))


def events_stream(s, d, late=False):
    """The slices as files of one job, whose times are set so that a stream takes one after another.  A file has small row
    groups, which several tasks read."""
    root = v.scratch(s, "events")
    sliced(s, d, late).repartition("slice").write.option("parquet.block.size", ROW_GROUP).partitionBy("slice").parquet(root)
    path = s._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(s._jsc.hadoopConfiguration())
    now = s._jvm.System.currentTimeMillis()
    for folder in fs.globStatus(s._jvm.org.apache.hadoop.fs.Path(root, "slice=*")):
        number = int(folder.getPath().getName().split("=")[1])
        for file in fs.listStatus(folder.getPath()):
            fs.setTimes(file.getPath(), now - 60_000 + 2_000 * number, -1)
    schema = v.table(s, d, "events").schema
    return s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/slice=*")


def messages(p):
    """(key, value) packets with ten-day cycles; every 97th is broken and every 101st has no stamp."""
    body = [F.struct("unit", F.col("cycle10").alias("cycle"), "s1", "s2", *stamp, (F.lit(31) - F.col("cycle")).alias("rul"))
            for stamp in (["timestamp_ms"], [])]
    return p.select(F.col("unit").cast("string").alias("key"),
                    F.when(F.col("event_id") % 97 == 0, "{broken").when(F.col("event_id") % 101 == 0, F.to_json(body[1]))
                    .otherwise(F.to_json(body[0])).alias("value"))


GOOD = "event_id % 97 <> 0 AND event_id % 101 <> 0"


def message_stream(s, d, late=False):
    return messages(v.packets_of(events_stream(s, d, late)))


def bus_stream(s, d):
    """Messages sent to a packet log in five commits, and decoded by a stream that is stopped and started
    again after the first and the third."""
    root = v.scratch(s, "bus")
    sent = sliced(s, d)
    for i in range(SLICES):
        bus.send_packets(messages(v.packets_of(sent.where(F.col("slice") == i))), options={"path": f"{root}/log"})
        if i in (0, 2, SLICES - 1):
            decoded = bus.decode_packets(bus.packet_stream(s, path=f"{root}/log"), FEATS)
            out = drain_to(s, decoded, root)
    return out


def drain_to(s, stream, root):
    """Run a stream over what is there, into files; return all it has written so far."""
    q = (stream.writeStream.format("parquet").option("path", f"{root}/data")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return s.read.schema(stream.schema).parquet(f"{root}/data")


def drain(s, stream, name):
    return drain_to(s, stream, v.scratch(s, name))


def _session_stream(s, d, late=False):
    p = v.packets_of(events_stream(s, d, late)).withColumn("cycle", F.col("cycle10"))
    return p.select("event_id", "unit", "cycle", "timestamp_ms", "s1", "s2")


def _windows(s, d, **kw):
    out = pipeline.stream_windows(_session_stream(s, d), FEATS, 5, carry=["timestamp_ms", "event_id"], **kw)
    return window_facts(drain(s, out, "windows"), "unit", "session_id", "event_id")


def _watermarked(s, d):
    timed = pipeline.with_watermark(_session_stream(s, d, late=True), DELAY)
    out = pipeline.stream_windows(timed, FEATS, 5, carry=["timestamp_ms", "event_id"], bucket_ms=BUCKET_MS)
    return window_facts(drain(s, out, "late"), "unit", "session_id", "event_id")


STREAM_WINDOWS = f"""SELECT unit, session_id, event_id, first_s1, last_s2, sum_s1 FROM
  (SELECT unit, session_id, event_id, {WINDOW_FACTS} FROM sessions
   WINDOW w AS (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id
                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5"""


def scorer(df):
    renamed = df.withColumn("window", F.transform("window", lambda x: F.struct(
        x["s1_z"].alias("s1"), x["s2_z"].alias("s2"))))
    return scoring.linear_score(renamed, {"s1": 1.5, "s2": -0.5}, 20.0, 0.5)


def _scored_stream(s, d):
    root = v.scratch(s, "scored")
    stream = message_stream(s, d, late=True)
    for q in pipeline.telemetry_pipeline(stream, root, scorer, FEATS, DOMAIN, 5, snapshot_every=2, delay=DELAY, bucket_ms=BUCKET_MS):
        q.awaitTermination()
    out = pipeline.read_scores(s, root)
    return r(out.select("unit", "cycle", "timestamp_ms", "true_rul", "s1", "s2_z", "predicted_rul"), 5,
             "s1", "s2_z", "predicted_rul")


SCORED_SQL = """
good AS (SELECT event_id, cast(unit AS integer) AS unit, cycle10 AS cycle, timestamp_ms,
                cast(31 - cycle AS double) AS true_rul,
                CASE WHEN abs(s1) > 15 THEN s1 ELSE s1 * 47.5 + 50 END AS s1,
                CASE WHEN abs(s1) > 15 THEN (s1 - 50) / 47.5 ELSE s1 END AS s1_z,
                CASE WHEN abs(s2) > 15 THEN (s2 - 40) / 12.5 ELSE s2 END AS s2_z
         FROM packets WHERE event_id % 97 <> 0 AND event_id % 101 <> 0),
fl AS (SELECT *, CASE WHEN cycle < lag(cycle) OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id)
                      THEN 1 ELSE 0 END AS fell FROM good),
se AS (SELECT *, sum(fell) OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id) AS session_id FROM fl),
wi AS (SELECT *, avg(s1_z) OVER w AS z1, avg(s2_z) OVER w AS z2, count(*) OVER w AS n FROM se
       WINDOW w AS (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id ROWS 4 PRECEDING)),
sc AS (SELECT *, 20 + 1.5 * z1 - 0.5 * z2 AS x, max(session_id) OVER (PARTITION BY unit) AS last
       FROM wi WHERE n = 5)"""


def _rejects(s, d):
    """What the scored stream sets aside, broken and without a stamp."""
    out = drain(s, bus.dead_letters(message_stream(s, d), FEATS), "rejected")
    return out.select("key", F.when(F.col("value") == "{broken", F.col("value")).otherwise("no stamp").alias("value"),
                      F.get_json_object("value", "$.s1").cast("double").alias("s1"))


def _live(s, d):
    """Update-mode status: each batch appends the units it touched."""
    root = v.scratch(s, "live")
    p = v.packets_of(events_stream(s, d))
    stream = p.select("unit", "cycle", "timestamp_ms", F.col("s1").alias("predicted_rul"),
                      (F.lit(31) - F.col("cycle")).alias("true_rul"), (F.col("s2") / 10).alias("predicted_std"))

    def keep(batch, batch_id):
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/status"))
    q = (pipeline.live_status(stream).writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    out = pipeline.publish(s.read.parquet(f"{root}/status"), ["unit"], ["batch_id"]).drop("batch_id")
    return r(out, 6, "predicted_rul", "predicted_std", "uncertainty")


def _health(s, d):
    beats = v.packets(s, d).select("node", "timestamp_ms", F.col("s1").alias("latency_ms"))
    now = beats.agg(F.max("timestamp_ms")).first()[0]
    return pipeline.node_health(beats, F.lit(now), 400)


TTL_S = 4


def _liveness(s, d):
    """Every node beats; then all but one go on, until the stream has reported that one OFFLINE.  The last
    status that was emitted of each node."""
    beats = v.packets(s, d).select("node", "timestamp_ms", F.col("s1").alias("latency_ms"))
    last = beats.groupBy("node").agg(F.max("timestamp_ms").alias("timestamp_ms"), F.max_by("latency_ms", "timestamp_ms").alias("latency_ms"))
    last = s.createDataFrame(last.toArrow(), last.schema)  # a row a node
    silent = last.agg(F.min("node")).first()[0]
    inbox, root = v.scratch(s, "beats"), v.scratch(s, "liveness")
    last.coalesce(1).write.parquet(inbox)

    def keep(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(f"{root}/status")

    stream = pipeline.stream_health(s.readStream.schema(last.schema).parquet(inbox), TTL_S)
    q = (stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
         .trigger(processingTime="500 milliseconds").start())
    until = time.time() + 120
    published = None
    while time.time() < until and q.isActive:
        last.where(F.col("node") != silent).coalesce(1).write.mode("append").parquet(inbox)
        time.sleep(1)
        if q.lastProgress and q.lastProgress["batchId"] > 0:
            published = pipeline.publish(s.read.parquet(f"{root}/status"), ["node"], ["batch_id"]).drop("batch_id")
            if published.where((F.col("node") == silent) & (F.col("status") == "OFFLINE")).count():
                break
    q.stop()
    return published


def _no_change(s, d):
    """A stream of packets in three files: those before cycle 15, the same once more, and all.  The
    second brings nothing new, so nothing is emitted for it."""
    p = v.packets(s, d).select("unit", "cycle", F.floor("s1").cast("long").alias("setting"))
    inbox, root = v.scratch(s, "updates"), v.scratch(s, "changes")

    def keep(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id).cast("int")).write.mode("append").parquet(f"{root}/out")

    for part in (p.where("cycle < 15"), p.where("cycle < 15"), p):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = pipeline.stream_changes(s.readStream.schema(p.schema).parquet(inbox), F.col("setting"))
        q = (stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return s.read.parquet(f"{root}/out")


def _changed(s, d):
    p = v.packets(s, d)
    published = p.where("cycle < 30").groupBy("unit").agg(F.max("cycle").alias("max_cycle"))
    return pipeline.changed_units(p, published)


def _append_stream(s, d):
    out = bus.decode_packets(message_stream(s, d), FEATS)
    return drain(s, out, "append").groupBy("unit").agg(F.count(F.lit(1)).alias("rows"),
                                                        F.round(F.sum("s1"), 4).alias("sum_s1"))


ENTRIES = [
    Entry("s4_packet_stream", lambda s, d: bus_stream(s, d).select("unit", "cycle", "timestamp_ms", "s1", "s2"),
          oracle(f"""SELECT cast(unit AS integer) AS unit, cycle10 AS cycle, timestamp_ms, s1, s2 FROM packets
                    WHERE {GOOD}""", v.PACKETS)),
    Entry("k2_streaming_append", _append_stream,
          oracle(f"""SELECT cast(unit AS integer) AS unit, count(*) AS rows, round(sum(s1), 4) AS sum_s1 FROM packets
                    WHERE {GOOD} GROUP BY unit""", v.PACKETS)),
    Entry("m1_stream_windows", lambda s, d: _windows(s, d), oracle(STREAM_WINDOWS, v.SESSIONS)),
    Entry("m2_session_reset_drop_first", lambda s, d: _windows(s, d, compat_drop_first=True),
          oracle(f"""SELECT unit, session_id, event_id, first_s1, last_s2, sum_s1 FROM
                    (SELECT unit, session_id, event_id, {WINDOW_FACTS} FROM
                       (SELECT *, row_number() OVER (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id) AS rn
                        FROM sessions) WHERE session_id = 0 OR rn > 1
                     WINDOW w AS (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id
                                  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""", v.SESSIONS)),
    Entry("m3_scored_stream", _scored_stream,
          oracle("""SELECT unit, cycle, timestamp_ms, true_rul, round(s1, 5) AS s1, round(s2_z, 5) AS s2_z,
                      round(greatest(x, 0.0) + ln(1 + exp(-abs(x))), 5) AS predicted_rul
                    FROM sc WHERE session_id = last""", v.PACKETS, SCORED_SQL)),
    Entry("m4_dead_letters", _rejects,
          oracle(f"""SELECT cast(unit AS varchar) AS key, CASE WHEN event_id % 97 = 0 THEN '{{broken' ELSE 'no stamp' END AS value,
                      CASE WHEN event_id % 97 <> 0 THEN s1 END AS s1 FROM packets WHERE NOT ({GOOD})""", v.PACKETS)),
    Entry("m5_node_health", _health,
          oracle("""SELECT node, last_ms, CASE WHEN online THEN 'ONLINE' ELSE 'OFFLINE' END AS status,
                      CASE WHEN online THEN lat END AS latency_ms
                    FROM (SELECT node, max(timestamp_ms) AS last_ms, arg_max(s1, timestamp_ms) AS lat,
                                 ((SELECT max(timestamp_ms) FROM packets) - max(timestamp_ms)) / 1000 < 400 AS online
                          FROM packets GROUP BY node)""", v.PACKETS)),
    Entry("m5_stream_liveness", _liveness,
          oracle("""SELECT node, max(timestamp_ms) AS last_ms, CASE WHEN node = (SELECT min(node) FROM packets) THEN 'OFFLINE' ELSE 'ONLINE' END AS status,
                      CASE WHEN node <> (SELECT min(node) FROM packets) THEN arg_max(s1, timestamp_ms) END AS latency_ms
                    FROM packets GROUP BY node""", v.PACKETS)),
    Entry("m6_stream_changes", _no_change,
          oracle("""SELECT unit, max_cycle, cast(setting AS varchar) AS parameters, batch FROM
                    (SELECT 0 AS batch, unit, cast(max(cycle) AS bigint) AS max_cycle, max(struct_pack(c := cycle, p := cast(floor(s1) AS bigint)::varchar)).p AS setting
                     FROM packets WHERE cycle < 15 GROUP BY unit
                     UNION ALL SELECT 2, unit, max(cycle), max(struct_pack(c := cycle, p := cast(floor(s1) AS bigint)::varchar)).p
                     FROM packets p GROUP BY unit HAVING max(cycle) IS DISTINCT FROM max(cycle) FILTER (WHERE cycle < 15))""", v.PACKETS)),
    Entry("m6_changed_units", _changed,
          oracle("""SELECT unit, max(cycle) AS max_cycle FROM packets GROUP BY unit
                    HAVING max(cycle) IS DISTINCT FROM max(cycle) FILTER (WHERE cycle < 30)""", v.PACKETS)),
    Entry("m7_live_status", _live,
          oracle(f"""SELECT unit, cycle AS current_cycle, round(predicted_rul, 6) AS predicted_rul, true_rul,
                      round(predicted_std, 6) AS predicted_std, round(predicted_std * 1.96, 6) AS uncertainty
                    FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY cycle DESC, timestamp_ms DESC) AS b
                          FROM scores) WHERE b = 1""", v.SCORES)),
    Entry("m9_watermarked_windows", _watermarked, oracle(STREAM_WINDOWS, v.SESSIONS)),
    Entry("m10_batch_latency", lambda s, d: _latency(s, d),
          oracle("""SELECT event_id, true AS measured FROM
                    (SELECT event_id, row_number() OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id) AS n FROM packets)
                    WHERE n >= 5""", v.PACKETS)),
]


def _latency(s, d):
    from vanewright.catalog.ordered import _mean_scorer
    from vanewright.catalog.profiles import _windows5
    out = scoring.score_windows(_windows5(s, d).select("event_id", "window"), _mean_scorer, FEATS, 5)
    return out.select("event_id", (F.col("inference_latency_ms") >= 0).alias("measured"))
