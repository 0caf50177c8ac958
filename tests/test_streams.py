"""Streams over several files give the batch result, whatever the batch cut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanewright.operators import scoring, windows
from vanewright.sources import packet_log
from vanewright.sources import packets as bus
from vanewright.sources.versions import VersionedTable
from vanewright.streaming import pipeline


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """Packets of four units in five files; cycles fall now and then."""
    rng = np.random.default_rng(9)
    n = 400
    pdf = pd.DataFrame({"unit": rng.choice([1, 1, 2, 3, 4], n), "timestamp_ms": np.arange(n) * 1000,
                        "a": rng.normal(0, 20, n).round(3), "true_rul": rng.integers(0, 30, n).astype(float)})
    pdf["cycle"] = (pdf["timestamp_ms"] // 1000 // 25 % 6 + 1).astype("int32")
    root = tmp_path_factory.mktemp("packets")
    for i in range(5):
        pdf.iloc[i * 80:(i + 1) * 80].to_parquet(root / f"part-{i}.parquet", index=False)
    return str(root), pdf


def stream(spark, path, per_trigger):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def run(query, root):
    q = (query.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start())
    q.awaitTermination()


def facts(df):
    rows = df.select("unit", "session_id", "timestamp_ms", F.transform("window", lambda x: x["a"]).alias("w")).collect()
    return sorted((r["unit"], r["session_id"], r["timestamp_ms"], tuple(r["w"])) for r in rows)


@pytest.mark.parametrize("per_trigger,drop_first", [(1, False), (2, True), (5, False)])
def test_windows_equal_batch(spark, source, tmp_path, per_trigger, drop_first):
    path, _ = source
    run(pipeline.stream_windows(stream(spark, path, per_trigger), ["a"], 4, compat_drop_first=drop_first), tmp_path)
    batch = windows.session_ids(spark.read.parquet(path), ["timestamp_ms"])
    want = windows.sliding_windows(batch, ["a"], ["timestamp_ms"], 4, ["unit", "session_id"],
                                   compat_drop_first=drop_first)
    assert facts(spark.read.parquet(f"{tmp_path}/out")) == facts(want)


SHIFT = 10**6  # a watermark starts at 0, and what is not above it is late


@pytest.fixture(scope="module")
def delayed(source, tmp_path_factory):
    """The same packets; some come one or two files later, one far too late, and a beat ends them."""
    _, pdf = source
    pdf = pdf.assign(timestamp_ms=pdf["timestamp_ms"] + SHIFT)
    rng = np.random.default_rng(4)
    late = rng.random(len(pdf)) < 0.2
    part = np.minimum(np.arange(len(pdf)) // 80 + np.where(late, rng.integers(1, 3, len(pdf)), 0), 4)
    root = tmp_path_factory.mktemp("delayed")
    beat = pdf.tail(1).assign(unit=-1, timestamp_ms=10**9)
    lost = pdf.head(1).assign(timestamp_ms=1)
    for i in range(5):
        pdf[part == i].sample(frac=1, random_state=i).to_parquet(root / f"part-{i}.parquet", index=False)
    lost.to_parquet(root / "part-5.parquet", index=False)
    for i in (6, 7):  # the second takes the batch in which the first has moved the watermark
        beat.to_parquet(root / f"part-{i}.parquet", index=False)
    return str(root)


@pytest.mark.parametrize("drop_first", [False, True])
def test_late_packets_change_nothing(spark, source, delayed, tmp_path, drop_first):
    path, _ = source
    timed = pipeline.with_watermark(stream(spark, delayed, 1), "250 seconds")
    out = pipeline.stream_windows(timed, ["a"], 4, compat_drop_first=drop_first)
    q = (out.writeStream.format("parquet").option("path", f"{tmp_path}/out")
         .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    batch = windows.session_ids(spark.read.parquet(path), ["timestamp_ms"])
    want = windows.sliding_windows(batch, ["a"], ["timestamp_ms"], 4, ["unit", "session_id"],
                                   compat_drop_first=drop_first)
    got = spark.read.parquet(f"{tmp_path}/out").withColumn("timestamp_ms", F.col("timestamp_ms") - SHIFT)
    assert facts(got) == facts(want)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_state_grows_with_the_groups_not_with_units_and_buckets(spark, tmp_path):
    """Packets of many units, one in a bucket; a null unit is a unit, and longs beside nulls keep their digits."""
    far = 2**53 + 1
    rows = [(u, 1, SHIFT + 1000 * (60 * at + (u or 0)), float(at), None if u == 1 else far + at)
            for u in [None, *range(59)] for at in range(6)]
    schema = "unit long, cycle int, timestamp_ms long, a double, mark long"
    beat = spark.createDataFrame([(-1, 1, 10**9, 0.0, 0)], schema)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/p=0")
    for i in (1, 2):  # the second takes the batch in which the first has moved the watermark
        beat.coalesce(1).write.parquet(f"{tmp_path}/in/p={i}")
    want = sorted((str(u), a, str(m)) for u, _, _, a, m in rows if a >= 2)
    for timed, most in ((False, 4), (True, 50)):
        at = f"{tmp_path}/{timed}"
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/p=*")
        packets = pipeline.with_watermark(source, "1000 seconds") if timed else source
        out = pipeline.stream_windows(packets, ["a"], 3, carry=["mark"], bucket_ms=100_000, groups=2)
        q = (out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) <= most
        got = spark.read.parquet(f"{at}/out").where("unit is null or unit >= 0").collect()
        assert sorted((str(r["unit"]), r["window"][-1]["a"], str(r["mark"])) for r in got) == want


def test_pipeline_end_to_end_and_restart(spark, source, tmp_path):
    path, pdf = source

    def scorer(df):
        return scoring.linear_score(df.withColumn("window", F.transform(
            "window", lambda x: F.struct(x["a_z"].alias("a")))), {"a": 1.0})
    raw = stream(spark, path, 2)
    messages = bus.encode_packets(raw.withColumnRenamed("true_rul", "rul"), "timestamp_ms")
    for _ in range(2):      # the second start finds nothing new
        for q in pipeline.telemetry_pipeline(messages, str(tmp_path), scorer, ["a"], {"a": (1.0, 2.0)}, 4,
                                             snapshot_every=1):
            q.awaitTermination()
    got = pipeline.read_scores(spark, str(tmp_path)).toPandas()
    table = VersionedTable(spark, f"{tmp_path}/scores")
    names = sorted(table.snapshots())
    assert names == ["batch-0", "batch-1", "batch-2"] and pipeline.read_scores(spark, str(tmp_path), names[-1]).count() == len(got)
    assert len(table.store.names("data")) == 3  # a folder a batch: snapshots copy nothing
    assert not got.duplicated(["unit", "timestamp_ms"]).any()
    batch = windows.session_ids(spark.read.parquet(path), ["timestamp_ms"])
    full = windows.sliding_windows(batch, ["a"], ["timestamp_ms"], 4, ["unit", "session_id"]).toPandas()
    last = full[full["session_id"] == full.groupby("unit")["session_id"].transform("max")]
    assert sorted(zip(got["unit"], got["timestamp_ms"])) == sorted(zip(last["unit"], last["timestamp_ms"]))
    one = got.sort_values(["unit", "timestamp_ms"]).iloc[0]
    w = last[(last["unit"] == one["unit"]) & (last["timestamp_ms"] == one["timestamp_ms"])].iloc[0]["window"]
    z = [(v["a"] - 1) / 2 if abs(v["a"]) > 15 else v["a"] for v in w]
    assert one["predicted_rul"] == pytest.approx(np.log1p(np.exp(np.mean(z))), rel=1e-6)


def test_live_status_equals_batch(spark, source, tmp_path):
    path, pdf = source
    scored = stream(spark, path, 1).select("unit", "cycle", "timestamp_ms", F.col("a").alias("predicted_rul"),
                                           "true_rul", F.lit(1.0).alias("predicted_std"))

    def keep(batch, batch_id):
        batch.withColumn("b", F.lit(batch_id)).write.mode("append").parquet(f"{tmp_path}/s")
    q = (pipeline.live_status(scored).writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    q.awaitTermination()
    got = pipeline.publish(spark.read.parquet(f"{tmp_path}/s"), ["unit"], ["b"]).toPandas()
    want = pdf.sort_values(["cycle", "timestamp_ms"]).groupby("unit").tail(1)
    assert sorted(zip(got["unit"], got["predicted_rul"])) == sorted(zip(want["unit"], want["a"]))


def test_node_health_boundary(spark):
    beats = spark.createDataFrame([("a", 1_000, 5.0), ("a", 9_000, 7.0), ("b", 0, 1.0), ("c", 8_999, 2.0)],
                                  "node string, timestamp_ms long, latency_ms double")
    got = {r["node"]: (r["status"], r["latency_ms"]) for r in pipeline.node_health(beats, F.lit(18_999)).collect()}
    assert got == {"a": ("ONLINE", 7.0), "b": ("OFFLINE", None), "c": ("OFFLINE", None)}


def test_changed_units_only(spark):
    now = spark.createDataFrame([(1, 3), (1, 4), (2, 5), (3, 1)], "unit int, cycle int")
    seen = spark.createDataFrame([(1, 3), (2, 5)], "unit int, max_cycle int")
    assert sorted(tuple(r) for r in pipeline.changed_units(now, seen).collect()) == [(1, 4), (3, 1)]


# --- packet log

def packets_in(rows):
    return [(str(u), f'{{"unit": {u}, "cycle": {c}, "a": {a}, "timestamp_ms": {t}}}') for u, c, a, t in rows]


def send(spark, root, lo, hi, **options):
    rows = packets_in([(i % 7, i // 50, float(i), 1000 + i) for i in range(lo, hi)])
    bus.send_packets(spark.createDataFrame(rows, bus.WIRE_SCHEMA), options={"path": f"{root}/log", **options})


def read_log(spark, root, out="out", **options):
    decoded = bus.decode_packets(bus.packet_stream(spark, path=f"{root}/log", options=options), ["a"])
    q = (decoded.writeStream.format("parquet").option("path", f"{root}/{out}").option("checkpointLocation", f"{root}/{out}-cp")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(int(r["a"]) for r in spark.read.schema(decoded.schema).parquet(f"{root}/{out}").collect())


def test_two_restarts_lose_and_double_nothing(spark, tmp_path):
    for at in range(3):
        send(spark, tmp_path, 100 * at, 100 * at + 60)
        send(spark, tmp_path, 100 * at + 60, 100 * at + 100, segment_rows="7")
        assert read_log(spark, tmp_path) == list(range(100 * at + 100))
    assert read_log(spark, tmp_path) == list(range(300))  # nothing new
    packet_log.register(spark)
    assert spark.read.format("packet_log").load(f"{tmp_path}/log").count() == 300
    log = packet_log.Log(f"{tmp_path}/log")
    assert log.latest() == 6 and log.unused() == []


def test_micro_batches_of_the_log_are_bounded(spark, tmp_path):
    """Also from where a query stands that starts again."""
    sizes = []
    for start in (0, 5):
        for i in range(start, start + 5):
            send(spark, tmp_path, 10 * i, 10 * i + 10)
        stream = bus.packet_stream(spark, path=f"{tmp_path}/log", options={"commits_per_batch": "2", "consumer": "one"})
        q = (stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option("checkpointLocation", f"{tmp_path}/cp")
             .trigger(processingTime="100 milliseconds").start())
        import time
        until = time.time() + 60
        while time.time() < until and sum(sizes) < 10 * (start + 5):
            time.sleep(0.2)
        q.stop()
    assert sum(sizes) == 100 and max(sizes) == 20
    with pytest.raises(ValueError):
        packet_log._StreamReader("x", 2, "")
    reader = packet_log._StreamReader(f"{tmp_path}/log", 2, "two")
    assert [reader.latestOffset()["commits"] for _ in range(6)] == [2, 4, 6, 8, 10, 10]


def test_lost_tasks_leave_nothing_in_the_log(spark, tmp_path):
    send(spark, tmp_path, 0, 20)
    log = packet_log.Log(f"{tmp_path}/log")
    import pyarrow as pa
    torn = log.add_segment(pa.table({"key": ["x"], "value": ["torn"]}))  # written, never committed
    assert log.unused() == [torn] and read_log(spark, tmp_path) == list(range(20))

    def fail(batches):
        yield from batches
        raise RuntimeError("lost")
    broken = spark.createDataFrame(packets_in([(1, 1, 99.0, 5)]), bus.WIRE_SCHEMA).mapInArrow(fail, bus.WIRE_SCHEMA)
    with pytest.raises(Exception, match="lost"):
        bus.send_packets(broken, options={"path": f"{tmp_path}/log"})
    assert log.latest() == 1 and read_log(spark, tmp_path) == list(range(20))


def test_a_writing_stream_repeats_no_batch(spark, source, tmp_path):
    path, pdf = source
    for _ in range(2):
        messages = bus.encode_packets(stream(spark, path, 1), "timestamp_ms")
        bus.send_stream(messages, f"{tmp_path}/log", f"{tmp_path}/cp", "packets").awaitTermination()
    log = packet_log.Log(f"{tmp_path}/log")
    assert log.latest() == 5
    # A batch whose commit reached the log, but not Spark's own record, comes again after a restart.
    writer = packet_log._StreamWriter(f"{tmp_path}/log", 10, "packets")
    again = packet_log._write(f"{tmp_path}/log", 10, iter([]))
    import pyarrow as pa
    again.segments.append(log.add_segment(pa.table({"key": ["1"], "value": ["again"]})))
    writer.commit([again, None], 4)
    assert log.latest() == 5 and log.unused() == [] and len(read_log(spark, tmp_path)) == len(pdf)
    writer.commit([], 5)
    assert log.latest() == 6
    with pytest.raises(Exception, match="writer"):
        stream(spark, path, 1).selectExpr("'a' AS key", "'b' AS value").writeStream.format("packet_log").option("path", f"{tmp_path}/log") \
            .option("checkpointLocation", f"{tmp_path}/cp2").start().awaitTermination()


# --- event time

def test_packets_without_a_stamp_end_no_stream(spark, tmp_path):
    """Alone in their batch, with others, and malformed ones beside them."""
    rows = [("5", '{"unit": 5, "cycle": 1, "a": 1.0}')], [("5", '{"unit": 5, "cycle": 1, "a": 1.0}'), ("1", "{broken"), *packets_in([(5, 1, 2.0, 10**6)])]
    rows = [*rows, packets_in([(5, 1, 3.0, 10**6 + 1)]), packets_in([(9, 1, 0.0, 10**9)]), packets_in([(9, 1, 0.0, 10**9)])]
    for part in rows:
        bus.send_packets(spark.createDataFrame(part, bus.WIRE_SCHEMA), options={"path": f"{tmp_path}/log"})
    stream = bus.packet_stream(spark, path=f"{tmp_path}/log", options={"commits_per_batch": "1", "consumer": "scored"})

    def scorer(df):
        return scoring.linear_score(df.withColumn("window", F.transform("window", lambda x: F.struct(x["a_z"].alias("a")))), {"a": 1.0})
    queries = pipeline.telemetry_pipeline(stream, f"{tmp_path}/out", scorer, ["a"], {"a": (0.0, 1.0)}, 2, delay="10 seconds",
                                          trigger={"processingTime": "100 milliseconds"})
    for q in queries:
        q.processAllAvailable()
        q.stop()
    got = pipeline.read_scores(spark, f"{tmp_path}/out").select("unit", "timestamp_ms").collect()
    assert [tuple(r) for r in got] == [(5, 10**6 + 1)]
    assert spark.read.parquet(f"{tmp_path}/out/rejected").count() == 3
    schema = "unit int, cycle int, timestamp_ms long, true_rul double, a double"
    spark.createDataFrame([(1, 1, None, 1.0, 1.0)], schema).write.parquet(f"{tmp_path}/loose")
    timed = pipeline.with_watermark(spark.readStream.schema(schema).parquet(f"{tmp_path}/loose"), "10 seconds")
    run(pipeline.stream_windows(timed, ["a"], 1), tmp_path / "loose-run")
    assert spark.read.schema("unit int").parquet(f"{tmp_path}/loose-run/out").count() == 0


def test_timers_read_only_the_buckets_that_are_due():
    """A packet is written once and read once, however long others wait."""
    class Value:
        held = None
        def get(self): return self.held  # noqa: E704
        def update(self, v): self.held = v  # noqa: E704

    class Map(dict):
        reads = 0
        def getValue(self, k): self.reads += 1; return self[k]  # noqa: E702,E704
        def containsKey(self, k): return k in self  # noqa: E704
        def updateValue(self, k, v): self[k] = v  # noqa: E704
        def removeKey(self, k): del self[k]  # noqa: E704

    class Handle:
        def __init__(self): self.timers, self.map = set(), Map()  # noqa: E704
        def getValueState(self, *_): return Value()  # noqa: E704
        def getMapState(self, *_): return self.map  # noqa: E704
        def registerTimer(self, at): self.timers.add(at)  # noqa: E704

    class Expired:
        def __init__(self, at): self.at = at  # noqa: E704
        def getExpiryTimeInMs(self): return self.at  # noqa: E704

    state, handle = pipeline._WindowState(["a"], ["t"], 1, ["t", "cycle", "a"], False, "t", True, 100), Handle()
    state.init(handle)
    rng = np.random.default_rng(1)
    stamps = rng.permutation(5000)
    for part in np.split(stamps, 10):
        list(state.handleInputRows((1,), iter([pd.DataFrame({"t": part, "cycle": 1, "a": part.astype(float)})]), None))
    handle.map.reads, out = 0, []
    for at in sorted(handle.timers):
        out += [r for df in state.handleExpiredTimer((1,), None, Expired(at)) for r in df["t"]]
    assert out == list(range(5000)) and handle.map.reads == 50 and not handle.map


# --- liveness and changes

def test_silence_is_told_without_new_beats_of_the_node(spark, tmp_path):
    schema = "node string, timestamp_ms long, latency_ms double"
    inbox, out, at = str(tmp_path / "in"), [], [0]

    def beat(*rows):
        at[0] += 1
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(inbox)
    beat(("a", 1, 5.0), ("b", 2, 6.0), (None, 3, 1.0), ("c", None, 1.0))
    q = (pipeline.stream_health(spark.readStream.schema(schema).parquet(inbox), 4).writeStream.outputMode("update")
         .foreachBatch(lambda df, _: out.extend(tuple(r) for r in df.collect())).option("checkpointLocation", f"{tmp_path}/cp")
         .trigger(processingTime="300 milliseconds").start())
    import time
    until = time.time() + 90
    while time.time() < until and ("b", 2, "OFFLINE", None) not in out:
        time.sleep(0.7)
        beat(("a", 10 + at[0], 1.0))
    assert ("a", 1, "ONLINE", 5.0) in out and ("b", 2, "ONLINE", 6.0) in out and ("b", 2, "OFFLINE", None) in out
    assert not any(r[0] in (None, "c") for r in out)
    while time.time() < until and ("b", 99, "ONLINE", 2.0) not in out:
        beat(("b", 99, 2.0))
        time.sleep(0.7)
    q.stop()
    assert ("b", 99, "ONLINE", 2.0) in out


def test_a_batch_without_change_emits_nothing(spark, tmp_path):
    schema, out = "unit int, cycle int, setting string", []
    batches = [[(1, 3, "x"), (1, 2, "y"), (2, 5, None), (None, 1, "n")], [(1, 3, "x"), (2, 4, "q"), (None, 1, "n"), (1, None, "z")], [(1, 3, "w"), (2, 6, None)],
               [(None, 2, "n")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = (pipeline.stream_changes(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), F.col("setting")).writeStream.outputMode("update")
             .foreachBatch(lambda df, i: out.append(sorted((tuple(r) for r in df.collect()), key=str))).option("checkpointLocation", f"{tmp_path}/cp")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert out == [[(1, 3, "x"), (2, 5, ""), (None, 1, "n")], [], [(1, 3, "w"), (2, 6, "")], [(None, 2, "n")]]


def test_a_null_unit_that_did_not_change(spark):
    now = spark.createDataFrame([(None, 3), (2, 5)], "unit int, cycle int")
    seen = spark.createDataFrame([(None, 3)], "unit int, max_cycle int")
    assert [tuple(r) for r in pipeline.changed_units(now, seen).collect()] == [(2, 5)]
