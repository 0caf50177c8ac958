"""Structured Streaming: keyed packet windows, scored tables, live status."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vanewright.operators.project import Stats, dual_domain, stats_map
from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join
from vanewright.schemas import FEATURES, PHYSICAL_ABOVE, WINDOW_SIZE
from vanewright.sources.packets import dead_letters, decode_packets
from vanewright.sources.sinks import drop_stale_sessions
from vanewright.sources.versions import VersionedTable

SCORE_BUCKETS = 8
COMPACT_EVERY = 20
ONLINE_WITHIN_S = 10   # fixed value: a node is online if its last beat is younger


def with_watermark(packets: DataFrame, delay: str = "10 minutes",
                   timestamp_ms: str = "timestamp_ms") -> DataFrame:
    """Event time from the packet stamp, with a watermark; later rows are dropped
    by the stateful operators downstream."""
    timed = packets.withColumn("event_time", F.timestamp_millis(timestamp_ms))
    return timed.withWatermark("event_time", delay)


#: Width of a bucket of waiting packets, in event time.
BUCKET_MS = 10_000
#: Groups of units, each with one state; like the shuffle partitions, fixed for the life of a checkpoint.
GROUPS = 256
#: Values in the windows of one frame of output.
FRAME_VALUES = 1_000_000


def _packed(table: pa.Table) -> bytes:
    """A table as one binary value of the state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


class _WindowState(StatefulProcessor):
    """Per group of units one value: for each unit its last ``size - 1`` packets, cycle and session; and, under a
    watermark, the packets that wait for it, in a map of buckets of event time.

    A group's units are taken together, so the calls to the state store grow with the groups and not with the
    units or packets.  One timer stands at the end of a group's first bucket.  When the watermark has passed it, the packets of
    all buckets that it has passed are released in the order of their stamps and the buckets are removed, so a packet is written
    and read once by the timers however many wait; only then the session rule sees it.
    Packets behind the watermark never get here: Spark drops and counts them
    (``numRowsDroppedByWatermark``).
    """

    def __init__(self, features: Sequence[str], carried: Sequence[str], size: int,
                 waiting: Sequence[str], drop_first: bool, order: str, timed: bool, bucket_ms: int):
        self.features, self.carried, self.size = list(features), list(carried), size
        self.names, self.drop_first, self.order, self.timed, self.width = list(waiting), drop_first, order, timed, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "units binary")
        if self.timed:
            self.waiting = handle.getMapState("waiting", "bucket long", "packets array<binary>")
            self.buckets = handle.getValueState("buckets", "held array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([r[self.names] for r in rows], ignore_index=True)
        if not self.timed:
            yield from self._advance(batch)
            return
        held = self._held()
        known = set(held)
        for bucket, own in batch.groupby(batch[self.order] // self.width):
            at = (int(bucket),)
            before = list(self.waiting.getValue(at)[0]) if at[0] in known else []
            self.waiting.updateValue(at, ([*before, _packed(pa.Table.from_pandas(own, preserve_index=False))],))
            known.add(at[0])
        self._hold(held, sorted(known))
        yield self._nothing()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self._held()
        due = [b for b in held if self._end(b) <= passed]
        if not due:
            yield self._nothing()
            return
        parts = []
        for bucket in due:
            parts += [_unpacked(bytes(p)).to_pandas() for p in self.waiting.getValue((bucket,))[0]]
            self.waiting.removeKey((bucket,))
        self._hold([], held[len(due):])
        yield from self._advance(pd.concat(parts, ignore_index=True))

    def _end(self, bucket: int) -> int:
        return (bucket + 1) * self.width

    def _held(self) -> list[int]:
        """The buckets that hold packets, in order."""
        held = self.buckets.get()
        return [] if held is None else [int(b) for b in held[0]]

    def _hold(self, before: list[int], now: list[int]) -> None:
        """Keep the list of buckets, and the timer at the end of the first."""
        if now != before:
            self.buckets.update((now,))
        if before[:1] != now[:1]:
            if before:
                self.handle.deleteTimer(self._end(before[0]))
            if now:
                self.handle.registerTimer(self._end(now[0]))

    def _frame(self, columns: dict) -> pd.DataFrame:
        return pd.DataFrame(columns, columns=[UNIT, *self.carried, "session_id", *map(_steps, self.features)])

    def _nothing(self) -> pd.DataFrame:
        return self._frame({c: pd.Series([], dtype=object) for c in [UNIT, *self.carried, "session_id", *map(_steps, self.features)]})

    def _places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units with cycle and session, and how many packets each of them holds; the packets one after another."""
        held = self.place.get()
        if held is None:
            none = np.zeros(0, np.int64)
            return np.zeros(0, object), none, none, none, np.zeros((0, len(self.features)))
        table = _unpacked(bytes(held[0])).combine_chunks()
        units = table.column("unit").to_numpy(zero_copy_only=False).astype(object)
        ring = np.frombuffer(b"".join(table.column("ring").to_pylist()), np.float64).reshape(-1, len(self.features))
        return units, table.column("cycle").to_numpy(), table.column("session").to_numpy(), table.column("packets").to_numpy(), ring

    def _advance(self, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Append packets in order and return the windows that they fill, a frame for some of them at a time.  All units
        are one sequence: what is held of a unit, then its packets, cut where the unit or the session changes."""
        known, cycles, sessions, packets, ring = self._places()
        batch = batch.sort_values(self.order, kind="stable")
        codes, units = pd.factorize(np.concatenate([known, batch[UNIT].to_numpy(object)]), use_na_sentinel=False)
        codes = codes[len(known):]
        by_unit = np.argsort(codes, kind="stable")
        batch, codes = batch.iloc[by_unit], codes[by_unit]

        cycle = batch["cycle"].to_numpy(np.int64)
        first = np.diff(codes, prepend=-1) != 0
        start = np.maximum.accumulate(np.where(first, np.arange(len(codes)), 0))
        old = codes < len(known)
        last = np.where(first, cycle, np.roll(cycle, 1))
        last[first & old] = cycles[codes[first & old]]
        fell = cycle < last
        falls = np.cumsum(fell)
        new = len(units) - len(known)
        cycles, sessions = (np.concatenate([x, np.zeros(new, np.int64)]) for x in (cycles, sessions))
        ids = sessions[codes] + falls - (falls - fell)[start]

        kept = np.flatnonzero(~fell) if self.drop_first else np.arange(len(codes))
        ring_of = np.repeat(np.arange(len(known)), packets)
        unit = np.concatenate([ring_of, codes[kept]])
        joined = np.argsort(unit, kind="stable")
        unit = unit[joined]
        session = np.concatenate([sessions[ring_of], ids[kept]])[joined]
        values = np.concatenate([ring, batch[self.features].to_numpy(float)[kept]])[joined]
        source = np.concatenate([np.full(len(ring), -1), kept])[joined]

        at = np.arange(len(unit))
        begins = (np.diff(unit, prepend=-1) != 0) | (np.diff(session, prepend=-1) != 0)
        place = at - np.maximum.accumulate(np.where(begins, at, 0))
        ends = np.flatnonzero((place >= self.size - 1) & (source >= 0))

        final = np.flatnonzero(np.diff(codes, append=-1) != 0)
        cycles[codes[final]], sessions[codes[final]] = cycle[final], ids[final]
        behind = np.searchsorted(unit, unit, "right") - 1 - at
        left = np.flatnonzero((behind < self.size - 1) & (session == sessions[unit]))
        self._keep(units, cycles, sessions, np.bincount(unit[left], minlength=len(units)), values[left])
        if not len(ends):
            yield self._nothing()
            return
        windows = np.lib.stride_tricks.sliding_window_view(values, self.size, axis=0)
        many = max(1, FRAME_VALUES // (self.size * len(self.features)))
        for lo in range(0, len(ends), many):
            some = ends[lo:lo + many]
            rows, shown = source[some], windows[some - (self.size - 1)]
            out = {UNIT: units[unit[some]], **{c: batch[c].to_numpy()[rows] for c in self.carried}, "session_id": ids[rows]}
            yield self._frame(out | {_steps(f): list(shown[:, j]) for j, f in enumerate(self.features)})

    def _keep(self, units: np.ndarray, cycles: np.ndarray, sessions: np.ndarray, packets: np.ndarray, ring: np.ndarray) -> None:
        upto = np.cumsum(packets)
        ring = np.ascontiguousarray(ring)
        parts = [ring[end - n:end].tobytes() for n, end in zip(packets, upto)]
        self.place.update((_packed(pa.table({
            "unit": pa.array(units, pa.string(), from_pandas=True), "cycle": cycles, "session": sessions,
            "packets": packets, "ring": pa.array(parts, pa.binary())})),))

    def close(self) -> None:
        pass


#: A unit as text, which in a frame keeps null and the digits of a long.
UNIT = "unit_text"


def _steps(feature: str) -> str:
    return f"__steps_{feature}"


def _null(column: str) -> str:
    return f"null_of_{column}"


def stream_windows(packets: DataFrame, features: Sequence[str] = FEATURES,
                   size: int = WINDOW_SIZE, order: str = "timestamp_ms",
                   carry: Sequence[str] = ("timestamp_ms", "cycle", "true_rul"),
                   compat_drop_first: bool = False, bucket_ms: int = BUCKET_MS, groups: int = GROUPS) -> DataFrame:
    """Sliding windows per unit with session resets, emitted when full.

    After ``with_watermark`` packets are released in event-time order once the watermark
    has passed their bucket of ``bucket_ms``, so a packet that comes late but within the delay changes nothing;
    state holds the packets of the delay, and a packet without a stamp is left out.  Without a watermark a micro-batch is ordered
    in itself, and state per unit is ``size - 1`` packets, a cycle and a counter.
    Units are hashed into ``groups``, of which each is one key of the state: a micro-batch reads and writes the state of
    the groups that it touches, and one task holds a group's packets of the micro-batch.  Many more units want more groups.
    The session must use the RocksDB state store (``vanewright.session.configure``).
    """
    timed = "event_time" in packets.columns
    kind = packets.schema["unit"].dataType
    binary = isinstance(kind, T.BinaryType)
    # A long with nulls would reach a frame as doubles: the nulls of such columns travel in columns of their own.
    longs = [c for c in carry if isinstance(packets.schema[c].dataType, T.LongType) and c not in (order, "cycle", *features)]
    carried = [*carry, *map(_null, longs)]
    used = dict.fromkeys([UNIT, order, "cycle", *carried, *features])
    steps = [T.StructField(_steps(f), T.ArrayType(T.DoubleType())) for f in features]
    fields = [T.StructField(UNIT, T.StringType()), *[packets.schema[c] for c in carry], *[T.StructField(_null(c), T.BooleanType()) for c in longs],
              T.StructField("session_id", T.LongType()), *steps]
    processor = _WindowState(features, carried, size, list(used), compat_drop_first, order, timed, bucket_ms)
    rows = packets.where(F.col(order).isNotNull()).withColumns({
        "unit_group": F.pmod(F.xxhash64("unit"), F.lit(groups)).cast("int"),
        UNIT: F.base64("unit") if binary else F.col("unit").cast("string"),
        **{_null(c): F.col(c).isNull() for c in longs}, **{c: F.coalesce(c, F.lit(0)) for c in longs}})
    needed = ["unit_group", *used, *(["event_time"] if timed else [])]
    out = rows.select(*needed).groupBy("unit_group").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=T.StructType(fields),
        outputMode="Append", timeMode="EventTime" if timed else "None")
    unit = F.unbase64(UNIT) if binary else F.col(UNIT).cast(kind)
    kept = [F.when(~F.col(_null(c)), F.col(c)).alias(c) if c in longs else F.col(c) for c in carry]
    window = F.arrays_zip(*[F.col(_steps(f)).alias(f) for f in features])
    return out.select(unit.alias("unit"), *kept, "session_id", window.alias("window"))


@dataclass(frozen=True)
class SinkPaths:
    """Folders of the scored stream below one root."""
    root: str

    @property
    def scores(self) -> str:
        return f"{self.root}/scores"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoint/{name}"


def read_scores(spark: SparkSession, root: str, version: int | str | None = None) -> DataFrame:
    """The scored table: each unit's last session, one row per packet; of the newest version, one
    by number, or a snapshot by name."""
    return drop_stale_sessions(VersionedTable(spark, SinkPaths(root).scores).read(version))


def telemetry_pipeline(messages: DataFrame, root: str, scorer: Callable[[DataFrame], DataFrame],
                       features: Sequence[str] = FEATURES, stats: DataFrame | Stats | None = None,
                       size: int = WINDOW_SIZE, threshold: float = PHYSICAL_ABOVE,
                       mode: str = "per_value", snapshot_every: int = 0,
                       trigger: dict | None = None, delay: str | None = None,
                       bucket_ms: int = BUCKET_MS) -> list[StreamingQuery]:
    """Decode, dual domain, window, score, persist, snapshot; rejects go aside.

    Each micro-batch is one version of the scored table, which a replayed batch finds there, so it
    leaves no duplicates; buckets of many batches are compacted.  A session reset needs no delete: rows carry
    their session and readers keep the last one (``read_scores``).  A snapshot names
    a version every so many batches and copies nothing.
    ``scorer`` maps a frame with a ``window`` column to one with scores.  ``delay`` sets a
    watermark: packets are then scored in event-time order, each once the watermark has
    passed it, which a stream that ends leaves its last packets waiting for.
    """
    sink = SinkPaths(root)
    known = stats_map(stats) if stats is not None else None
    packets = decode_packets(messages, features)
    z_names = [f"{f}_z" for f in features]
    if known is not None:
        packets = dual_domain(packets, known, features, threshold, mode)
    else:
        packets = packets.withColumns({f"{f}_z": F.col(f) for f in features})
    carry = ["timestamp_ms", "cycle", "true_rul", *features]
    if delay:
        packets = with_watermark(packets, delay)
    windows = stream_windows(packets, z_names, size, carry=carry, bucket_ms=bucket_ms)

    def persist(batch: DataFrame, batch_id: int) -> None:
        scored = scorer(batch.withColumns(
            {f"{f}_z": F.element_at("window", -1)[f"{f}_z"] for f in features}))
        table = VersionedTable(batch.sparkSession, sink.scores, scored.schema, ["unit"], SCORE_BUCKETS)
        table.append(scored, "scored", batch_id)
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            table.compact()
        if snapshot_every and batch_id % snapshot_every == 0:
            table.snapshot(f"batch-{batch_id}")

    when = trigger or {"availableNow": True}
    scored = (windows.writeStream.queryName("scored").foreachBatch(persist)
              .option("checkpointLocation", sink.checkpoint("scores")).trigger(**when).start())
    rejects = (dead_letters(messages, features).writeStream.queryName("rejected")
               .format("parquet").option("path", sink.rejected)
               .option("checkpointLocation", sink.checkpoint("rejected")).trigger(**when).start())
    return [scored, rejects]


def live_status(scores: DataFrame, k: float = 1.96) -> DataFrame:
    """Latest scored packet per unit; on a stream use update mode."""
    last = F.max(F.struct("cycle", "timestamp_ms", "predicted_rul", "true_rul", "predicted_std"))
    out = scores.groupBy("unit").agg(last.alias("s"))
    return out.select("unit", F.col("s.cycle").alias("current_cycle"),
                      F.col("s.predicted_rul").alias("predicted_rul"),
                      F.col("s.true_rul").alias("true_rul"),
                      F.col("s.predicted_std").alias("predicted_std"),
                      (F.col("s.predicted_std") * k).alias("uncertainty"))


def node_health(beats: DataFrame, now_ms: Column, ttl_s: float = ONLINE_WITHIN_S,
                node: str = "node", ts_ms: str = "timestamp_ms",
                latency: str = "latency_ms") -> DataFrame:
    """ONLINE or OFFLINE per node by the age of its last beat; the latency is
    reported for online nodes only."""
    last = beats.groupBy(node).agg(F.max(ts_ms).alias("last_ms"),
                                   F.max_by(latency, ts_ms).alias("__latency"))
    online = (now_ms - F.col("last_ms")) / 1000.0 < ttl_s
    return last.select(node, "last_ms", F.when(online, "ONLINE").otherwise("OFFLINE").alias("status"),
                       F.when(online, F.col("__latency")).alias("latency_ms"))


class _Liveness(StatefulProcessor):
    """Per node the arrival of its last beat and the status that was emitted last."""

    def __init__(self, ttl_ms: int, ts_ms: str, latency: str):
        self.ttl_ms, self.ts_ms, self.latency = ttl_ms, ts_ms, latency

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.beat = handle.getValueState("beat", "last_ms long, due_ms long, online boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.beat.get()
        beats = pd.concat(list(rows))
        newest = beats.loc[beats[self.ts_ms].idxmax()]
        last = max(int(newest[self.ts_ms]), held[0]) if held is not None else int(newest[self.ts_ms])
        due = timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms
        if held is not None and held[2]:
            self.handle.deleteTimer(held[1])
        self.handle.registerTimer(due)
        self.beat.update((last, due, True))
        came_back = held is None or not held[2]
        yield self._row(key, last, "ONLINE", newest[self.latency]) if came_back else self._row(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, due, online = self.beat.get()
        if not online or due > timerValues.getCurrentProcessingTimeInMs():
            yield self._row(key)
            return
        self.beat.update((last, due, False))
        yield self._row(key, last, "OFFLINE", None)

    @staticmethod
    def _row(key, last: int | None = None, status: str | None = None, latency: float | None = None) -> pd.DataFrame:
        rows = [] if status is None else [(key[0], last, status, latency)]
        return pd.DataFrame(rows, columns=["node", "last_ms", "status", "latency_ms"])

    def close(self) -> None:
        pass


def stream_health(beats: DataFrame, ttl_s: float = ONLINE_WITHIN_S, node: str = "node", ts_ms: str = "timestamp_ms",
                  latency: str = "latency_ms") -> DataFrame:
    """Status changes of nodes while a stream of beats runs: ONLINE with the first beat after silence, OFFLINE
    when none has arrived for ``ttl_s`` by the clock, which a timer per node tells even if nothing else
    arrives.  Beats without node or stamp are left out.  State is one row a node; ``publish`` keeps the last status."""
    rows = beats.where(F.col(node).isNotNull() & F.col(ts_ms).isNotNull()) \
                .select(F.col(node).alias("node"), F.col(ts_ms).cast("long").alias("ts"), F.col(latency).cast("double").alias("latency"))
    kind = rows.schema["node"].dataType.simpleString()
    return rows.groupBy("node").transformWithStateInPandas(
        statefulProcessor=_Liveness(int(ttl_s * 1000), "ts", "latency"),
        outputStructType=f"node {kind}, last_ms long, status string, latency_ms double", outputMode="Update", timeMode="ProcessingTime")


class _Changes(StatefulProcessor):
    """Per unit what was published last: the largest cycle and the digest of its parameters."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "max_cycle long, parameters string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["cycle", "parameters"], kind="stable", na_position="first").iloc[-1]
        held = self.seen.get()
        cycle, parameters = int(new["cycle"]), new["parameters"]
        if held is not None and held[0] > cycle:
            cycle, parameters = held[0], held[1]
        changed = held is None or (cycle, parameters) != (held[0], held[1])
        if changed:
            self.seen.update((cycle, parameters))
        rows = [(key[0], cycle, parameters)] if changed else []
        yield pd.DataFrame(rows, columns=["unit", "max_cycle", "parameters"])

    def close(self) -> None:
        pass


def stream_changes(packets: DataFrame, parameters: Column | None = None, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    """Units whose largest cycle, or parameters at it, differ from what this stream emitted last.  A micro-batch
    that brings nothing new emits nothing; a null unit is a unit; rows without a cycle are left out.  Of equal cycles in a
    micro-batch the greatest parameters count."""
    held = (F.lit("") if parameters is None else F.coalesce(parameters.cast("string"), F.lit(""))).alias("parameters")
    rows = packets.where(F.col(cycle).isNotNull()).select(F.col(unit).alias("unit"), F.col(cycle).cast("long").alias("cycle"), held)
    kind = rows.schema["unit"].dataType.simpleString()
    return rows.groupBy("unit").transformWithStateInPandas(
        statefulProcessor=_Changes(), outputStructType=f"unit {kind}, max_cycle long, parameters string", outputMode="Update", timeMode="None")


def changed_units(current: DataFrame, published: DataFrame, unit: str = "unit",
                  cycle: str = "cycle") -> DataFrame:
    """Units whose largest cycle differs from the published one, or that are new.
    ``published`` has one row per unit."""
    now = current.groupBy(unit).agg(F.max(cycle).alias("max_cycle"))
    seen = published.select(unit, F.col("max_cycle").alias("__seen"), F.lit(True).alias("__known"))
    both = lookup_join(now, seen, [unit], "left")
    same = F.col("__known").isNotNull() & F.col("max_cycle").eqNullSafe(F.col("__seen"))
    return both.where(~same).drop("__seen", "__known")


def publish(status: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key out of an append-only status table."""
    return take_per_group(status, keys, [F.desc(c) for c in order], 1)
