"""Window, sink, training and scoring entries (W, K, R, E)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from vanewright.catalog import views as v
from vanewright.catalog.profiles import _windows5, r
from vanewright.catalog.projections import PATTERNS, _runs
from vanewright.catalog.views import Entry, oracle
from vanewright.functions import scalars
from vanewright.operators import profile, scaling, scoring, smoothing, windows
from vanewright.operators.project import dual_domain, zscore
from vanewright.plans import prep
from vanewright.sources import packets as bus
from vanewright.sources import scans, sinks
from vanewright.sources.versions import VersionedTable

S, STATS = v.SENSORS, v.STATS
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "unit", "cycle"]
KEY_SQL = ", ".join(KEYS)
ORD = ", ".join(v.ORDER)
BY_UNIT = f"PARTITION BY unit ORDER BY {ORD}"
BY_CYCLE = f"PARTITION BY unit, cycle ORDER BY {ORD}"
BY_TIME = "PARTITION BY unit ORDER BY timestamp_ms, event_id"
P_ORDER = v.PACKET_ORDER

CFG = prep.PrepConfig(features=S, order=v.ORDER, val_fraction=0.1, seed=None, win_length=30,
                      win_step=10, skip_obs=3, window_keys=["dataset", "split", "unit"])


def window_facts(df, *keys):
    """First, last and sum of a window, compact enough to compare row by row."""
    return df.select(*keys, F.element_at("window", 1)["s1"].alias("first_s1"),
                     F.element_at("window", -1)["s2"].alias("last_s2"),
                     F.round(F.aggregate(scalars.field_of("window", "s1"), F.lit(0.0), lambda a, x: a + x), 4)
                     .alias("sum_s1"))


WINDOW_FACTS = """
  first_value(s1) OVER w AS first_s1, s2 AS last_s2, round(sum(s1) OVER w, 4) AS sum_s1,
  count(*) OVER w AS n"""

TRAIN_WINDOWS = """
thin AS (
  SELECT {keys}, s1, s2, s3, s4, rul, (rn - 1) // {skip} AS t FROM
    (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ord}) AS rn FROM {src})
  WHERE (rn - 1) % {skip} = 0),
lens AS (SELECT {keys}, count(*) AS n FROM thin GROUP BY {keys}),
starts AS (SELECT {keys}, unnest(range(0, n - {length} + 1, {step})) AS window_start FROM lens WHERE n >= {length})"""


def train_sql(src, keys, skip, length, step):
    return TRAIN_WINDOWS.format(src=src, keys=keys, skip=skip, length=length, step=step, ord=ORD)


SPLIT_SQL = """
unit_rows AS (SELECT unit, count(*) AS rows FROM telemetry WHERE split <> 'test' GROUP BY unit),
val_units AS (
  SELECT unit, rows FROM (SELECT *, sum(rows) OVER (ORDER BY unit DESC) AS upto, sum(rows) OVER () AS total,
                                 row_number() OVER (ORDER BY unit DESC) AS rn FROM unit_rows)
  WHERE upto <= 0.1 * total OR rn = 1),
parts AS (
  SELECT dataset, unit, cycle, l_shipdate, l_orderkey, l_linenumber, l_partkey, s1, s2, s3, s4, fc, hs, rul,
         CASE WHEN split = 'test' THEN 'test' WHEN unit IN (SELECT unit FROM val_units) THEN 'val'
              ELSE 'train' END AS split FROM telemetry)"""


def _stat_cte():
    cols = []
    for f in S:
        cols.append(f"sum(t_{f}) / sum(n) AS m_{f}, sqrt(greatest(sum(v_{f}) / sum(n), 1e-9)) AS d_{f}")
    inner = ", ".join(f"sum({f}) AS t_{f}, coalesce(var_samp({f}), 0) * (count(*) - 1) AS v_{f}" for f in S)
    return f"""
st AS (SELECT {', '.join(cols)} FROM (SELECT dataset, count(*) AS n, {inner} FROM parts WHERE split = 'train'
                                     GROUP BY dataset)),
prepared AS (SELECT dataset, unit, cycle, l_shipdate, l_orderkey, l_linenumber, l_partkey, fc, hs, rul, split,
                    {', '.join(f'({f} - m_{f}) / d_{f} AS {f}' for f in S)} FROM parts, st)"""


def _prepared(s, d):
    return prep.prepare(v.telemetry_rul(s, d), CFG)


def _prep_write(s, d):
    """Through the partitioned sink and back."""
    out = prep.prepare_to(v.telemetry_rul(s, d), CFG, v.scratch(s, "splits"))
    return out.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("rows"),
                                               F.round(F.avg("s1"), 6).alias("mean_s1"))


def _window_set(s, d):
    w = prep.window_dataset(_prepared(s, d), CFG)
    return w.select("dataset", "split", "unit", "window_start", F.size("values").alias("width"),
                    F.round(F.get("values", F.lit(0)), 5).alias("first_s1"),
                    F.round(F.get("values", F.lit(119)), 5).alias("last_s4"), "label")


WINDOW_SET_SQL = """
SELECT a.dataset, a.split, a.unit, a.window_start, 120 AS width, round(f.s1, 5) AS first_s1,
       round(l.s4, 5) AS last_s4, l.rul AS label
FROM starts a
JOIN thin f ON f.dataset = a.dataset AND f.split = a.split AND f.unit = a.unit AND f.t = a.window_start
JOIN thin l ON l.dataset = a.dataset AND l.split = a.split AND l.unit = a.unit AND l.t = a.window_start + 29"""


def _train_windows(s, d):
    w = windows.training_windows(v.telemetry_rul(s, d), S, v.ORDER, 25, 10, 2)
    return w.select("unit", "window_start", F.element_at("window", 1)["s1"].alias("first_s1"),
                    F.element_at("window", -1)["s2"].alias("last_s2"), F.size("window").alias("steps"), "label")


LOCAL_FIT = """
g AS (SELECT unit, cycle, count(*) AS n, sum(predicted_rul) AS sy FROM scores GROUP BY unit, cycle),
t AS (SELECT unit, sum(n) AS total, least(sum(n), greatest(2, floor(0.3 * sum(n) + 1e-10))) AS k FROM g GROUP BY unit),
near AS (SELECT a.unit, a.cycle, b.cycle - a.cycle AS u, b.n, b.sy, total, k,
                sum(b.n) OVER (PARTITION BY a.unit, a.cycle ORDER BY abs(b.cycle - a.cycle)) AS c
         FROM g a JOIN g b ON a.unit = b.unit JOIN t ON t.unit = a.unit),
far AS (SELECT *, min(CASE WHEN c >= k THEN abs(u) END) OVER (PARTITION BY unit, cycle) AS reach FROM near),
weighed AS (SELECT *, CASE WHEN reach = 0 THEN (u = 0)::int WHEN abs(u) / reach >= 0.999 THEN 0 WHEN abs(u) / reach <= 0.001 THEN 1
                           ELSE power(1 - power(abs(u) / reach, 3), 3) END AS w FROM far),
sums AS (SELECT unit, cycle, max(total) AS total, max(reach) AS reach, sum(n * w) AS s0, sum(n * w * u) AS s1, sum(n * w * u * u) AS s2,
                sum(sy * w) AS t0, sum(sy * w * u) AS t1 FROM weighed GROUP BY unit, cycle),
fits AS (SELECT unit, cycle, total, t0 / s0 - CASE WHEN s2 - s1 * s1 / s0 > 1e-12 * greatest(1, s0 * reach * reach)
                THEN (t1 - t0 * s1 / s0) / (s2 - s1 * s1 / s0) ELSE 0 END * s1 / s0 AS fit FROM sums)"""


def _fleet(s, d):
    t = prep.fleet_sample(v.telemetry(s, d), v.ORDER, {11: 10, 14: 5, 15: 20})
    return t.select(*KEYS, "s1")


def _check_norm(s, d):
    z = zscore(v.telemetry(s, d), STATS, S, "_z")
    return scaling.check_normalization(z, STATS, S).select("feature", F.round("max_abs_diff", 9)
                                                           .alias("max_abs_diff"), "ok")


def _upsert(s, d):
    p = v.packets(s, d).select("unit", "cycle", "timestamp_ms", "event_id", "s1")
    old = p.where("event_id % 3 <> 0")
    new = p.where("event_id % 3 = 0")
    return sinks.upsert_latest(old, new, ["unit", "cycle"], ["timestamp_ms", "event_id"])


def _append(s, d):
    """Create the fixed-schema table, append twice, read it back."""
    path = v.scratch(s, "fleet")
    feats = ["s1", "s2"]
    sinks.create_fleet_table(s, path, feats)
    p = dual_domain(v.packets(s, d), {"s1": (50.0, 47.5), "s2": (40.0, 12.5)}, feats)
    p = p.withColumns({"predicted_rul": F.col("s1"), "predicted_std": F.lit(1.0), "true_rul": F.lit(30) - F.col("cycle"),
                       "inference_latency_ms": F.lit(0.0)})
    sinks.append_scores(p.where("event_id % 2 = 0"), path, feats)
    sinks.append_scores(p.where("event_id % 2 = 1"), path, feats)
    return s.read.parquet(path).groupBy("unit").agg(
        F.count(F.lit(1)).alias("rows"), F.max("cycle").alias("max_cycle"),
        F.round(F.avg(F.col("s2").cast("double")), 3).alias("mean_s2"))


def _versioned(s, name, df, keys=("unit",)):
    table = VersionedTable(s, v.scratch(s, name), df.schema, list(keys), 8)
    table.append(df)
    return table


def _upsert_versions(s, d):
    """Two upserts into a versioned table; the second repeats the first, which changes nothing."""
    p = v.packets(s, d).select("unit", "cycle", "timestamp_ms", "event_id", "s1")
    table = _versioned(s, "upserts", p.limit(0))
    for part in (p.where("event_id % 3 <> 0"), p.where("event_id % 3 = 0"), p.where("event_id % 3 = 0")):
        table.upsert(part, ["unit", "cycle"], ["timestamp_ms", "event_id"])
    return table.read()


def _rewrite(s, d):
    """Replacing units touches only their buckets."""
    p = v.packets(s, d).select("unit", "cycle", "s1")
    table = _versioned(s, "units", p)
    table.replace_units(p.where("unit % 2 = 0").withColumn("s1", F.col("s1") + 1000))
    table.delete(p.where("unit % 5 = 0").select("unit"))
    return table.read().groupBy("unit").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("s1"), 3).alias("sum_s1"))


def _snapshot(s, d):
    """A snapshot by name, after later versions have dropped and compacted what it holds."""
    table = _versioned(s, "snap", v.scores(s, d))
    table.snapshot("before")
    table.delete(v.scores(s, d).where("unit % 2 = 0").select("unit"))
    table.append(v.scores(s, d).limit(3))
    table.compact(1)
    table.vacuum()
    return table.read("before")


def _materialized(s, d):
    path = v.scratch(s, "stage")
    first = sinks.materialize(profile.cycle_density(v.telemetry(s, d)), path)
    # The second call finds the finished stage and does not run its input.
    again = sinks.materialize(first.limit(0), path)
    return again


def _messages(s, d):
    return bus.encode_packets(v.packets(s, d).select("unit", "cycle", "s1", "timestamp_ms"), "timestamp_ms")


def _round_trip(s, d):
    path = v.scratch(s, "bus")
    bus.send_packets(_messages(s, d), "json", {"path": path})
    back = bus.decode_packets(s.read.schema(bus.WIRE_SCHEMA).json(path), ["s1"])
    return back.select(F.col("unit").cast("long").alias("unit"), "cycle", "timestamp_ms", "s1")


def _mean_scorer(batch):
    import numpy as np
    x = batch.mean(axis=(1, 2))
    return np.stack([np.log1p(np.exp(-np.abs(x))) + np.maximum(x, 0), np.ones(len(x))], axis=1)


def _user_scorer(s, d):
    w = _windows5(s, d).select("event_id", "window")
    out = scoring.score_windows(w, _mean_scorer, ["s1", "s2"], 5)
    return out.select("event_id", F.round("predicted_rul", 5).alias("predicted_rul"), "predicted_std")


def _series_scorer(s, d):
    """The same scores from blocks of rows, each sent to the scorer's task once."""
    p = v.packets(s, d).select("event_id", "unit", "timestamp_ms", "s1", "s2")
    out = scoring.score_series(p, _mean_scorer, ["s1", "s2"], P_ORDER, 5, block=64)
    return out.select("event_id", F.round("predicted_rul", 5).alias("predicted_rul"), "predicted_std")


def _status(df):
    out = windows.latest_status(df, P_ORDER if "event_id" in df.columns else ["cycle", "timestamp_ms"])
    return r(out, 6, "predicted_rul", "predicted_std", "uncertainty", "uncertainty_delta")


def _scored_status(s, d):
    """Scalers, z-scores, windows, linear score, latest status per unit."""
    p = v.packets(s, d)
    stats = scaling.compute_scalers(p.withColumn("dataset", F.col("node")), ["s1", "s2"])
    z = zscore(p, stats, ["s1", "s2"])
    w = windows.sliding_windows(z, ["s1", "s2"], P_ORDER, 5)
    scored = scoring.linear_score(w, {"s1": 1.5, "s2": -0.5}, 20.0, 0.5)
    scored = scored.withColumn("true_rul", F.lit(31) - F.col("cycle"))
    return _status(scored)


SCORED_STATUS_SQL = """
st AS (SELECT sum(t1) / sum(n) AS m1, sqrt(greatest(sum(v1) / sum(n), 1e-9)) AS d1,
              sum(t2) / sum(n) AS m2, sqrt(greatest(sum(v2) / sum(n), 1e-9)) AS d2
       FROM (SELECT node, count(*) AS n, sum(s1) AS t1, var_samp(s1) * (count(*) - 1) AS v1, sum(s2) AS t2,
                    var_samp(s2) * (count(*) - 1) AS v2 FROM packets GROUP BY node)),
win AS (SELECT unit, cycle, timestamp_ms, event_id, avg((s1 - m1) / d1) OVER w AS z1, avg((s2 - m2) / d2) OVER w AS z2,
               count(*) OVER w AS n
        FROM packets, st WINDOW w AS (PARTITION BY unit ORDER BY timestamp_ms, event_id ROWS 4 PRECEDING)),
raw AS (SELECT *, 20 + 1.5 * z1 - 0.5 * z2 AS x,
               row_number() OVER (PARTITION BY unit ORDER BY timestamp_ms DESC, event_id DESC) AS back
        FROM win WHERE n = 5)"""


ENTRIES = [
    # --- windows
    Entry("w1_moving_average", lambda s, d: r(windows.moving_average(v.telemetry(s, d), ["s1", "s2"], v.ORDER), 6, "s1", "s2")
          .select(*KEYS, "s1", "s2"),
          oracle(f"""SELECT {KEY_SQL}, round(avg(s1) OVER w, 6) AS s1, round(avg(s2) OVER w, 6) AS s2 FROM telemetry
                    WINDOW w AS ({BY_CYCLE} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""", v.TELEMETRY)),
    Entry("w2_sliding_windows", lambda s, d: window_facts(
              windows.sliding_windows(v.packets(s, d), ["s1", "s2"], P_ORDER, 30), "unit", "event_id"),
          oracle(f"""SELECT unit, event_id, first_s1, last_s2, sum_s1 FROM (SELECT unit, event_id, {WINDOW_FACTS}
                    FROM packets WINDOW w AS ({BY_TIME} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) WHERE n = 30""",
                 v.PACKETS)),
    Entry("w2_session_windows", lambda s, d: window_facts(
              windows.sliding_windows(v.sessions(s, d), ["s1", "s2"], P_ORDER, 5, ["unit", "session_id"]),
              "unit", "session_id", "event_id"),
          oracle(f"""SELECT unit, session_id, event_id, first_s1, last_s2, sum_s1 FROM
                    (SELECT unit, session_id, event_id, {WINDOW_FACTS} FROM sessions
                     WINDOW w AS (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id
                                  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""", v.SESSIONS)),
    Entry("w2_windows_dropping_first", lambda s, d: window_facts(
              windows.sliding_windows(v.sessions(s, d), ["s1", "s2"], P_ORDER, 5, ["unit", "session_id"],
                                      compat_drop_first=True), "unit", "session_id", "event_id"),
          oracle(f"""SELECT unit, session_id, event_id, first_s1, last_s2, sum_s1 FROM
                    (SELECT unit, session_id, event_id, {WINDOW_FACTS} FROM
                       (SELECT *, row_number() OVER (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id) AS rn
                        FROM sessions) WHERE session_id = 0 OR rn > 1
                     WINDOW w AS (PARTITION BY unit, session_id ORDER BY timestamp_ms, event_id
                                  ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""", v.SESSIONS)),
    Entry("w3_session_ids", lambda s, d: v.sessions(s, d).select("event_id", "unit", "cycle", "session_id"),
          oracle("SELECT event_id, unit, cycle, session_id FROM sessions", v.SESSIONS)),
    Entry("w4_stride_sample", lambda s, d: windows.stride_sample(v.telemetry(s, d), v.ORDER, 10).select(*KEYS, "s1"),
          oracle(f"""SELECT {KEY_SQL}, s1 FROM (SELECT *, row_number() OVER ({BY_CYCLE}) - 1 AS i,
                      greatest(1, count(*) OVER (PARTITION BY unit, cycle) // 10) AS step FROM telemetry)
                    WHERE i % step = 0 AND i // step < 10""", v.TELEMETRY)),
    Entry("w5_training_windows", _train_windows,
          oracle("""SELECT a.unit, a.window_start, f.s1 AS first_s1, l.s2 AS last_s2, 25 AS steps, l.rul AS label
                    FROM starts a JOIN thin f ON f.unit = a.unit AND f.t = a.window_start
                    JOIN thin l ON l.unit = a.unit AND l.t = a.window_start + 24""",
                 v.TELEMETRY, train_sql("telemetry", "unit", 2, 25, 10))),
    Entry("w6_label_jitter", lambda s, d: r(windows.label_jitter(v.scores(s, d), P_ORDER, "predicted_rul"), 6, "label_diff")
          .select("unit", "event_id", "predicted_rul", "label_diff"),
          oracle(f"""SELECT unit, event_id, predicted_rul, round(diff, 6) AS label_diff FROM
                    (SELECT *, predicted_rul - lag(predicted_rul) OVER ({BY_TIME}) AS diff FROM scores) WHERE diff > 0""",
                 v.SCORES)),
    Entry("w7_latest_status", lambda s, d: _status(v.scores(s, d)),
          oracle(f"""SELECT unit, max(cycle) FILTER (WHERE b = 1) AS current_cycle,
                      round(max(predicted_rul) FILTER (WHERE b = 1), 6) AS predicted_rul,
                      max(true_rul) FILTER (WHERE b = 1) AS true_rul,
                      round(max(predicted_std) FILTER (WHERE b = 1), 6) AS predicted_std,
                      round(max(predicted_std) FILTER (WHERE b = 1) * 1.96, 6) AS uncertainty,
                      round(coalesce(max(predicted_std) FILTER (WHERE b = 1)
                                     - max(predicted_std) FILTER (WHERE b = 2), 0), 6) AS uncertainty_delta
                    FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY timestamp_ms DESC, event_id DESC) AS b
                          FROM scores) GROUP BY unit""", v.SCORES)),
    Entry("w8_first_where", lambda s, d: profile.first_where(
              v.telemetry(s, d), F.col("s1") > 48, "cycle", v.ORDER, ["unit"], "start_cycle"),
          oracle(f"""SELECT unit, coalesce(first(cycle ORDER BY {ORD}) FILTER (WHERE s1 > 48), -1) AS start_cycle
                    FROM telemetry GROUP BY unit""", v.TELEMETRY)),
    Entry("w9_lowess", lambda s, d: smoothing.lowess(
              v.scores(s, d).select("unit", "cycle", "event_id", "predicted_rul"), "cycle", "predicted_rul", 0.2)),
    Entry("w9_local_fit", lambda s, d: r(smoothing.lowess(
              v.scores(s, d).select("unit", "cycle", "event_id", "predicted_rul"), "cycle", "predicted_rul", 0.3, iters=0), 6, "predicted_rul_smooth")
          .select("unit", "event_id", "predicted_rul_smooth"),
          oracle("""SELECT unit, event_id, round(CASE WHEN total < 5 THEN predicted_rul ELSE fit END, 6) AS predicted_rul_smooth
                    FROM scores JOIN fits USING (unit, cycle)""", v.SCORES, LOCAL_FIT)),
    Entry("w10_elapsed_index", lambda s, d: windows.elapsed_index(v.telemetry(s, d), v.ORDER).select(*KEYS, "elapsed"),
          oracle(f"SELECT {KEY_SQL}, row_number() OVER ({BY_UNIT}) - 1 AS elapsed FROM telemetry", v.TELEMETRY)),
    Entry("w11_head_tail", lambda s, d: profile.head_tail(v.metric_log(s, d), ["tag"], ["step"], 5)
          .select("tag", "step", "value", "end"),
          oracle("""SELECT tag, step, value, e AS "end" FROM (
                      SELECT *, 'head' AS e, row_number() OVER (PARTITION BY tag ORDER BY step) AS rn FROM metric_log
                      UNION ALL SELECT *, 'tail', row_number() OVER (PARTITION BY tag ORDER BY step DESC)
                      FROM metric_log) WHERE rn <= 5""", v.METRIC_LOG)),
    Entry("w12_chart_buckets", lambda s, d: windows.chart_buckets(v.metric_log(s, d), ["tag"], ["step"], "value")
          .select("tag", "column_idx", "value", "level"),
          oracle("""SELECT b.tag, i AS column_idx, value, cast(ceil((value - lo) / (hi - lo) * 10) AS bigint) AS level
                    FROM (SELECT tag, value, row_number() OVER (PARTITION BY tag ORDER BY step) - 1 AS rn FROM metric_log) a
                    JOIN (SELECT tag, count(*) AS n, min(value) AS lo, max(value) AS hi, unnest(range(60)) AS i
                          FROM metric_log GROUP BY tag) b ON a.tag = b.tag AND a.rn = i * n // 60""", v.METRIC_LOG)),
    Entry("w13_piecewise_rul", lambda s, d: windows.piecewise_rul(v.telemetry_rul(s, d), F.col("s1") < 40)
          .select(*KEYS, "rul_capped"),
          oracle(f"""SELECT {KEY_SQL}, least(rul, coalesce(max(rul) FILTER (WHERE NOT s1 < 40)
                    OVER (PARTITION BY unit), rul)) AS rul_capped FROM telemetry""", v.TELEMETRY)),
    Entry("w14_raw_rul", lambda s, d: v.telemetry_rul(s, d).select(*KEYS, "rul"),
          oracle(f"SELECT {KEY_SQL}, rul FROM telemetry", v.TELEMETRY)),
    Entry("w15_reservoir", lambda s, d: windows.reservoir(v.metric_log(s, d), ["tag"], 100, 7)
          .select("tag", "step", "value"),
          oracle("""SELECT tag, step, value FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY md5('7:' || step), step) AS n
                    FROM metric_log) WHERE n <= 100""", v.METRIC_LOG)),
    # --- sinks
    Entry("k1_fleet_schema_append", _append,
          oracle("""SELECT cast(unit AS integer) AS unit, count(*) AS rows, max(cycle) AS max_cycle,
                    round(avg(cast(CASE WHEN abs(s2) > 15 THEN s2 ELSE s2 * 12.5 + 40 END AS float)), 3) AS mean_s2
                    FROM packets GROUP BY unit""", v.PACKETS)),
    Entry("k3_upsert_latest", _upsert,
          oracle("""SELECT unit, cycle, timestamp_ms, event_id, s1 FROM (SELECT *, row_number() OVER
                    (PARTITION BY unit, cycle ORDER BY timestamp_ms DESC, event_id DESC) AS rn FROM packets)
                    WHERE rn = 1""", v.PACKETS)),
    Entry("k3_upsert_versions", _upsert_versions,
          oracle("""SELECT unit, cycle, timestamp_ms, event_id, s1 FROM (SELECT *, row_number() OVER
                    (PARTITION BY unit, cycle ORDER BY timestamp_ms DESC, event_id DESC) AS rn FROM packets)
                    WHERE rn = 1""", v.PACKETS)),
    Entry("k4_drop_stale_sessions", lambda s, d: sinks.drop_stale_sessions(v.sessions(s, d))
          .select("event_id", "unit", "session_id"),
          oracle("""SELECT event_id, unit, session_id FROM (SELECT *, max(session_id) OVER (PARTITION BY unit) AS last
                    FROM sessions) WHERE session_id = last""", v.SESSIONS)),
    Entry("k4_partition_overwrite", _rewrite,
          oracle("""SELECT unit, count(*) AS rows,
                    round(sum(CASE WHEN unit % 2 = 0 THEN s1 + 1000 ELSE s1 END), 3) AS sum_s1
                    FROM packets WHERE unit % 5 <> 0 GROUP BY unit""", v.PACKETS)),
    Entry("k5_snapshot", _snapshot, oracle("SELECT * FROM scores", v.SCORES)),
    Entry("k6_split_partitions", _prep_write,
          oracle("""SELECT dataset, split, count(*) AS rows, round(avg(s1), 6) AS mean_s1 FROM prepared
                    GROUP BY dataset, split""", v.TELEMETRY, SPLIT_SQL, _stat_cte())),
    Entry("k7_encode_packets", lambda s, d: _messages(s, d).select(
              "key", F.get_json_object("value", "$.unit").cast("long").alias("unit"),
              F.get_json_object("value", "$.s1").cast("double").alias("s1"),
              F.get_json_object("value", "$.timestamp_ms").cast("long").alias("timestamp_ms")),
          oracle("SELECT cast(unit AS varchar) AS key, unit, s1, timestamp_ms FROM packets", v.PACKETS)),
    Entry("k7_bus_round_trip", _round_trip,
          oracle("SELECT unit, cycle, timestamp_ms, s1 FROM packets", v.PACKETS)),
    Entry("k9_materialize", _materialized,
          oracle("SELECT unit, cycle, count(*) AS rows FROM telemetry GROUP BY unit, cycle", v.TELEMETRY)),
    Entry("k10_new_files_only", lambda s, d: sinks.new_files_only(
              v.artifacts(s, d), v.artifacts(s, d).where("mtime_s % 3 = 0"), ["path", "length"]),
          oracle("SELECT * FROM artifacts WHERE mtime_s % 3 <> 0", v.ARTIFACTS)),
    # --- training data
    Entry("r1_fleet_sample", _fleet,
          oracle(f"""SELECT {KEY_SQL}, s1 FROM (SELECT t.*, k, row_number() OVER ({BY_CYCLE}) - 1 AS i,
                      greatest(1, count(*) OVER (PARTITION BY unit, cycle) // k) AS step
                    FROM telemetry t JOIN (VALUES (11, 10), (14, 5), (15, 20)) c(u, k) ON u = unit)
                    WHERE i % step = 0 AND i // step < k""", v.TELEMETRY)),
    Entry("r2_validation_units", lambda s, d: prep.choose_validation_units(
              v.telemetry(s, d).where("split <> 'test'"), 0.1, None),
          oracle("SELECT unit, rows FROM val_units", v.TELEMETRY, SPLIT_SQL)),
    Entry("r2_validation_units_hashed", lambda s, d: prep.choose_validation_units(
              v.telemetry(s, d).where("split <> 'test'"), 0.1, 42)),
    Entry("r3_extract_splits", lambda s, d: prep.extract_splits(
              v.telemetry(s, d), prep.choose_validation_units(v.telemetry(s, d).where("split <> 'test'"), 0.1, None))
          .select(*KEYS, "part"),
          oracle(f"SELECT {KEY_SQL}, split AS part FROM parts", v.TELEMETRY, SPLIT_SQL)),
    Entry("r4_prepare", lambda s, d: r(_prepared(s, d), 5, *S).select(*KEYS, "split", *S, "rul"),
          oracle(f"""SELECT {KEY_SQL}, split, {', '.join(f'round({f}, 5) AS {f}' for f in S)}, rul FROM prepared""",
                 v.TELEMETRY, SPLIT_SQL, _stat_cte())),
    Entry("r4_prepare_smoothed", lambda s, d: r(prep.prepare(
              v.telemetry_rul(s, d), replace(CFG, smooth=True)), 5, *S).select(*KEYS, "split", *S),
          oracle(f"""SELECT {KEY_SQL}, split, {', '.join(f'round(avg({f}) OVER w, 5) AS {f}' for f in S)} FROM prepared
                    WINDOW w AS ({BY_CYCLE} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
                 v.TELEMETRY, SPLIT_SQL, _stat_cte())),
    Entry("r5_window_dataset", _window_set,
          oracle(WINDOW_SET_SQL, v.TELEMETRY, SPLIT_SQL, _stat_cte(),
                 train_sql("prepared", "dataset, split, unit", 3, 30, 10))),
    Entry("r5_window_counts", lambda s, d: prep.window_counts(prep.window_dataset(_prepared(s, d), CFG)),
          oracle("SELECT split, count(*) AS nb_lines FROM starts GROUP BY split", v.TELEMETRY, SPLIT_SQL, _stat_cte(),
                 train_sql("prepared", "dataset, split, unit", 3, 30, 10))),
    Entry("r6_check_normalization", _check_norm,
          oracle("""SELECT unnest(['s1', 's2', 's3', 's4']) AS feature, 0.0::double AS max_abs_diff, true AS ok
                    FROM (SELECT count(*) AS n FROM telemetry) WHERE n > 0""", v.TELEMETRY)),
    Entry("r7_compare_runs", lambda s, d: prep.compare_runs(_runs(s, d), patterns=PATTERNS),
          """SELECT c_custkey AS run, p AS parameter, CASE p WHEN 'model_name' THEN 'net-' || c_custkey
               WHEN 'dataset_size' THEN cast(c_nationkey AS varchar)
               ELSE CASE WHEN c_custkey % 3 = 0 THEN 'N/A' ELSE '0.5' END END AS value
             FROM customer, (SELECT unnest(['model_name', 'dataset_size', 'q_scale']) AS p)"""),
    Entry("r7_runs_side_by_side", lambda s, d: prep.runs_side_by_side(
              _runs(s, d).withColumn("run", F.concat(F.lit("run"), F.col("run").cast("string"))),
              ["run1", "run3"], patterns=PATTERNS),
          """SELECT p AS parameter,
               max(CASE p WHEN 'model_name' THEN 'net-1' WHEN 'dataset_size' THEN cast(c_nationkey AS varchar)
                   ELSE '0.5' END) FILTER (WHERE c_custkey = 1) AS run1,
               max(CASE p WHEN 'model_name' THEN 'net-3' WHEN 'dataset_size' THEN cast(c_nationkey AS varchar)
                   ELSE 'N/A' END) FILTER (WHERE c_custkey = 3) AS run3
             FROM customer, (SELECT unnest(['model_name', 'dataset_size', 'q_scale']) AS p) GROUP BY p"""),
    # --- scoring
    Entry("e1_score_series", _series_scorer,
          oracle(f"""SELECT event_id, round(greatest(m, 0.0) + ln(1 + exp(-abs(m))), 5) AS predicted_rul,
                      1.0::double AS predicted_std
                    FROM (SELECT event_id, avg((s1 + s2) / 2) OVER w AS m, count(*) OVER w AS n FROM packets
                          WINDOW w AS ({BY_TIME} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""", v.PACKETS)),
    Entry("e1_score_windows", _user_scorer,
          oracle(f"""SELECT event_id, round(greatest(m, 0.0) + ln(1 + exp(-abs(m))), 5) AS predicted_rul,
                      1.0::double AS predicted_std
                    FROM (SELECT event_id, avg((s1 + s2) / 2) OVER w AS m, count(*) OVER w AS n FROM packets
                          WINDOW w AS ({BY_TIME} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""", v.PACKETS)),
    Entry("f12_flatten_window", lambda s, d: _windows5(s, d).select(
              "event_id", F.array_join(F.transform(scalars.flatten_window("window", ["s1", "s2"]),
                                                   lambda x: F.format_string("%.2f", x)), ",").alias("flat")),
          oracle(f"""SELECT event_id, array_to_string(list_transform(list_concat(a, b), lambda x: printf('%.2f', x)), ',') AS flat
                    FROM (SELECT event_id, list(s1) OVER w AS a, list(s2) OVER w AS b FROM packets
                          WINDOW w AS ({BY_TIME} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE len(a) = 5""", v.PACKETS)),
    Entry("m3_scored_status", _scored_status,
          oracle("""SELECT unit, cycle AS current_cycle, round(x + ln(1 + exp(-x)), 6) AS predicted_rul, 31 - cycle AS true_rul,
                      round(0.5 + ln(1 + exp(-0.5)), 6) AS predicted_std,
                      round((0.5 + ln(1 + exp(-0.5))) * 1.96, 6) AS uncertainty, 0.0::double AS uncertainty_delta
                    FROM raw WHERE back = 1""", v.PACKETS, SCORED_STATUS_SQL)),
]
