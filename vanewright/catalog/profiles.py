"""Aggregation entries (A)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.catalog import views as v
from vanewright.catalog.views import Entry, oracle
from vanewright.operators import metrics, profile, scaling, windows
from vanewright.operators.text import manifest_counts

S = v.SENSORS


def r(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round for comparison."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


FEATURE_LIST = ", ".join(f"'{s}'" for s in S)
DESCRIBE = """
  round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
  round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max"""


def describe(df: DataFrame) -> DataFrame:
    return r(df, 6, "mean", "std", "q25", "q50", "q75")


def _windows5(spark, d):
    return windows.sliding_windows(v.packets(spark, d), ["s1", "s2"], v.PACKET_ORDER, 5)


def _pairs(spark, d):
    p = v.packets(spark, d)
    from vanewright.operators.joins import pair_by_row
    norm = p.select("unit", "event_id", "timestamp_ms",
                    ((F.col("s1") - 50.0) / 47.5).alias("s1"), ((F.col("s2") - 40.0) / 12.5).alias("s2"))
    raw = p.select("unit", "event_id", "timestamp_ms", "s1", "s2")
    return pair_by_row(raw, norm, "unit", v.PACKET_ORDER, 1000)


def _parts(spark, d):
    p = v.packets(spark, d)
    return {"W": p.select("event_id", "s1", "s2"), "A": p.select("event_id", "unit", "cycle"),
            "Y": p.select("event_id", (F.lit(30) - F.col("cycle")).alias("rul"))}


CALIBRATION = """
SELECT bin, expected, round(avg(CASE WHEN {hit} THEN 1.0 ELSE 0.0 END), 6) AS observed
FROM (SELECT (y_pred - y_true) / y_std AS r FROM predictions),
     (SELECT * FROM (VALUES {values}) t(bin, expected, z))
GROUP BY bin, expected"""


def _grid(kind: str) -> str:
    from statistics import NormalDist
    rows = []
    for i in range(11):
        p = i / 10
        q = p if kind == "quantile" else 0.5 + p / 2
        z = 1e30 if q >= 1 else -1e30 if q <= 0 else NormalDist().inv_cdf(q)
        rows.append(f"({i}, cast({p!r} AS double), cast({z!r} AS double))")
    return ", ".join(rows)


def _calibration_sql(kind: str) -> str:
    hit = "r <= z" if kind == "quantile" else "abs(r) <= z"
    return oracle(CALIBRATION.format(hit=hit, values=_grid(kind)), v.PREDICTIONS)


SOLVED = """
SELECT unit, f.feature, cast(CASE f.feature WHEN 's1' THEN 50.0 ELSE 40.0 END AS double) AS mean,
       cast(CASE f.feature WHEN 's1' THEN 47.5 ELSE 12.5 END AS double) AS std
FROM (SELECT DISTINCT unit FROM packets), (SELECT unnest(['s1', 's2']) AS feature) f"""

SCALER_SQL = """
per_set AS (
  SELECT dataset, feature, sum(v) AS total, coalesce(var_samp(v), 0) * (count(v) - 1) AS ss,
         count(v) AS n
  FROM long_telemetry WHERE split = 'dev' GROUP BY dataset, feature)"""

KPI_TARGETS = {"1-URGENT": 80000.0, "2-HIGH": 250000.0, "3-MEDIUM": 120000.0}

KPI_SQL = """
ends AS (SELECT tag, arg_min(value, step) AS initial, arg_max(value, step) AS current
         FROM metric_log GROUP BY tag)"""

KDE_SQL = """
base AS (SELECT fc, s2 AS x FROM telemetry),
st AS (SELECT fc, count(*) AS n, min(x) AS lo, max(x) AS hi,
              stddev_samp(x) * pow(count(*), -0.2) AS bw FROM base GROUP BY fc),
hist AS (SELECT b.fc, least(floor((x - lo) / (hi - lo) * 512), 511) AS slot, count(*) AS c
         FROM base b JOIN st ON b.fc = st.fc GROUP BY 1, 2),
grid AS (SELECT fc, n, lo, hi, bw, cast(i AS integer) AS grid_idx,
                lo - 3 * bw + (hi - lo + 6 * bw) / 99 * i AS x
         FROM st, (SELECT unnest(range(100)) AS i))"""

def _plain_rows(s, d):
    """Telemetry with values whose text is the same in every engine, and some nulls."""
    return v.telemetry(s, d).select("dataset", "split", "unit", "cycle", F.col("s1").cast("decimal(12,2)").alias("s1"),
                                    F.when(F.col("s3") > 0.02, F.col("s3").cast("decimal(12,2)")).alias("s3"))


ENTRIES = [
    Entry("a1_state_audit", lambda s, d: profile.state_audit(v.telemetry(s, d), "s1"),
          oracle("""SELECT count(*) AS rows, round(avg(s1), 2) AS mean, round(stddev_samp(s1), 2) AS std,
                    min(s1) AS min, max(s1) AS max FROM telemetry""", v.TELEMETRY)),
    Entry("a2_unit_distribution", lambda s, d: profile.unit_distribution(v.telemetry(s, d)),
          oracle("SELECT unit, count(*) AS rows, max(cycle) AS max_cycle FROM telemetry GROUP BY unit",
                 v.TELEMETRY)),
    Entry("a3_cycle_density", lambda s, d: profile.cycle_density(v.telemetry(s, d)),
          oracle("SELECT unit, cycle, count(*) AS rows FROM telemetry GROUP BY unit, cycle", v.TELEMETRY)),
    Entry("a4_cycle_density_summary",
          lambda s, d: describe(profile.cycle_density_summary(v.telemetry(s, d))),
          oracle("SELECT unit, count(*) AS count, " + DESCRIBE + """
                  FROM (SELECT unit, cast(count(*) AS double) AS v FROM telemetry GROUP BY unit, cycle)
                  GROUP BY unit""", v.TELEMETRY)),
    Entry("a5_describe_features", lambda s, d: describe(profile.describe_features(v.telemetry(s, d), S)),
          oracle("SELECT feature, count(v) AS count, " + DESCRIBE + " FROM long_telemetry GROUP BY feature",
                 v.LONG_TELEMETRY)),
    Entry("a5_describe_features_by_unit",
          lambda s, d: describe(profile.describe_features(v.telemetry(s, d), S, ["unit"])),
          oracle("SELECT unit, feature, count(v) AS count, " + DESCRIBE +
                 " FROM long_telemetry GROUP BY unit, feature", v.LONG_TELEMETRY)),
    Entry("a6_hygiene", lambda s, d: profile.hygiene(
              v.telemetry(s, d).withColumn("s3", F.when(F.col("s3") < 0.02, F.lit(None)).otherwise(F.col("s3")))
               .withColumn("s4", F.when(F.col("s4") > 0.07, F.lit(float("nan"))).otherwise(F.col("s4"))), S),
          oracle("""SELECT feature,
                      count(*) FILTER (WHERE feature = 's3' AND v < 0.02) AS null_count,
                      count(*) FILTER (WHERE feature = 's4' AND v > 0.07) AS nan_count,
                      count(*) FILTER (WHERE v = 0 AND feature <> 's3') AS zero_count
                    FROM long_telemetry GROUP BY feature""", v.LONG_TELEMETRY)),
    Entry("a7_operational_envelopes",
          lambda s, d: r(profile.operational_envelopes(v.telemetry(s, d), S), 6, "mean", "std"),
          oracle("""SELECT unit, feature, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
                    round(stddev_pop(v), 6) AS std FROM long_telemetry GROUP BY unit, feature""",
                 v.LONG_TELEMETRY)),
    Entry("a8_sensor_fidelity",
          lambda s, d: r(profile.sensor_fidelity(v.telemetry(s, d), S), 6, "mean", "std"),
          oracle("""SELECT feature, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean,
                    round(stddev_pop(v), 6) AS std, cast(0 AS bigint) AS nan_count,
                    count(*) FILTER (WHERE v = 0) AS zero_count FROM long_telemetry GROUP BY feature""",
                 v.LONG_TELEMETRY)),
    Entry("a9_unit_profiles", lambda s, d: profile.unit_profiles(v.telemetry(s, d), v.ORDER).withColumn(
              "classes", F.concat_ws(",", F.transform("classes", lambda c: c.cast("string")))),
          oracle("""SELECT unit, count(*) AS rows, count(DISTINCT cycle) AS cycles, min(cycle) AS min_cycle,
                      max(cycle) AS max_cycle,
                      coalesce(first(cycle ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey)
                               FILTER (WHERE hs = 1), -1) AS hs_start_cycle,
                      string_agg(DISTINCT cast(fc AS varchar), ',' ORDER BY cast(fc AS varchar)) AS classes
                    FROM telemetry GROUP BY unit""", v.TELEMETRY)),
    Entry("a10_calibration_interval",
          lambda s, d: r(metrics.calibration_curve(v.predictions(s, d), 11, "interval"), 6, "observed"),
          _calibration_sql("interval")),
    Entry("a10_calibration_quantile",
          lambda s, d: r(metrics.calibration_curve(v.predictions(s, d), 11, "quantile"), 6, "observed"),
          _calibration_sql("quantile")),
    Entry("a11_kde", lambda s, d: metrics.kde(v.telemetry(s, d), "s2", ["fc"]).select(
              "fc", "grid_idx", F.round("x", 3).alias("x"), F.round(F.col("density") * 1e6, 4).alias("density_e6")),
          oracle("""SELECT g.fc, grid_idx, round(g.x, 3) AS x, round(1e6 * sum(c *
                      exp(-0.5 * pow((g.x - (lo + (slot + 0.5) * (hi - lo) / 512)) / bw, 2)))
                      / (n * bw * 2.5066282746310002), 4) AS density_e6
                    FROM grid g JOIN hist h ON g.fc = h.fc GROUP BY g.fc, grid_idx, g.x, n, bw""",
                 v.TELEMETRY, KDE_SQL)),
    Entry("a12_scalers_within", lambda s, d: r(scaling.compute_scalers(
              v.telemetry(s, d).where("split = 'dev'"), S), 6, "mean", "std"),
          oracle("""SELECT feature, round(sum(total) / sum(n), 6) AS mean,
                    round(sqrt(greatest(sum(ss) / sum(n), 1e-9)), 6) AS std FROM per_set GROUP BY feature""",
                 v.LONG_TELEMETRY, SCALER_SQL)),
    Entry("a12_scalers_total", lambda s, d: r(scaling.compute_scalers(
              v.telemetry(s, d).where("split = 'dev'"), S, pooled="total"), 6, "mean", "std"),
          oracle("""SELECT feature, round(avg(v), 6) AS mean,
                    round(sqrt(greatest(var_pop(v), 1e-9)), 6) AS std
                    FROM long_telemetry WHERE split = 'dev' GROUP BY feature""", v.LONG_TELEMETRY)),
    Entry("a13_dataset_fingerprint",
          lambda s, d: profile.dataset_fingerprint(_plain_rows(s, d), ["dataset"]).withColumn("row_sum", F.col("row_sum").cast("string")),
          oracle(f"""SELECT dataset, bit_xor(cast('0x' || substr(m, 1, 15) AS bigint)) AS row_xor,
                      cast(sum(cast('0x' || substr(m, 17, 15) AS bigint)) AS varchar) AS row_sum, count(*) AS rows FROM
                    (SELECT dataset, md5({" || ".join(f"coalesce(length({x}) || ':' || {x}, '-')" for x in (
                        "dataset", "split", "cast(unit AS varchar)", "cast(cycle AS varchar)", "cast(cast(s1 AS decimal(12,2)) AS varchar)",
                        "CASE WHEN s3 > 0.02 THEN cast(cast(s3 AS decimal(12,2)) AS varchar) END"))}) AS m FROM telemetry)
                    GROUP BY dataset""", v.TELEMETRY)),
    Entry("a14_window_minmax", lambda s, d: scaling.window_minmax(_windows5(s, d), ["s1", "s2"]),
          oracle("""SELECT f.feature, min(CASE f.feature WHEN 's1' THEN s1 ELSE s2 END) AS min_sample,
                           max(CASE f.feature WHEN 's1' THEN s1 ELSE s2 END) AS max_sample
                    FROM (SELECT s1, s2, count(*) OVER (PARTITION BY unit) AS n FROM packets),
                         (SELECT unnest(['s1', 's2']) AS feature) f
                    WHERE n >= 5 GROUP BY f.feature""", v.PACKETS)),
    Entry("a15_segment_integrity",
          lambda s, d: profile.segment_integrity(_parts(s, d), "Y", "rul"),
          oracle("""SELECT count(*) AS total_rows, true AS aligned, min(30 - cycle) AS label_min,
                    max(30 - cycle) AS label_max FROM packets""", v.PACKETS)),
    Entry("a16_fleet_stats", lambda s, d: profile.fleet_stats(v.telemetry(s, d)),
          oracle("""SELECT split, count(DISTINCT unit) AS units, count(*) AS rows FROM telemetry GROUP BY split
                    UNION ALL SELECT 'all', count(DISTINCT unit), count(*) FROM telemetry""", v.TELEMETRY)),
    Entry("a16_split_units", lambda s, d: profile.split_units(v.telemetry(s, d)),
          oracle("SELECT DISTINCT split, unit FROM telemetry", v.TELEMETRY)),
    Entry("a17_flight_conditions",
          lambda s, d: r(profile.flight_conditions(v.telemetry(s, d), S, "dataset"), 6, "mean"),
          oracle("""SELECT dataset, feature, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean
                    FROM long_telemetry GROUP BY dataset, feature""", v.LONG_TELEMETRY)),
    Entry("a18_label_profile", lambda s, d: profile.label_profile(v.telemetry_rul(s, d).where("split = 'test'")),
          oracle("""SELECT unit, count(*) AS rows, count(DISTINCT cycle) AS cycles, min(rul) AS min_label,
                    max(rul) AS max_label FROM telemetry WHERE split = 'test' GROUP BY unit""", v.TELEMETRY)),
    Entry("a19_normalization_params",
          lambda s, d: r(profile.normalization_params(v.telemetry(s, d), S), 6, "mean", "std"),
          oracle("""SELECT feature, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std
                    FROM long_telemetry GROUP BY feature""", v.LONG_TELEMETRY)),
    Entry("a20_solve_affine", lambda s, d: r(scaling.solve_affine(
              _pairs(s, d), ["s1", "s2"], ["unit"]), 6, "mean", "std"),
          oracle(SOLVED, v.PACKETS)),
    Entry("a21_domain_identifiers", lambda s, d: profile.domain_identifiers(v.telemetry(s, d), ["unit", "fc"]),
          oracle("""SELECT DISTINCT 'unit' AS column_name, cast(unit AS bigint) AS value FROM telemetry
                    UNION ALL SELECT DISTINCT 'fc', cast(fc AS bigint) FROM telemetry""", v.TELEMETRY)),
    Entry("a21_table_shape", lambda s, d: profile.table_shape(v.telemetry_rul(s, d)),
          oracle("""SELECT count(*) AS rows, max(cycle) AS max_cycle, 15 AS columns FROM telemetry""",
                 v.TELEMETRY)),
    Entry("a22_end_of_failure", lambda s, d: profile.end_of_failure(v.telemetry(s, d)),
          oracle("SELECT unit, count(DISTINCT cycle) AS eof_cycles FROM telemetry GROUP BY unit", v.TELEMETRY)),
    Entry("a23_constant_label_audit", lambda s, d: profile.constant_label_audit(
              v.telemetry(s, d).withColumn("s3", F.when(F.col("unit") % 4 == 0, F.lit(1.0)).otherwise(F.col("s3"))),
              "s3"),
          oracle("""SELECT unit, count(DISTINCT CASE WHEN unit % 4 = 0 THEN 1.0 ELSE s3 END) = 1
                    AS constant_label FROM telemetry GROUP BY unit""", v.TELEMETRY)),
    Entry("a24_kpi_table", lambda s, d: r(metrics.kpi_table(v.metric_log(s, d), KPI_TARGETS), 6, "distance_pct"),
          oracle("""SELECT tag, initial, current, target,
                      CASE WHEN current > target THEN round((current - target) / target * 100, 6) END AS distance_pct,
                      CASE WHEN current > target THEN printf('%+.1f%%', (current - target) / target * 100)
                             || ' to target'
                           WHEN current <= target THEN 'REACHED' ELSE '' END AS distance,
                      CASE WHEN current < initial THEN 'IMPROVING' ELSE 'STABLE' END AS trend
                    FROM (SELECT *, CASE tag WHEN '1-URGENT' THEN 80000.0::double WHEN '2-HIGH' THEN 250000.0::double
                                             WHEN '3-MEDIUM' THEN 120000.0::double END AS target FROM ends)""",
                 v.METRIC_LOG, KPI_SQL)),
    Entry("a24_kpi_table_live", lambda s, d: r(metrics.kpi_table(
              v.metric_log(s, d), KPI_TARGETS, "live", error_marker="-H", error_target=90000.0,
              rising=["5-LOW"]), 6, "distance_pct"),
          oracle("""SELECT tag, initial, current, target,
                      CASE WHEN current > lim THEN round((current - lim) / lim * 100, 6) END AS distance_pct,
                      CASE WHEN current > lim THEN printf('%+.1f%%', (current - lim) / lim * 100) || ' to target'
                           WHEN current <= lim THEN 'REACHED' ELSE '' END AS distance,
                      CASE WHEN current < initial OR (tag = '5-LOW' AND current > initial)
                           THEN 'IMPROVING' ELSE 'STABLE' END AS trend
                    FROM (SELECT *, CASE tag WHEN '1-URGENT' THEN 80000.0::double WHEN '2-HIGH' THEN 250000.0::double
                                             WHEN '3-MEDIUM' THEN 120000.0::double END AS target,
                                 CASE WHEN contains(tag, '-H') THEN 90000.0::double END AS lim FROM ends)""",
                 v.METRIC_LOG, KPI_SQL)),
    Entry("a25_generalization", lambda s, d: r(metrics.generalization(
              v.metric_log(s, d), "1-URGENT", "2-HIGH"), 6, "train_rmse", "val_rmse", "gap_pct"),
          oracle("""SELECT t AS train_mse, u AS val_mse, round(sqrt(t), 6) AS train_rmse, round(sqrt(u), 6) AS val_rmse,
                      round((u - t) / t * 100, 6) AS gap_pct, printf('%+.2f%%', (u - t) / t * 100) AS gap
                    FROM (SELECT max(current) FILTER (WHERE tag = '1-URGENT') AS t,
                                 max(current) FILTER (WHERE tag = '2-HIGH') AS u FROM ends)""",
                 v.METRIC_LOG, KPI_SQL)),
    Entry("a26_eta", lambda s, d: r(metrics.eta(v.metric_log(s, d), "5-LOW", 100, 2_000, 10), 6,
                                    "steps_per_sec", "eta_seconds"),
          oracle("""SELECT s1 AS last_step, s1 // 100 AS epoch, s1 // 100 + 10 AS total_epoch,
                      round(CASE WHEN el > 0 THEN (s1 - s0) / el ELSE 0 END, 6) AS steps_per_sec,
                      CASE WHEN el > 0 THEN (2000 - 10) * 100 - s1 ELSE 0 END AS steps_remaining,
                      round(CASE WHEN el > 0 THEN ((2000 - 10) * 100 - s1) / ((s1 - s0) / el) ELSE 0 END, 6)
                        AS eta_seconds
                    FROM (SELECT min(step) AS s0, max(step) AS s1,
                                 arg_max(wall_time, step) - arg_min(wall_time, step) AS el
                          FROM metric_log WHERE tag = '5-LOW')""", v.METRIC_LOG)),
    Entry("a27_recent_slope", lambda s, d: r(metrics.recent_slope(v.metric_log(s, d)), 4, "slope"),
          oracle("""SELECT tag, round(regr_slope(value, 50 - back), 4) AS slope
                    FROM (SELECT tag, value, row_number() OVER (PARTITION BY tag ORDER BY step DESC) AS back,
                                 count(*) OVER (PARTITION BY tag) AS n FROM metric_log)
                    WHERE back <= 50 AND n > 50 GROUP BY tag""", v.METRIC_LOG)),
    Entry("a28_rul_metrics", lambda s, d: r(metrics.rul_metrics(v.predictions(s, d), ["split"]), 6,
                                            "mse", "rmse", "rmsce", "sharpness"),
          oracle(f"""SELECT a.split, mse, rmse, rmsce, sharpness FROM
                      (SELECT split, round(avg(pow(y_pred - y_true, 2)), 6) AS mse,
                              round(sqrt(avg(pow(y_pred - y_true, 2))), 6) AS rmse,
                              round(sqrt(avg(y_std * y_std)), 6) AS sharpness FROM predictions GROUP BY split) a
                    JOIN (SELECT split, round(sqrt(avg(pow(obs - expected, 2))), 6) AS rmsce FROM
                      (SELECT split, bin, expected, avg(CASE WHEN abs((y_pred - y_true) / y_std) <= z
                                                             THEN 1.0 ELSE 0.0 END) AS obs
                       FROM predictions, (SELECT * FROM (VALUES {_grid('interval')}) t(bin, expected, z))
                       GROUP BY split, bin, expected) GROUP BY split) b ON a.split = b.split""", v.PREDICTIONS)),
    Entry("a29_asymmetric_score", lambda s, d: r(metrics.asymmetric_score(
              v.predictions(s, d), 1 / 13, 1 / 10, ["split"]), 4, "score"),
          oracle("""SELECT split, round(sum(exp(CASE WHEN y_pred < y_true THEN (y_true - y_pred) / 13.0
                                                     ELSE (y_pred - y_true) / 10.0 END) - 1), 4) AS score
                    FROM predictions GROUP BY split""", v.PREDICTIONS)),
    Entry("a30_distinct_rows", lambda s, d: profile.distinct_rows(v.telemetry_rul(s, d), ["unit", "cycle", "rul"]),
          oracle("SELECT DISTINCT unit, cycle, rul FROM telemetry", v.TELEMETRY)),
    Entry("a31_intensity_ratio", lambda s, d: r(profile.intensity_ratio(v.telemetry(s, d), 7, 9), 6,
                                                "rows_per_cycle_a", "rows_per_cycle_b", "ratio"),
          oracle("""SELECT round(a, 6) AS rows_per_cycle_a, round(b, 6) AS rows_per_cycle_b, round(a / b, 6) AS ratio
                    FROM (SELECT count(*) FILTER (WHERE unit = 7) /
                                 count(DISTINCT cycle) FILTER (WHERE unit = 7) AS a,
                                 count(*) FILTER (WHERE unit = 9) /
                                 count(DISTINCT cycle) FILTER (WHERE unit = 9) AS b FROM telemetry)""",
                 v.TELEMETRY)),
    Entry("a32_manifest_counts", lambda s, d: manifest_counts(v.artifacts(s, d)),
          oracle("""SELECT CASE WHEN path LIKE '%.safetensors' OR path LIKE '%.pt' THEN 'model'
                                WHEN path LIKE '%.parquet' THEN 'data' WHEN path LIKE '%.log' THEN 'logs'
                                WHEN path LIKE '%.sig' OR path LIKE '%.cert' THEN 'security'
                                ELSE 'unclassified' END AS department, count(*) AS files
                    FROM artifacts GROUP BY 1""", v.ARTIFACTS)),
    Entry("a33_domain_shift", lambda s, d: profile.domain_shift(
              v.telemetry(s, d).withColumn("code", F.col("unit") % 10 + F.col("fc") * 10), "code"),
          oracle("""SELECT DISTINCT unit % 10 + fc * 10 AS code FROM telemetry WHERE split = 'test' AND
                    unit % 10 + fc * 10 NOT IN (SELECT unit % 10 + fc * 10 FROM telemetry WHERE split = 'dev')""",
                 v.TELEMETRY)),
    Entry("a34_lifecycle_document", lambda s, d: profile.lifecycle_document(v.packets(s, d))
          .select(F.to_json("total_cycles").alias("total_cycles")),
          oracle("""SELECT concat('{', string_agg(concat('"', unit, '":', n), ',' ORDER BY cast(unit AS varchar)), '}') AS total_cycles
                    FROM (SELECT unit, count(DISTINCT cycle) AS n FROM packets GROUP BY unit)""", v.PACKETS)),
    Entry("a34_lifecycle_totals", lambda s, d: profile.lifecycle_totals(v.packets(s, d)),
          oracle("SELECT unit, count(DISTINCT cycle) AS total_cycles FROM packets GROUP BY unit", v.PACKETS)),
]
