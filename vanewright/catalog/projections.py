"""Scan, projection, join, set and scalar entries (S, P, J, U, F, O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanewright.catalog import views as v
from vanewright.catalog.profiles import KPI_SQL, SCALER_SQL, _pairs, _parts, describe, r
from vanewright.catalog.views import Entry, oracle
from vanewright.functions import scalars
from vanewright.operators import joins, profile, project, text
from vanewright.plans import prep
from vanewright.plans.ordered import take_per_group
from vanewright.sources import packets as bus
from vanewright.sources import scans

S, STATS = v.SENSORS, v.STATS
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "unit", "cycle"]
KEY_SQL = ", ".join(KEYS)


def z_sql(f: str) -> str:
    return f"({f} - {STATS[f][0]}) / {STATS[f][1]}"


def inv_sql(f: str) -> str:
    return f"{f} * {STATS[f][1]} + {STATS[f][0]}"


ZSCORE_SQL = oracle(f"SELECT {KEY_SQL}, " + ", ".join(
    f"round({z_sql(f)}, 6) AS {f}" for f in S) + " FROM telemetry", v.TELEMETRY)
UNZSCORE_SQL = oracle(f"SELECT {KEY_SQL}, " + ", ".join(
    f"round({inv_sql(f)}, 4) AS {f}" for f in S) + " FROM telemetry", v.TELEMETRY)


def dual_sql(test: str) -> str:
    cols = []
    for f in S:
        cond = test.format(f=f)
        cols.append(f"round(CASE WHEN {cond} THEN {f} ELSE {inv_sql(f)} END, 4) AS {f}")
        cols.append(f"round(CASE WHEN {cond} THEN {z_sql(f)} ELSE {f} END, 6) AS {f}_z")
    return oracle(f"SELECT {KEY_SQL}, " + ", ".join(cols) + " FROM telemetry", v.TELEMETRY)


def _dual(mode):
    def run(s, d):
        out = project.dual_domain(v.telemetry(s, d), STATS, S, mode=mode)
        out = r(r(out, 4, *S), 6, *[f"{f}_z" for f in S])
        return out.select(*KEYS, *S, *[f"{f}_z" for f in S])
    return run


def _json_packets(s, d):
    """Packets as JSON; every 97th broken, every 11th without s2."""
    p = v.packets(s, d)
    body = F.when(F.col("event_id") % 11 == 0,
                  F.to_json(F.struct("unit", "cycle", "s1", F.col("cycle").alias("RUL"), "timestamp_ms"))) \
            .otherwise(F.to_json(F.struct("unit", "cycle", "s1", "s2", "timestamp_ms")))
    return p.select(F.col("unit").cast("string").alias("key"),
                    F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(body).alias("value"))


def _registry(s, d):
    n = v.table(s, d, "nation")
    return n.select(F.col("n_name").alias("slug"), F.col("n_nationkey").alias("entry_id"),
                    F.concat(F.lit("https://registry/"), F.lower("n_name")).alias("url"))


def _signed_listing(s, d):
    a = v.artifacts(s, d).where(~F.col("path").endswith(".sig"))
    sig = a.where(F.col("mtime_s") % 2 == 0).select(
        F.concat("path", F.lit(".sig")).alias("path"), "mtime_s", "length")
    return a.unionByName(sig)


def _verdicts(s, d):
    from vanewright.operators.metrics import rul_metrics
    m = rul_metrics(v.predictions(s, d), ["unit"]).select("unit", F.round("rmse", 6).alias("rmse"))
    return project.verdict(m, "rmse", 3.2)


RUN_TEXT = """'model_name: net-' || cast(c_custkey AS varchar) || chr(10) || 'dataset_size: ' ||
 cast(c_nationkey AS varchar) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE chr(10) || 'q_scale: 0.5' END"""


def _runs(s, d):
    c = v.table(s, d, "customer")
    body = F.concat(F.lit("model_name: net-"), F.col("c_custkey").cast("string"),
                    F.lit("\ndataset_size: "), F.col("c_nationkey").cast("string"),
                    F.when(F.col("c_custkey") % 3 == 0, "").otherwise("\nq_scale: 0.5"))
    return c.select(F.col("c_custkey").alias("run"), body.alias("text"))


PATTERNS = {k: prep.RUN_PATTERNS[k] for k in ("model_name", "dataset_size", "q_scale")}

LONG_BOTH = """
sides AS (
  SELECT feature, avg(v) FILTER (WHERE split = 'dev') AS rm, stddev_samp(v) FILTER (WHERE split = 'dev') AS rs,
         avg(v) FILTER (WHERE split = 'test') AS lm, stddev_samp(v) FILTER (WHERE split = 'test') AS ls
  FROM long_telemetry GROUP BY feature)"""


def _compare(s, d):
    t = v.telemetry(s, d)
    out = joins.compare_domains(t.where("split = 'dev'"), t.where("split = 'test'"), S)
    return r(out, 6, "ref_mean", "ref_std", "live_mean", "live_std")


def _envelope(s, d):
    t = v.telemetry(s, d).withColumns({"mach": F.col("s3") * 9, "alt": F.col("s2") * 0.45})
    out = project.in_envelope(t, "mach", "alt")
    return out.groupBy("unit", "in_envelope").agg(F.count(F.lit(1)).alias("rows"))


ENVELOPE_SQL = """
env AS (SELECT unit, s3 * 9 AS m, s2 * 0.45 AS a FROM telemetry),
bounds AS (
  SELECT unit, a, m,
    CASE WHEN m < 0 OR m > 0.8 THEN NULL WHEN m < 0.2 THEN 17000.0
         WHEN m < 0.4 THEN 17000.0 + (m - 0.2) * ((40000.0 - 17000.0) / (0.4 - 0.2)) ELSE 40000.0 END AS hi,
    CASE WHEN m < 0 OR m > 0.8 THEN NULL WHEN m < 0.6 THEN 0.0
         WHEN m < 0.8 THEN (m - 0.6) * (10000.0 / (0.8 - 0.6)) ELSE 10000.0 END AS lo
  FROM env)"""


def value_counts(df, columns):
    """Non-null values per column, from the whole table."""
    return profile.per_feature(df, columns, {"values": F.count})


def _found_columns(s, d):
    li = v.table(s, d, "lineitem")
    return project.find_columns(value_counts(li, li.columns), ["KEY", "date"], "feature")


def _scan_written(s, d):
    """The telemetry written with the schema of the scan, and read back with it."""
    path, t = v.scratch(s, "telemetry"), v.telemetry(s, d).select(*KEYS, "s1")
    t.write.parquet(path)
    return scans.read_telemetry(s, path, t.schema)


def _order_files(s, d, name, frame):
    """A folder of files per priority."""
    root = v.scratch(s, name)
    frame.write.partitionBy("folder").parquet(root)
    kinds = [r["folder"] for r in frame.select("folder").distinct().collect()]
    return [f"{root}/folder={k}" for k in sorted(kinds)]


def _read_many(s, d):
    """Orders in one folder of files per priority, in one scan that names each row's file."""
    o = v.table(s, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("part"),
                                       F.substring("o_orderpriority", 1, 1).alias("folder"))
    out = scans.read_many(s, _order_files(s, d, "orders", o))
    return out.select("part", "o_orderkey", "o_totalprice", F.col("src_file").endswith(".parquet").alias("named"))


def _metric_files(s, d):
    """Logs in several files, read and merged."""
    log = v.metric_log(s, d).withColumn("folder", F.substring("tag", 1, 1))
    return scans.read_metric_logs(s, _order_files(s, d, "logs", log))


def _customer_files(s, d):
    """A text file of all customers of each nation; those of every fifth nation lack the format's mark."""
    root = v.scratch(s, "files")
    c = v.table(s, d, "customer")
    line = F.concat_ws("|", "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\n")
    mark = F.when(F.col("c_nationkey") % 5 == 0, "<html>\n").otherwise("CUST0001\n")
    c.groupBy("c_nationkey").agg(body.alias("value")).select("c_nationkey", F.concat(mark, "value").alias("value")) \
     .write.partitionBy("c_nationkey").text(root)
    return root


NATION_OF = r"c_nationkey=(\d+)"


def _binary(s, d):
    files = scans.scan_files(s, _customer_files(s, d), "*.txt", chunk_bytes=1000)
    return files.select(F.regexp_extract("path", NATION_OF, 1).cast("long").alias("nation"), "length", "sha256")


def _quarantine(s, d):
    ok, bad = scans.split_valid_files(scans.file_heads(s, _customer_files(s, d), "*.txt"), b"CUST0001")
    nation = F.regexp_extract("path", NATION_OF, 1).cast("long").alias("nation")
    return ok.select(nation, F.lit("valid").alias("state"), "length").unionByName(bad.select(nation, F.lit("corrupt").alias("state"), "length"))


CUSTOMER_FILES = """files AS (SELECT cast(c_nationkey AS bigint) AS nation, CASE WHEN c_nationkey % 5 = 0 THEN '<html>' ELSE 'CUST0001' END || chr(10)
    || string_agg(c_custkey || '|' || c_name || '|' || cast(cast(c_acctbal AS decimal(12,2)) AS varchar), chr(10) ORDER BY c_custkey) || chr(10) AS body
    FROM customer GROUP BY c_nationkey)"""


def _catalog(s, d):
    """Catalogue columns of a registered view with their filled values."""
    t = v.telemetry(s, d)
    t.createOrReplaceTempView("fleet_telemetry_view")
    filled = value_counts(t, t.columns).withColumnRenamed("feature", "column_name")
    return (scans.catalog_report(s, "fleet_telemetry_view").drop("data_type")
            .join(filled, "column_name"))


def _dual_check(s, d):
    """Completeness over the columns that hold values."""
    dual = project.dual_domain(v.telemetry(s, d), STATS, S)
    names = [c for c in dual.columns if c in S or c.endswith("_z")]
    filled = value_counts(dual, names).where("values > 0")
    return joins.check_dual_schema(filled, len(S), "feature")


def _stats_report(s, d):
    t = v.telemetry(s, d)
    return r(joins.synthesis([profile.flight_conditions(t, S, "dataset")]), 6, "mean")


def _prefix_keys(s, d):
    p = v.table(s, d, "part").select("p_partkey", F.concat(
        F.when(F.col("p_partkey") % 2 == 0, "net.").otherwise("model.net."), "p_type",
        F.when(F.col("p_partkey") % 5 == 0, "_aux").otherwise("")).alias("key"))
    return project.normalize_keys(p, "key", ["net.", "model.net."], ["_aux"])


def _scalar_mix(s, d):
    t = v.telemetry(s, d)
    return t.select(*KEYS, F.abs(F.col("s1") - 25).alias("a"), F.greatest(F.lit(0.0), F.col("s1") - 25).alias("b"),
                    F.floor(F.col("s2") / 1000).alias("c"), F.round(F.sqrt("s2"), 6).alias("e"),
                    F.round(F.exp(-F.col("s3")), 6).alias("g"),
                    F.round(scalars.softplus(F.col("s1") - 25), 6).alias("h"),
                    F.round(F.col("s3") * 7, 2).alias("i"), F.round(F.col("s4") * 7, 3).alias("j"))


UUID = "'1d2e3f4a-0b1c-2d3e-4f5a-' || lpad(cast(page_id AS varchar), 12, '0')"


def _uuids(s, d):
    u = F.concat(F.lit("https://host/"), F.when(F.col("page_id") % 4 == 0, "other/").otherwise("cellar/"),
                 F.lit("1d2e3f4a-0b1c-2d3e-4f5a-"), F.lpad(F.col("page_id").cast("string"), 12, "0"),
                 F.lit(".0006.03/DOC_1"))
    p = v.table(s, d, "pages").select("page_id", u.alias("u"))
    return p.select("page_id", scalars.extract_uuid("u").alias("uuid"))


def _paths(s, d):
    a = v.artifacts(s, d)
    return a.select("path", scalars.path_name("path").alias("name"), scalars.path_stem("path").alias("stem"),
                    scalars.path_suffix("path").alias("suffix"))


def _json_fields(s, d):
    e = v.table(s, d, "events")
    return e.select("event_id", scalars.json_get("props", ["$.missing", "$.k"], "0").alias("k"),
                    scalars.json_get("props", ["$.missing"], "none").alias("fallback"),
                    scalars.json_key_count("props").alias("keys"))


def _times(s, d):
    p = v.packets(s, d)
    return p.select("event_id", "timestamp_ms",
                    scalars.age_seconds(F.lit(1_706_745_600_000), "timestamp_ms").alias("age"),
                    scalars.duration_text((F.lit(1_706_745_600_000) - F.col("timestamp_ms")) / 1000)
                    .alias("duration"))


def _quantile_grid(s, d):
    """Share of standardised residuals at or below each normal quantile."""
    grid = s.createDataFrame([(i, p, z) for i, (p, z) in enumerate(scalars.normal_quantiles(11))],
                             "i int, p double, z double")
    bound = F.array(*[F.lit(z) for _, z in scalars.normal_quantiles(11)])
    slot = F.size(F.filter(bound, lambda z: z < (F.col("y_pred") - F.col("y_true")) / F.col("y_std")))
    counts = v.predictions(s, d).groupBy(slot.alias("i")).agg(F.count(F.lit(1)).alias("rows"))
    return grid.join(counts, "i").select("i", "p", F.round("z", 6).alias("z"), "rows")


def _grid_sql():
    from statistics import NormalDist
    rows = ", ".join(f"({i}, {i / 10}::double, {NormalDist().inv_cdf(i / 10) if 0 < i < 10 else (9e99 if i else -9e99)!r}::double)"
                     for i in range(11))
    return oracle(f"""SELECT g.i, g.p, CASE WHEN g.z > 9e98 THEN 'inf'::double WHEN g.z < -9e98 THEN '-inf'::double
                        ELSE round(g.z, 6) END AS z, n.rows
                      FROM (VALUES {rows}) g(i, p, z) JOIN
                        (SELECT i, count(*) AS rows FROM
                           (SELECT (SELECT count(*) FROM (VALUES {rows}) b(i, p, z) WHERE b.z < x.res) AS i
                            FROM (SELECT (y_pred - y_true) / y_std AS res FROM predictions) x) GROUP BY i) n
                      ON g.i = n.i""", v.PREDICTIONS)


DECODED = v.PACKETS + """,
decoded AS (
  SELECT unit, cycle, timestamp_ms, CASE WHEN event_id % 11 = 0 THEN cast(cycle AS double) ELSE 0.0 END AS true_rul,
         s1, CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE s2 END AS s2
  FROM packets WHERE event_id % 97 <> 0)"""


def _first_rows(s, d):
    """The first row of every unit as a record."""
    first = take_per_group(v.telemetry(s, d), ["unit"], v.ORDER, 1)
    return first.select(F.to_json(F.struct("unit", "cycle", "fc")).alias("record"))


ENTRIES = [
    # --- scans
    Entry("s1_parquet_scan", _scan_written,
          oracle(f"SELECT {KEY_SQL}, s1 FROM telemetry", v.TELEMETRY)),
    Entry("s2_multi_file_scan", _read_many,
          "SELECT o_orderpriority AS part, o_orderkey, o_totalprice, true AS named FROM orders"),
    Entry("s3_zip_row_aligned", lambda s, d: scans.zip_row_aligned(_parts(s, d), "event_id"),
          oracle("SELECT event_id, s1, s2, unit, cycle, 30 - cycle AS rul FROM packets", v.PACKETS)),
    Entry("s5_decode_packets", lambda s, d: bus.decode_packets(_json_packets(s, d), ["s1", "s2"])
          .withColumn("unit", F.col("unit").cast("long")),
          oracle("SELECT * FROM decoded", DECODED)),
    Entry("s6_file_digests", _binary, oracle("SELECT nation, strlen(body) AS length, sha256(body) AS sha256 FROM files", CUSTOMER_FILES)),
    Entry("s7_split_valid_files", _quarantine,
          oracle("""SELECT nation, CASE WHEN nation % 5 = 0 THEN 'corrupt' ELSE 'valid' END AS state, strlen(body) AS length FROM files""",
                 CUSTOMER_FILES)),
    Entry("s8_discover_datasets", lambda s, d: scans.discover_datasets(v.artifacts(s, d), suffix=".parquet"),
          oracle("""SELECT DISTINCT regexp_extract(path, '([^/]+)\\.parquet$', 1) AS dataset FROM artifacts
                    WHERE path LIKE '%.parquet'""", v.ARTIFACTS)),
    Entry("s9_metric_log_scan", _metric_files,
          oracle("SELECT * FROM metric_log", v.METRIC_LOG)),
    Entry("s10_catalog_report", _catalog,
          oracle("""SELECT column_name, 'fleet_telemetry_view' AS table_name, true AS "exists", cast(p AS integer) AS position, n AS values
                    FROM (SELECT count(*) AS n FROM telemetry),
                      (SELECT unnest(['dataset', 'split', 'unit', 'cycle', 'l_shipdate', 'l_orderkey', 'l_linenumber',
                                      'l_partkey', 's1', 's2', 's3', 's4', 'fc', 'hs']) AS column_name,
                              unnest(range(14)) AS p)""", v.TELEMETRY)),
    Entry("s11_lookup_registry", lambda s, d: scans.lookup_registry(
              v.table(s, d, "customer").select("c_custkey", F.concat(F.lit("nation_"), (F.col("c_nationkey") + 3)
                                               .cast("string")).alias("slug")), _registry(s, d)),
          """SELECT c_custkey, 'nation_' || cast(c_nationkey + 3 AS varchar) AS slug, n_nationkey AS entry_id,
               'https://registry/' || lower(n_name) AS url
             FROM customer LEFT JOIN nation ON upper(n_name) = 'NATION_' || cast(c_nationkey + 3 AS varchar)"""),
    # --- projections
    Entry("p1_filter_unit", lambda s, d: project.filter_unit(v.telemetry(s, d), 42, 3, 2).select(*KEYS, "s1", "s2"),
          oracle(f"SELECT {KEY_SQL}, s1, s2 FROM telemetry WHERE unit = 42 AND cycle = 3 AND fc = 2", v.TELEMETRY)),
    Entry("p2_feature_columns", lambda s, d: (lambda t: t.select(*project.feature_columns(
              t, "unit|cycle|fc|hs|rul|l_", ["dataset", "split"])))(v.telemetry(s, d)),
          oracle("SELECT s1, s2, s3, s4 FROM telemetry", v.TELEMETRY)),
    Entry("p3_zscore", lambda s, d: r(project.zscore(v.telemetry(s, d), STATS, S), 6, *S).select(*KEYS, *S),
          ZSCORE_SQL),
    Entry("p4_inverse_zscore", lambda s, d: r(project.unzscore(v.telemetry(s, d), STATS, S), 4, *S).select(*KEYS, *S),
          UNZSCORE_SQL),
    Entry("p5_dual_domain_per_value", _dual("per_value"), dual_sql("abs({f}) > 15")),
    Entry("p5_dual_domain_per_row", _dual("per_row"),
          dual_sql("greatest(abs(s1), abs(s2), abs(s3), abs(s4)) > 15")),
    Entry("p6_confidence_band", lambda s, d: r(project.confidence_band(v.scores(s, d)), 6, "ci_lower", "ci_upper")
          .select("event_id", "ci_lower", "ci_upper"),
          oracle("""SELECT event_id, round(greatest(0.0, predicted_rul - 1.96 * predicted_std), 6) AS ci_lower,
                    round(predicted_rul + 1.96 * predicted_std, 6) AS ci_upper FROM scores""", v.SCORES)),
    Entry("p7_positive_head", lambda s, d: v.packets(s, d).select(
              "event_id", F.round(scalars.positive_head(F.col("s1") - 50), 9).alias("y")),
          oracle("""SELECT event_id, round(CASE WHEN sp > 1e-9 THEN sp ELSE 1e-9 END, 9) AS y FROM
                    (SELECT event_id, greatest(s1 - 50, 0.0) + ln(1 + exp(-abs(s1 - 50))) AS sp FROM packets)""",
                 v.PACKETS)),
    Entry("p8_flag_threshold", lambda s, d: project.flag_threshold(v.telemetry(s, d), "s2", 100000, "high", ["unit", "cycle"]),
          oracle("SELECT unit, cycle, max(s2) > 100000 AS high FROM telemetry GROUP BY unit, cycle", v.TELEMETRY)),
    Entry("p9_in_envelope", _envelope,
          oracle("""SELECT unit, coalesce(a BETWEEN lo AND hi, false) AS in_envelope, count(*) AS rows
                    FROM bounds GROUP BY 1, 2""", v.TELEMETRY, ENVELOPE_SQL)),
    Entry("p10_range_violations", lambda s, d: project.range_violations(
              v.telemetry(s, d), {"overflow": "s2 > 1e6", "high_load": "s1 > 49", "negative": "s3 < 0"}),
          oracle("""SELECT u.rule, u.n AS violations, u.n > 0 AS violated FROM (
                      SELECT 'overflow' AS rule, count(*) FILTER (WHERE s2 > 1e6) AS n FROM telemetry UNION ALL
                      SELECT 'high_load', count(*) FILTER (WHERE s1 > 49) FROM telemetry UNION ALL
                      SELECT 'negative', count(*) FILTER (WHERE s3 < 0) FROM telemetry) u""", v.TELEMETRY)),
    Entry("p11_normalization_audit", lambda s, d: r(project.normalization_audit(
              v.telemetry(s, d), "s1", 50, "dataset"), 6, "avg_value"),
          oracle("""SELECT dataset, round(avg(s1), 6) AS avg_value, max(s1) AS max_value, max(s1) < 50 AS looks_normalized
                    FROM telemetry GROUP BY dataset""", v.TELEMETRY)),
    Entry("p12_find_columns", _found_columns,
          """SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_shipdate']) AS feature,
               unnest([count(l_orderkey), count(l_partkey), count(l_suppkey), count(l_shipdate)]) AS values
             FROM lineitem"""),
    Entry("p13_safe_casts", lambda s, d: v.table(s, d, "part").select(
              "p_partkey", scalars.safe_int(F.when(F.col("p_size") % 3 == 0, F.lit("n/a")).otherwise(
                  F.concat(F.col("p_size").cast("string"), F.lit(".7")))).alias("as_int")),
          """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS as_int FROM part"""),
    Entry("p14_normalize_keys", _prefix_keys,
          "SELECT p_partkey, p_type AS key FROM part WHERE p_partkey % 5 <> 0"),
    Entry("p15_verdict", _verdicts,
          oracle("""SELECT unit, rmse, CASE WHEN rmse < 3.2 THEN 'READY' ELSE 'NOT_READY' END AS verdict FROM
                    (SELECT unit, round(sqrt(avg(pow(y_pred - y_true, 2))), 6) AS rmse FROM predictions GROUP BY unit)""",
                 v.PREDICTIONS)),
    # --- joins
    Entry("j2_pair_by_row", lambda s, d: _pairs(s, d).select(
              "unit", F.col("row_no").cast("long").alias("row_no"), F.col("raw.event_id").alias("event_id"),
              F.col("raw.s1").alias("raw_s1"), F.round("norm.s1", 6).alias("norm_s1")),
          oracle("""SELECT unit, row_number() OVER (PARTITION BY unit ORDER BY timestamp_ms, event_id) AS row_no,
                    event_id, s1 AS raw_s1, round((s1 - 50.0) / 47.5, 6) AS norm_s1 FROM packets""", v.PACKETS)),
    Entry("j3_compare_domains", _compare,
          oracle("""SELECT feature, round(rm, 6) AS ref_mean, round(rs, 6) AS ref_std, round(lm, 6) AS live_mean,
                    round(ls, 6) AS live_std FROM sides""", v.LONG_TELEMETRY, LONG_BOTH)),
    Entry("j4_join_constants", lambda s, d: joins.join_constants(
              v.telemetry(s, d), v.table(s, d, "supplier").select(F.col("s_suppkey").alias("unit"),
                                                                  F.col("s_acctbal").alias("offset")), ["unit"])
          .select(*KEYS, F.round(F.col("s1") - F.col("offset"), 4).alias("shifted")),
          oracle(f"""SELECT {KEY_SQL}, round(s1 - s_acctbal, 4) AS shifted FROM telemetry
                    LEFT JOIN supplier ON s_suppkey = unit""", v.TELEMETRY)),
    Entry("j5_unsigned_artifacts", lambda s, d: joins.unsigned_artifacts(_signed_listing(s, d)).select("path"),
          oracle("SELECT path FROM artifacts WHERE path NOT LIKE '%.sig' AND mtime_s % 2 = 1", v.ARTIFACTS)),
    Entry("j5_signed_artifacts", lambda s, d: joins.signed_artifacts(_signed_listing(s, d)).select("path"),
          oracle("SELECT path FROM artifacts WHERE path NOT LIKE '%.sig' AND mtime_s % 2 = 0", v.ARTIFACTS)),
    Entry("j6_reconcile", lambda s, d: joins.reconcile(
              v.artifacts(s, d).where("mtime_s % 5 <> 0"), v.artifacts(s, d).where("mtime_s % 7 <> 0"), "path"),
          oracle("""SELECT expected, recovered, missing, extra, recovered >= expected AS passes,
                           missing = 0 AS complete FROM (SELECT
                    count(*) FILTER (WHERE mtime_s % 5 <> 0) AS expected,
                    count(*) FILTER (WHERE mtime_s % 7 <> 0) AS recovered,
                    count(*) FILTER (WHERE mtime_s % 5 <> 0 AND mtime_s % 7 = 0) AS missing,
                    count(*) FILTER (WHERE mtime_s % 5 = 0 AND mtime_s % 7 <> 0) AS extra FROM artifacts)""",
                 v.ARTIFACTS)),
    Entry("j6_missing_keys", lambda s, d: joins.missing_keys(
              v.artifacts(s, d).where("mtime_s % 5 <> 0"), v.artifacts(s, d).where("mtime_s % 7 <> 0"), "path"),
          oracle("SELECT path FROM artifacts WHERE mtime_s % 5 <> 0 AND mtime_s % 7 = 0", v.ARTIFACTS)),
    Entry("j7_split_by_units", lambda s, d: joins.split_by_units(
              v.telemetry(s, d), v.table(s, d, "supplier").where("s_acctbal < 1000")
              .select(F.col("s_suppkey").alias("unit")))[1].groupBy("unit").agg(F.count(F.lit(1)).alias("rows")),
          oracle("""SELECT unit, count(*) AS rows FROM telemetry WHERE unit IN
                    (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000) GROUP BY unit""", v.TELEMETRY)),
    Entry("j9_mission_progress", lambda s, d: r(joins.mission_progress(
              v.packets(s, d).where("s1 < 15"), profile.lifecycle_totals(v.packets(s, d))), 6, "progress"),
          oracle("""SELECT a.unit, current_cycle, total_cycles,
                      greatest(0.0, (total_cycles - current_cycle) * 5.5)::double AS remaining_sec,
                      round(least(1.0, current_cycle / total_cycles), 6) AS progress
                    FROM (SELECT unit, max(cycle) AS current_cycle FROM packets WHERE s1 < 15 GROUP BY unit) a
                    JOIN (SELECT unit, count(DISTINCT cycle) AS total_cycles FROM packets
                          GROUP BY unit) b ON a.unit = b.unit""", v.PACKETS)),
    Entry("j10_latest_fresh", lambda s, d: joins.latest_fresh(
              v.artifacts(s, d).withColumn("run", F.substring("path", 6, 2)), 2100, 105, by=["run"]),
          oracle("""SELECT substr(path, 6, 2) AS run, max(mtime_s) AS mtime_s, arg_max(path, mtime_s) AS path,
                    max(mtime_s) > 2100 - 105 AS fresh FROM artifacts GROUP BY 1""", v.ARTIFACTS)),
    # --- sets
    Entry("u1_union_splits", lambda s, d: (lambda t: joins.union_splits(
              t.where("split = 'dev'").drop("split"), t.where("split = 'test'").drop("split")))(v.telemetry(s, d))
          .select(*KEYS, "split"),
          oracle(f"SELECT {KEY_SQL}, split FROM telemetry", v.TELEMETRY)),
    Entry("u2_synthesis", _stats_report,
          oracle("""SELECT dataset, feature, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean
                    FROM long_telemetry GROUP BY dataset, feature""", v.LONG_TELEMETRY)),
    Entry("u3_dropped_inputs", lambda s, d: joins.dropped_inputs(
              v.table(s, d, "documents"), v.table(s, d, "labels"), "doc_id"),
          "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    Entry("u5_check_dual_schema", _dual_check,
          oracle("""SELECT 4::bigint AS z_columns, true AS complete FROM (SELECT count(s1 + s2 + s3 + s4) AS n FROM telemetry)
                    WHERE n > 0""", v.TELEMETRY)),
    # --- scalars
    Entry("f1_scalar_functions", _scalar_mix,
          oracle(f"""SELECT {KEY_SQL}, abs(s1 - 25) AS a, greatest(0.0, s1 - 25) AS b, cast(floor(s2 / 1000) AS bigint) AS c,
                    round(sqrt(s2), 6) AS e, round(exp(-s3), 6) AS g,
                    round(greatest(s1 - 25, 0.0) + ln(1 + exp(-abs(s1 - 25))), 6) AS h,
                    round(s3 * 7, 2) AS i, round(s4 * 7, 3) AS j FROM telemetry""", v.TELEMETRY)),
    Entry("f3_times", _times,
          oracle("""SELECT event_id, timestamp_ms, (1706745600000 - timestamp_ms) / 1000 AS age,
                      CASE WHEN s >= 172800 THEN (s // 86400) || ' days, ' WHEN s >= 86400 THEN '1 day, ' ELSE '' END
                      || printf('%d:%02d:%02d', s % 86400 // 3600, s % 3600 // 60, s % 60) AS duration
                    FROM (SELECT *, (1706745600000 - timestamp_ms) // 1000 AS s FROM packets)""", v.PACKETS)),
    Entry("f4_extract_keys", lambda s, d: scalars.extract_keys(_runs(s, d), "text", PATTERNS).drop("text"),
          """SELECT c_custkey AS run, 'net-' || c_custkey AS model_name, cast(c_nationkey AS varchar) AS dataset_size,
             CASE WHEN c_custkey % 3 = 0 THEN 'N/A' ELSE '0.5' END AS q_scale FROM customer"""),
    Entry("f5_dataset_id", lambda s, d: v.table(s, d, "part").select("p_partkey", scalars.dataset_id(
              F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("sim_DS0"), (F.col("p_partkey") % 9).cast("string"),
                                                          F.lit("c-00.h5"))).otherwise(F.col("p_name"))).alias("dataset")),
          """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'DS0' || (p_partkey % 9) || 'c' ELSE p_name END
             AS dataset FROM part"""),
    Entry("f6_extract_uuid", _uuids,
          f"SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN {UUID} END AS uuid FROM pages"),
    Entry("f7_render_url", lambda s, d: v.table(s, d, "documents").select("doc_id", scalars.render_url(
              "https://host/{}/doc/{}.html", "lang", "doc_id").alias("url")),
          "SELECT doc_id, 'https://host/' || lang || '/doc/' || doc_id || '.html' AS url FROM documents"),
    Entry("f8_path_parts", _paths,
          oracle("""SELECT path, regexp_extract(path, '[^/]+$') AS name, regexp_extract(path, '([^/]+)\\.[^.]+$', 1) AS stem,
                    regexp_extract(path, '\\.[^.]+$') AS suffix FROM artifacts""", v.ARTIFACTS)),
    Entry("f9_json_get", _json_fields,
          """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '0') AS k, 'none' AS fallback,
             cast(len(json_keys(props)) AS integer) AS keys FROM events"""),
    Entry("f10_normal_quantiles", _quantile_grid, _grid_sql()),
    Entry("f11_content_hash", lambda s, d: v.table(s, d, "documents").select(
              "doc_id", scalars.sha256_text("text").alias("sha256")),
          "SELECT doc_id, sha256(text) AS sha256 FROM documents"),
    # --- order and limit
    Entry("o1_latest_rows", lambda s, d: profile.latest(v.packets(s, d), 5, [F.desc("timestamp_ms"), F.desc("event_id")]),
          oracle("SELECT * FROM packets ORDER BY timestamp_ms DESC, event_id DESC LIMIT 5", v.PACKETS)),
    Entry("o2_top_cycles", lambda s, d: profile.latest(v.packets(s, d), 5, [F.desc("cycle"), F.desc("event_id")]),
          oracle("SELECT * FROM packets ORDER BY cycle DESC, event_id DESC LIMIT 5", v.PACKETS)),
    Entry("o3_sample_rows", lambda s, d: profile.sample_rows(v.packets(s, d), 10, ["event_id"], F.col("unit") == 11),
          oracle("SELECT * FROM packets WHERE unit = 11 ORDER BY event_id LIMIT 10", v.PACKETS)),
    Entry("o3_first_row_as_record", _first_rows,
          oracle("""SELECT concat('{"unit":', unit, ',"cycle":', cycle, ',"fc":', fc, '}') AS record FROM
                    (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS n
                     FROM telemetry) WHERE n = 1""", v.TELEMETRY)),
    Entry("o4_trajectory", lambda s, d: profile.trajectory(v.scores(s, d), 11),
          oracle("SELECT * FROM scores WHERE unit = 11", v.SCORES)),
    Entry("o6_recent_describe", lambda s, d: describe(profile.recent_describe(
              v.packets(s, d), ["s1", "s2"], [F.desc("timestamp_ms"), F.desc("event_id")])),
          oracle("""SELECT feature, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
                      min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
                      round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max
                    FROM (SELECT unnest(['s1', 's2']) AS feature, unnest([s1, s2]) AS v FROM
                          (SELECT * FROM packets ORDER BY timestamp_ms DESC, event_id DESC LIMIT 100))
                    GROUP BY feature""", v.PACKETS)),
]
