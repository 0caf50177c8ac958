"""Value semantics: projections, scaling, metrics, quantiles, smoothing, scoring."""

import math

import numpy as np
import pandas as pd
import network
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vanewright.functions import scalars
from vanewright.operators import metrics, profile, project, quantiles, scaling, scoring, smoothing
from vanewright.schemas import FEATURES, calibration


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 700
    return pd.DataFrame({"unit": np.where(rng.random(n) < 0.4, 1, rng.integers(2, 9, n)),
                         "a": rng.normal(10, 30, n).round(2), "b": rng.exponential(5, n).round(1),
                         "flat": 4.0, "row_no": range(n)})


PROBS = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def test_quantiles_match_linear_interpolation(spark, rows):
    got = quantiles.exact_quantiles(spark.createDataFrame(rows), ["a", "b", "flat"], PROBS).toPandas()
    for f in ["a", "b", "flat"]:
        mine = got[got["feature"] == f].iloc[0]
        np.testing.assert_allclose([mine[q] for q in PROBS], np.quantile(rows[f], list(PROBS.values())))


@pytest.mark.parametrize("listed,bins", [(0, 7), (50, 4096), (10**9, 4096)])
def test_quantiles_of_a_large_table_use_histograms(spark, split_groups, monkeypatch, listed, bins):
    """Whatever the values are: ties, gaps over all of a double's range, infinities, the smallest numbers, none."""
    rng = np.random.default_rng(8)
    n = 20_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 9, n).astype(float), "wild": rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-300, 300, n),
                        "tiny": rng.integers(0, 3, n) * 5e-324, "ends": rng.choice([-np.inf, -1.7e308, 0.5, 1.7e308, np.inf], n), "none": np.nan})
    pdf.loc[::50, "b"] = np.nan
    pdf.loc[pdf.index % 3 == 0, "a"] = 0.25
    monkeypatch.setattr(quantiles, "LISTED", listed)
    monkeypatch.setattr(quantiles, "BINS", bins)
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf), list(pdf.columns), PROBS).toPandas().set_index("feature")
    for f in ["a", "b", "wild", "tiny"]:
        np.testing.assert_allclose([got.loc[f, q] for q in PROBS], np.quantile(pdf[f].dropna(), list(PROBS.values())), rtol=1e-12)
    order = np.sort(pdf["ends"])
    assert [got.loc["ends", q] for q in PROBS] == [order[int((n - 1) * p)] for p in PROBS.values()]
    assert got.loc["none"].isna().all()


def test_describe_equals_pandas(spark, rows):
    got = profile.describe_features(spark.createDataFrame(rows), ["a", "b"]).toPandas().set_index("feature")
    want = rows[["a", "b"]].describe().T
    np.testing.assert_allclose(got[["count", "mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float)
                               .loc[["a", "b"]], want.to_numpy(float))


def test_zscore_round_trip(spark, rows):
    stats = {"a": (3.0, 7.0), "b": (1.0, 0.5)}
    df = spark.createDataFrame(rows)
    back = project.unzscore(project.zscore(df, stats, ["a", "b"]), stats, ["a", "b"]).toPandas()
    np.testing.assert_allclose(back.sort_values("row_no")["a"], rows["a"], atol=1e-9)


def test_dual_domain_boundary(spark):
    df = spark.createDataFrame([(15.0, 1.0), (15.01, 1.0), (-16.0, 1.0), (0.0, 1.0)], "x double, y double")
    stats = {"x": (10.0, 2.0), "y": (0.0, 4.0)}
    one = project.dual_domain(df, stats, ["x", "y"]).toPandas()
    assert one["x"].tolist() == [40.0, 15.01, -16.0, 10.0]
    assert one["x_z"].round(3).tolist() == [15.0, 2.505, -13.0, 0.0]
    assert one["y"].tolist() == [4.0] * 4
    row = project.dual_domain(df, stats, ["x", "y"], mode="per_row").toPandas()
    assert row["y"].tolist() == [4.0, 1.0, 1.0, 4.0]
    assert row["y_z"].tolist() == [1.0, 0.25, 0.25, 1.0]


def test_scalers(spark, rows):
    df = spark.createDataFrame(rows).withColumn("dataset", F.col("unit"))
    got = {r["feature"]: r for r in scaling.compute_scalers(df, ["a", "flat"]).collect()}
    within = sum(g["a"].var(ddof=0) * len(g) for _, g in rows.groupby("unit")) / len(rows)
    assert got["a"]["std"] == pytest.approx(math.sqrt(within))
    assert got["a"]["mean"] == pytest.approx(rows["a"].mean())
    assert got["flat"]["std"] == pytest.approx(math.sqrt(1e-9))
    total = {r["feature"]: r for r in scaling.compute_scalers(df, ["a"], pooled="total").collect()}
    assert total["a"]["std"] == pytest.approx(rows["a"].std(ddof=0))


@pytest.mark.parametrize("pooled", ["within", "total"])
def test_scalers_from_moments(spark, rows, pooled):
    df = spark.createDataFrame(rows).withColumns({"dataset": F.col("unit") % 3, "unit": F.col("unit")})
    parts = scaling.moments(df, ["a", "b", "flat"], ["dataset", "unit"])
    pooled_rows = {r["feature"]: r for r in scaling.pool_moments(parts, pooled=pooled).collect()}
    for r in scaling.compute_scalers(df, ["a", "b", "flat"], pooled=pooled).collect():
        assert pooled_rows[r["feature"]]["mean"] == pytest.approx(r["mean"])
        assert pooled_rows[r["feature"]]["std"] == pytest.approx(r["std"])


def test_single_row_dataset_adds_nothing(spark):
    df = spark.createDataFrame([("x", 5.0), ("y", 1.0), ("y", 3.0)], "dataset string, a double")
    got = scaling.compute_scalers(df, ["a"]).first()
    assert got["mean"] == 3.0 and got["std"] == pytest.approx(math.sqrt(2 / 3))


def test_solve_affine_cases(spark):
    data = [(1, 0, 10.0, 1.0, 7.0), (1, 1, 10.0, 1.0, 7.0), (1, 2, 30.0, 5.0, 7.0), (1, 3, 10.0, 1.0, 7.0)]
    df = spark.createDataFrame(data, "unit int, row_no int, r double, n double, c double").select(
        "unit", "row_no", F.struct(F.col("r").alias("s"), F.col("c").alias("k")).alias("raw"),
        F.struct(F.col("n").alias("s"), F.lit(0.0).alias("k")).alias("norm"))
    got = {r["feature"]: (r["mean"], r["std"]) for r in scaling.solve_affine(df, ["s", "k"]).collect()}
    assert got["s"] == (5.0, 5.0)      # ends equal, so smallest and largest raw
    assert got["k"] == (7.0, 1.0)      # flat


def test_window_minmax_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "window array<struct<s: double>>")
    assert scaling.window_minmax(empty, ["s"]).first()[1:] == (0.0, 0.0)


def test_profile_without_health_flag(spark):
    df = spark.createDataFrame([(1, 1, 0, 3, 1), (1, 2, 0, 1, 2), (2, 9, 1, 2, 1), (2, 4, 1, 2, 2)],
                               "unit int, cycle int, hs int, fc int, seq int")
    got = {r["unit"]: r for r in profile.unit_profiles(df, ["seq"]).collect()}
    assert got[1]["hs_start_cycle"] == -1 and got[1]["classes"] == [1, 3]
    assert got[2]["hs_start_cycle"] == 9    # first in row order, not the smallest


def test_published_kpi_anchor(spark):
    log = spark.createDataFrame([("mse/train", 1, 0.0, 500.0), ("mse/train", 9, 8.0, 110.34),
                                 ("elbo/train", 1, 0.0, 1.0), ("elbo/train", 9, 8.0, 2.0)],
                                "tag string, step long, wall_time double, value double")
    got = {r["tag"]: r for r in metrics.kpi_table(log, {"mse/train": 80.0}, "live", error_target=80.0,
                                                  rising=["elbo/train"]).collect()}
    assert got["mse/train"]["distance"] == "+37.9% to target"
    assert got["mse/train"]["trend"] == "IMPROVING" and got["elbo/train"]["trend"] == "IMPROVING"


def test_published_generalization_anchor(spark):
    log = spark.createDataFrame([("mse/train", 3, 77.34), ("mse/val", 3, 89.71)],
                                "tag string, step long, value double")
    assert metrics.generalization(log).first()["gap"] == "+15.99%"


def test_published_intensity_anchor(spark):
    df = spark.createDataFrame([(11, c) for c in range(59) for _ in range(5)]
                               + [(14, c) for c in range(76)], "unit int, cycle int")
    assert profile.intensity_ratio(df, 11, 14).first()["ratio"] == 5.0
    assert round(11245.68 / 2062.87, 2) == 5.45


def test_eta_without_progress(spark):
    log = spark.createDataFrame([("t", 5, 1.0, 0.0)], "tag string, step long, wall_time double, value double")
    got = metrics.eta(log, "t", 10, 5).first()
    assert (got["steps_remaining"], got["eta_seconds"]) == (0, 0.0)


def test_slope_needs_more_than_n_points(spark):
    log = spark.createDataFrame([("short", i, float(i)) for i in range(50)]
                                + [("long", i, 2.0 * i) for i in range(51)], "tag string, step long, value double")
    assert [tuple(r) for r in metrics.recent_slope(log).collect()] == [("long", 2.0)]


def test_kde_close_to_exact_density(spark, rows):
    got = metrics.kde(spark.createDataFrame(rows), "a", ["unit"]).where("unit = 1").orderBy("grid_idx").toPandas()
    v = rows[rows["unit"] == 1]["a"].to_numpy()
    bw = v.std(ddof=1) * len(v) ** -0.2
    exact = [np.exp(-0.5 * ((x - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi)) for x in got["x"]]
    np.testing.assert_allclose(got["density"], exact, atol=2e-5)
    assert np.trapezoid(got["density"], got["x"]) == pytest.approx(1, abs=0.01)


def test_scalar_functions(spark):
    df = spark.createDataFrame([("runs/DS08a.v1.H5", "3.9", 90061)], "p string, n string, s long")
    got = df.select(scalars.path_suffix("p"), scalars.path_stem("p"), scalars.safe_int("n"),
                    scalars.duration_text("s"), scalars.dataset_id("p"),
                    scalars.safe_int(F.lit("x"))).first()
    assert tuple(got) == (".h5", "DS08a.v1", 3, "1 day, 1:01:01", "DS08a", None)


def test_envelope(spark):
    df = spark.createDataFrame([(0.1, 16000.0), (0.1, 18000.0), (0.7, 4000.0), (0.7, 6000.0), (0.9, 1.0)],
                               "m double, a double")
    assert [r[2] for r in project.in_envelope(df, "m", "a").collect()] == [True, False, False, True, False]


@pytest.mark.parametrize("kind", ["even", "normal", "gap", "ties"])
def test_moments_give_the_sums_of_all_neighbours(monkeypatch, kind):
    """Also where x has gaps, and with blocks of a few points."""
    rng = np.random.default_rng(3)
    m = 700
    x = {"even": np.arange(m) * 1.0, "normal": np.sort(rng.normal(size=m)), "ties": np.unique(rng.integers(0, 90, m)) * 1e6,
         "gap": np.sort(np.concatenate([rng.normal(size=m // 2), 50 + rng.normal(size=m - m // 2) * 1e-3]))}[kind]
    n = rng.integers(1, 5, len(x))
    w = n * rng.random(len(x))
    wy = w * rng.normal(size=len(x))
    for frac in (0.02, 0.15, 0.6, 1.0):
        k = smoothing._neighbours(int(n.sum()), frac)
        reach = smoothing.reaches(x, n, k)
        for i in range(0, len(x), 37):
            d = np.abs(x - x[i])
            order = np.argsort(d, kind="stable")
            assert reach[i] == d[order][np.searchsorted(np.cumsum(n[order]), k)]
        monkeypatch.setattr(smoothing, "DIRECT_NEIGHBOURS", 10**9)
        want = smoothing.fit_series(x, n, w, wy, k)
        monkeypatch.setattr(smoothing, "DIRECT_NEIGHBOURS", 0)
        np.testing.assert_allclose(smoothing.fit_series(x, n, w, wy, k), want, rtol=1e-7, atol=1e-8)


def brute_lowess(x, y, frac, iters):
    """One fit per point with one weight per point."""
    n = len(x)
    k = min(n, max(2, int(frac * n + 1e-10)))
    u = np.ones(n)
    for step in range(iters + 1):
        fit = np.empty(n)
        for i in range(n):
            dist = np.abs(x - x[i])
            h = np.sort(dist)[k - 1]
            w = (np.where(dist < 0.999 * h, (1 - np.minimum(dist / h, 1) ** 3) ** 3, 0.0) if h > 0
                 else (dist == 0) * 1.0)
            w = np.where((dist <= 0.001 * h), 1.0, w) * u
            if w.sum() <= 0:
                fit[i] = np.nan
                continue
            mx, my = np.average(x, weights=w), np.average(y, weights=w)
            sxx = (w * (x - mx) ** 2).sum()
            fit[i] = my if sxx <= 1e-12 * max(1, w.sum() * h * h) else my + (w * y * (x - mx)).sum() / sxx * (x[i] - mx)
        r = np.abs(y - np.where(np.isnan(fit), y, fit))
        m = np.median(r)
        ratio = r / (6 * m) if m > 0 else np.where(r == 0, 0.0, 1.0)
        u = np.where(ratio >= 0.999, 0.0, np.where(ratio <= 0.001, 1.0, (1 - ratio ** 2) ** 2))
    return np.where(np.isnan(fit), y, fit)


@pytest.mark.parametrize("iters,split", [(0, False), (2, False), (1, True)])
def test_lowess(spark, request, iters, split):
    if split:       # reduced series of more than 25 points are cut into blocks
        request.getfixturevalue("split_groups")
    rng = np.random.default_rng(2)
    parts = []
    for unit, n in [(1, 120), (2, 40), (3, 4)]:
        x = np.sort(rng.integers(0, 60, n)).astype(float)
        parts.append(pd.DataFrame({"unit": unit, "x": x, "y": np.sin(x / 5) + rng.normal(0, 0.2, n)}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["id"] = range(len(pdf))
    got = smoothing.lowess(spark.createDataFrame(pdf), "x", "y", 0.25, ["unit"], iters).toPandas().sort_values("id")
    for unit, g in pdf.groupby("unit"):
        mine = got[got["unit"] == unit]["y_smooth"].to_numpy()
        want = brute_lowess(g["x"].to_numpy(), g["y"].to_numpy(), 0.25, iters) if len(g) >= 5 else g["y"].to_numpy()
        np.testing.assert_allclose(mine, want, atol=1e-8)


def loop_forward(w, p):
    """The network written with plain loops."""
    def conv(x, name):
        kernel, bias = p[name], p[f"{name}_bias"]
        o, c, k = kernel.shape
        out = np.zeros((o, x.shape[1]))
        for i in range(o):
            for t in range(x.shape[1]):
                s = bias[i]
                for j in range(k):
                    at = t + j - k // 2
                    if 0 <= at < x.shape[1]:
                        s += (kernel[i, :, j] * x[:, at]).sum()
                out[i, t] = s if s > 0 else 0.01 * s
        return out

    def pool(x):
        return np.stack([x[:, max(0, t - 1):t + 2].max(axis=1) for t in range(x.shape[1])], axis=1)
    x = w.T
    x = np.concatenate([conv(x, "a_one"), conv(x, "a_three"), conv(x, "a_five"), conv(pool(x), "a_pool")])
    x = np.concatenate([conv(x, "b_one"), conv(conv(x, "b_three_in"), "b_three"),
                        conv(conv(x, "b_five_in"), "b_five"), conv(pool(x), "b_pool")])
    dense = p["dense"] @ x.reshape(-1) + p["dense_bias"]
    y = p["head"] @ np.where(dense > 0, dense, 0.01 * dense) + p["head_bias"]
    return np.maximum(np.log1p(np.exp(y)), 1e-9)


def test_network_against_loops_and_batch_size():
    p = network.seeded_params(1)
    batch = np.random.default_rng(0).normal(size=(3, 30, 18))
    got = network.forward(batch, p)
    np.testing.assert_allclose(got, [loop_forward(w, p) for w in batch], rtol=1e-9)
    np.testing.assert_allclose(got[1:2], network.forward(batch[1:2], p), rtol=1e-12)
    with pytest.raises(ValueError):
        network.forward(batch[:, :, :5], p)


def test_score_windows_keeps_rows_and_order_of_features(spark):
    pdf = pd.DataFrame({"id": range(50), "a": np.arange(50.0), "b": np.arange(50.0) * -1})
    df = spark.createDataFrame(pdf).select("id", F.transform(
        F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((F.col("a") + i).alias("a"), F.col("b").alias("b"))).alias("window"))

    def pick(x):
        return np.stack([x[:, 2, 0], x[:, 0, 1]], axis=1)
    got = scoring.score_windows(df, pick, ["a", "b"], 3, chunk=7).toPandas().sort_values("id")
    assert got["predicted_rul"].tolist() == [i + 2.0 for i in range(50)]
    assert got["predicted_std"].tolist() == [-float(i) for i in range(50)]
    assert (got["inference_latency_ms"] >= 0).all()


def test_calibration_feature_count():
    assert len(FEATURES) == 18 and list(calibration()) == FEATURES
    assert calibration()["Wf"] == (2.238, 0.866)


@pytest.mark.parametrize("block", [30, 37, 4096])
def test_a_series_is_scored_like_its_windows(spark, block):
    """Blocks with the rows before them give the windows that a frame gives, each once; also with the network."""
    from vanewright.operators.windows import sliding_windows
    cloudpickle.register_pickle_by_value(network)
    rng = np.random.default_rng(3)
    feats = [f"f{i}" for i in range(18)]
    rows = pd.DataFrame(rng.normal(size=(260, 18)), columns=feats).assign(unit=[1] * 150 + [2] * 80 + [3] * 29 + [4], at=range(260))
    df = spark.createDataFrame(rows).withColumn("unit", F.when(F.col("unit") != 2, F.col("unit"))).repartition(4)
    scorer = network.conv_scorer(network.seeded_params(7))
    got = scoring.score_series(df, scorer, feats, ["at"], 30, block=block)
    want = scoring.score_windows(sliding_windows(df, feats, ["at"], 30), scorer, feats, 30)
    plain = lambda d: sorted((r["at"], round(r["predicted_rul"], 9), round(r["predicted_std"], 9)) for r in d.collect())
    assert plain(got) == plain(want) and len(plain(want)) == 121 + 51
    assert got.columns == [*df.columns, "predicted_rul", "predicted_std", "inference_latency_ms"]
    with pytest.raises(ValueError):
        scoring.score_series(df, scorer, feats, ["at"], 30, block=8)
