"""Ordered operators on a skewed table: one key holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanewright.operators import windows
from vanewright.plans import ordered, sizing


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    n = 3000
    unit = np.where(rng.random(n) < 0.34, 1, rng.integers(2, 60, n))
    pdf = pd.DataFrame({"unit": unit, "t": rng.integers(0, 40, n), "seq": rng.permutation(n),
                        "cycle": rng.integers(1, 6, n), "x": rng.normal(size=n).round(3)})
    return pdf


def frame(spark, pdf):
    return spark.createDataFrame(pdf).repartition(5)


def expected(pdf):
    return pdf.sort_values(["unit", "t", "seq"]).reset_index(drop=True)


def collected(df):
    return df.toPandas().sort_values(["unit", "t", "seq"]).reset_index(drop=True)


@pytest.fixture(params=["plain", "split"])
def mode(request):
    if request.param == "split":
        request.getfixturevalue("split_groups")
    return request.param


def test_hot_groups_are_found(spark, skewed, split_groups):
    hot = {r["unit"]: r["__n"] for r in sizing.hot_groups(frame(spark, skewed), ["unit"]).collect()}
    counts = skewed.groupby("unit").size()
    assert hot == counts[counts > 25].to_dict()


def test_hot_group_list_is_bounded(spark, skewed, split_groups):
    spark.conf.set(sizing.CONF_PREFIX + "max_hot", "2")
    try:
        assert sizing.hot_groups(frame(spark, skewed), ["unit"]).count() == 2
        got = collected(ordered.dense_index(frame(spark, skewed), ["unit"], ["t", "seq"]))
        want = expected(skewed)
        assert (got["row_idx"] == want.groupby("unit").cumcount()).all()
    finally:
        spark.conf.unset(sizing.CONF_PREFIX + "max_hot")


def test_no_profile_job_for_small_inputs(spark, skewed):
    assert sizing.hot_groups(frame(spark, skewed), ["unit"]) is None


def test_dense_index(spark, skewed, mode):
    got = collected(ordered.dense_index(frame(spark, skewed), ["unit"], ["t", "seq"], total="n"))
    want = expected(skewed)
    assert (got["row_idx"] == want.groupby("unit").cumcount()).all()
    assert (got["n"] == want.groupby("unit")["x"].transform("size")).all()
    assert len(got) == len(skewed)


def test_running_sum(spark, skewed, mode):
    got = collected(ordered.running_sum(frame(spark, skewed), ["unit"], ["t", "seq"], "cycle", "s", "all"))
    want = expected(skewed)
    assert (got["s"] == want.groupby("unit")["cycle"].cumsum()).all()
    assert (got["all"] == want.groupby("unit")["cycle"].transform("sum")).all()


def test_null_key_group(spark, skewed, mode):
    df = frame(spark, skewed).withColumn("unit", F.when(F.col("unit") > 1, F.col("unit")))
    got = ordered.dense_index(df, ["unit"], ["t", "seq"]).where("unit IS NULL").toPandas()
    assert sorted(got["row_idx"]) == list(range(len(got)))
    assert len(got) == (skewed["unit"] == 1).sum()


@pytest.mark.parametrize("n", [2, 10, 40])
def test_moving_average(spark, skewed, mode, n):
    got = collected(windows.moving_average(frame(spark, skewed), ["x"], ["t", "seq"], n, ["unit"]))
    want = expected(skewed)
    rolled = want.groupby("unit")["x"].transform(lambda s: s.rolling(n, 1).mean())
    np.testing.assert_allclose(got["x"], rolled, atol=1e-9)


def test_sliding_windows(spark, skewed, mode):
    got = collected(windows.sliding_windows(frame(spark, skewed), ["x"], ["t", "seq"], 30))
    want = expected(skewed)
    pos = want.groupby("unit").cumcount()
    full = want[pos >= 29].reset_index(drop=True)
    assert got["seq"].tolist() == full["seq"].tolist()
    by_seq = {r.seq: i for i, r in enumerate(want.itertuples())}
    for row in got.sample(40, random_state=1).itertuples():
        end = by_seq[row.seq]
        assert [w["x"] for w in row.window] == want["x"][end - 29:end + 1].tolist()


def test_session_ids(spark, skewed, mode):
    got = collected(windows.session_ids(frame(spark, skewed), ["t", "seq"]))
    want = expected(skewed)
    fell = want.groupby("unit")["cycle"].diff() < 0
    assert (got["session_id"] == fell.astype(int).groupby(want["unit"]).cumsum()).all()


@pytest.mark.parametrize("k", [1, 7])
def test_stride_sample(spark, skewed, mode, k):
    got = collected(windows.stride_sample(frame(spark, skewed), ["t", "seq"], k, ["unit"]))
    picked = []
    for _, g in expected(skewed).groupby("unit"):
        step = max(1, len(g) // k)
        picked.append(g.iloc[::step][:k])
    assert got["seq"].tolist() == pd.concat(picked)["seq"].tolist()
    assert got.groupby("unit").size().max() <= k


@pytest.mark.parametrize("length,step,skip", [(6, 4, 1), (5, 5, 2), (4, 6, 3)])
def test_training_windows(spark, skewed, mode, length, step, skip):
    df = frame(spark, skewed).withColumn("rul", F.col("seq"))
    got = windows.training_windows(df, ["x"], ["t", "seq"], length, step, skip).toPandas()
    made = {(r.unit, r.window_start): ([w["x"] for w in r.window], r.label) for r in got.itertuples()}
    want = {}
    for unit, g in expected(skewed).groupby("unit"):
        thin = g.iloc[::skip]
        for s in range(0, len(thin) - length + 1, step):
            part = thin.iloc[s:s + length]
            want[(unit, s)] = (part["x"].tolist(), part["seq"].iloc[-1])
    assert made == want


def test_label_jitter(spark, skewed, mode):
    got = collected(windows.label_jitter(frame(spark, skewed), ["t", "seq"], "x"))
    want = expected(skewed)
    diff = want.groupby("unit")["x"].diff()
    assert got["seq"].tolist() == want[diff > 0]["seq"].tolist()


def test_chart_buckets(spark, skewed, mode):
    got = windows.chart_buckets(frame(spark, skewed), ["unit"], ["t", "seq"], "x", 20, 5).toPandas()
    for unit, g in expected(skewed).groupby("unit"):
        v = g["x"].tolist()
        mine = got[got["unit"] == unit].sort_values("column_idx")
        assert mine["value"].tolist() == [v[i * len(v) // 20] for i in range(20)]
        lo, rng = min(v), (max(v) - min(v)) or 1
        filled = [sum(x > lo + h / 5 * rng for h in range(6)) for x in mine["value"]]
        assert all(abs(a - b) <= 1 for a, b in zip(mine["level"], filled))


def test_take_per_group_prunes_before_the_shuffle(spark, skewed):
    df = ordered.take_per_group(frame(spark, skewed), ["unit"], ["t", "seq"], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
