"""Null keys, null and NaN values: equal rows whatever the input's size is taken for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.functions.scalars import safe_int
from vanewright.operators import metrics, profile, scaling, smoothing, text, windows
from vanewright.operators.scanner import MarkdownBuilder
from vanewright.plans.sizing import lookup_join
from vanewright.schemas import FEATURES
from vanewright.sources import packets as bus

NAN = float("nan")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = [(u, i, float(i % 40), float(rng.normal(10, 3))) for i, u in enumerate([1] * 60 + [2] * 30 + [None] * 40)]
    out += [(3, 200 + i, float(i), None) for i in range(8)]                # no y at all
    out += [(1, 300, None, 5.0), (1, 301, 3.0, None), (1, 302, 4.0, NAN), (None, 303, None, 1.0), (2, 304, NAN, 2.0)]
    return spark.createDataFrame(out, "unit int, row int, x double, y double")


@pytest.fixture(params=["default", "forced"])
def size(request):
    if request.param == "forced":
        request.getfixturevalue("split_groups")
    return request.param


RESULTS = {}
CASES = {
    "w9": lambda df: smoothing.lowess(df, "x", "y", 0.3, ["unit"], 1),
    "a5": lambda df: profile.describe_features(df, ["x", "y"], ["unit"]),
    "a5_all": lambda df: profile.describe_features(df.withColumn("z", F.lit(None).cast("double")), ["x", "y", "z"]),
    "a11": lambda df: metrics.kde(df.where("not isnan(y)"), "y", ["unit"], 10),
    "w12": lambda df: windows.chart_buckets(df.where("y is not null and not isnan(y)"), ["unit"], ["row"], "y", 5, 4),
    "w13": lambda df: windows.piecewise_rul(df, F.col("row") % 3 > 0, "row"),
    "w14": lambda df: windows.raw_rul(df, "unit", "row"),
}


def canon(df):
    plain = lambda v: "nan" if isinstance(v, float) and v != v else round(v, 8) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("case", list(CASES))
def test_same_rows_for_every_size(rows, size, case):
    got = canon(CASES[case](rows))
    if case in ("w9", "w13", "w14"):
        assert len(got) == rows.count()
    if case == "a5":
        assert len(got) == 8  # four groups, two features
    assert RESULTS.setdefault(case, got) == got


def test_points_without_y_carry_no_weight(spark):
    df = spark.createDataFrame([(1, float(i), None if i % 4 == 0 else 10.0) for i in range(40)], "unit int, x double, y double")
    got = smoothing.lowess(df, "x", "y", 0.3).collect()
    assert all(r["y_smooth"] is None if r["y"] is None else abs(r["y_smooth"] - 10) < 1e-9 for r in got)


def test_lookup_matches_null_keys(spark):
    facts = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    side = spark.createDataFrame([(None, "n"), (1, "one")], "k int, name string")
    assert sorted((r["v"], r["name"]) for r in lookup_join(facts, side, ["k"], "left").collect() if r["name"]) == [(1, "n"), (2, "one")]
    assert lookup_join(facts, facts.groupBy("k").agg(F.max("v").alias("m")), ["k"]).count() == 3


def test_scalers_skip_nan(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", NAN), ("A", 3.0), ("B", None), ("C", NAN)], "dataset string, a double")
    for pooled in ("within", "total"):
        r = scaling.compute_scalers(df, ["a"], pooled=pooled).first()
        assert (r["mean"], r["std"]) == (2.0, 1.0)
    assert scaling.pool_moments(scaling.moments(df, ["a"], ["dataset"])).first()["mean"] == 2.0
    assert profile.normalization_params(df, ["a"]).first()["mean"] == 2.0


def test_ids_out_of_range_are_dead_letters(spark):
    values = ['{"unit":1e12,"cycle":1}', '{"unit":1,"cycle":"NaN"}', '{"unit":-3e9,"cycle":2}', '{"unit":7.9,"cycle":2,"timestamp_ms":1}', "{", "{}"]
    df = spark.createDataFrame([("k", x) for x in values], "key string, value string")
    assert [r["unit"] for r in bus.decode_packets(df, FEATURES).collect()] == [7]
    assert bus.dead_letters(df, FEATURES).count() == 5
    got = spark.createDataFrame([("1e300",), ("nan",), ("2147483647",), ("-2147483648.5",), ("x",)], "s string").select(safe_int("s")).collect()
    assert [r[0] for r in got] == [None, None, 2147483647, -2147483648, None]


def markdown(html, drop=(), unwrap=(), protect=False):
    b = MarkdownBuilder(drop, protect, unwrap)
    b.feed(html)
    b.close()
    return b.markdown(), b.codes


def test_tags_dropped_or_unwrapped():
    page = "<body><nav><p>menu</p></nav><p>text <img src=a alt=b></p><footer>end</footer></body>"
    assert markdown(page, drop=("nav", "footer", "img"))[0] == "text"
    assert markdown(page, unwrap=text.GUIDE_UNWRAP)[0] == "menu\n\ntext ![b](a)\n\nend"
    assert "![b]" not in markdown(page, unwrap=text.LEGAL_UNWRAP)[0]


def test_unclosed_dropped_tag_ends_with_its_parent():
    assert markdown("<div><nav>menu</div><p>rest</p>", drop=("nav",))[0] == "rest"


def test_nested_code_keeps_the_outer_part():
    got, codes = markdown("<pre>a\n<pre>b</pre>\nc</pre><p>after</p>", protect=True)
    assert got == "CODETOKEN0BLOCK\n\nafter" and codes == {"CODETOKEN0BLOCK": "a\nb\nc"}
