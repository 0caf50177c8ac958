"""Fixed schemas and constants of the telemetry data model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Sensor names in wire order, the four operating conditions first.
FEATURES = ["alt", "Mach", "TRA", "T2", "T24", "T30", "T48", "T50", "P15", "P2", "P21", "P24", "Ps30",
            "P40", "P50", "Nf", "Nc", "Wf"]

# Calibration means and standard deviations, same order.
CALIBRATION_MEAN = [18375.578, 0.554, 56.001, 481.217, 557.680, 1306.740, 1614.074,
                    1109.814, 11.690, 9.184, 11.868, 14.350, 211.620, 215.370, 9.108,
                    1928.724, 8157.898, 2.238]
CALIBRATION_STD = [9180.933, 0.122, 25.770, 24.453, 25.732, 78.967, 136.788, 69.182,
                   3.305, 2.783, 3.356, 3.966, 66.146, 67.114, 3.053, 219.767, 262.483,
                   0.866]

# Columns that are never scaled (substring match), replay fleet,
# packets per window, value above which a reading is taken as physical.
META_PATTERN = "unit|cycle|Fc|hs|rul"
REPLAY_FLEET = {11: 10, 14: 10, 15: 10}
WINDOW_SIZE = 30
PHYSICAL_ABOVE = 15.0


def calibration() -> dict[str, tuple[float, float]]:
    """Default (mean, std) per feature."""
    return {f: (m, s) for f, m, s in zip(FEATURES, CALIBRATION_MEAN, CALIBRATION_STD)}


def fleet_schema(features: Sequence[str] = FEATURES) -> T.StructType:
    """Scored, dual-domain table: ids, scores, physical and z-space features."""
    fields = [T.StructField("timestamp_ms", T.LongType()),
              T.StructField("unit", T.IntegerType()),
              T.StructField("cycle", T.IntegerType())]
    names = ["predicted_rul", "predicted_std", "true_rul", "inference_latency_ms",
             *features, *[f"{f}_z" for f in features]]
    return T.StructType(fields + [T.StructField(n, T.FloatType()) for n in names])


def packet_schema(features: Sequence[str] = FEATURES) -> T.StructType:
    """JSON packet; ids may be numbers or text.  Column names ignore case, so the label's
    second spelling (``RUL``) is read by path when ``rul`` is absent."""
    return T.StructType([T.StructField(n, T.DoubleType()) for n in [*features, "Fc", "rul"]]
                        + [T.StructField(n, T.StringType()) for n in ("unit", "cycle")]
                        + [T.StructField("timestamp_ms", T.LongType())])


METRIC_LOG = T.StructType([
    T.StructField("tag", T.StringType()), T.StructField("step", T.LongType()),
    T.StructField("wall_time", T.DoubleType()), T.StructField("value", T.DoubleType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema, in its column order."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
