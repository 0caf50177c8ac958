"""Column expressions shared by the operators.  All stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: smallest admitted model output.
OUTPUT_FLOOR = 1e-9


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softplus(c: Column | str) -> Column:
    """log(1 + exp(x)) without overflow for large |x|."""
    x = col_of(c)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def positive_head(c: Column | str) -> Column:
    """Softplus, then values not above the floor become the floor."""
    y = softplus(c)
    return F.when(y > OUTPUT_FLOOR, y).otherwise(F.lit(OUTPUT_FLOOR))


def safe_int(c: Column | str) -> Column:
    """Integer from text or a number that may be written as a float (truncated);
    null if it is neither, not a number or out of range."""
    as_double = col_of(c).try_cast("double")
    whole = F.when(as_double < 0, F.ceil(as_double)).otherwise(F.floor(as_double))
    return F.when((as_double > -2147483649.0) & (as_double < 2147483648.0), whole).try_cast("int")


def age_seconds(now_ms: Column | str, then_ms: Column | str) -> Column:
    return (col_of(now_ms) - col_of(then_ms)) / 1000.0


def duration_text(seconds: Column | str) -> Column:
    """Seconds as ``H:MM:SS``, with a day count in front from one day on."""
    s = F.floor(col_of(seconds)).cast("long")
    days, rest = F.floor(s / 86400), s % 86400
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600).cast("long"),
                            F.floor(rest % 3600 / 60).cast("long"), rest % 60)
    label = F.when(days == 1, "1 day, ").otherwise(F.concat(days.cast("string"), F.lit(" days, ")))
    return F.when(days > 0, F.concat(label, clock)).otherwise(clock)


def extract_key(text: Column | str, pattern: str, default: str = "N/A") -> Column:
    """First capture group, trimmed; ``default`` when the pattern is absent."""
    c = col_of(text)
    return F.when(c.rlike(pattern), F.trim(F.regexp_extract(c, pattern, 1))).otherwise(default)


def extract_keys(df: DataFrame, text: str, patterns: Mapping[str, str],
                 default: str = "N/A") -> DataFrame:
    return df.withColumns({k: extract_key(text, p, default) for k, p in patterns.items()})


def dataset_id(name: Column | str, pattern: str = r"DS[0-9]{2}[a-z]?") -> Column:
    """Dataset id inside a file name, the whole name when there is none.  The
    letter suffix is kept, so DS08a and DS08c stay apart."""
    c = col_of(name)
    found = F.regexp_extract(c, pattern, 0)
    return F.when(found != "", found).otherwise(c)


def extract_uuid(url: Column | str, prefix: str = "cellar/") -> Column:
    found = F.regexp_extract(col_of(url), prefix + r"([a-f0-9-]{36})", 1)
    return F.when(found != "", found)


def render_url(template: str, *values: Column | str) -> Column:
    """``template`` with each ``{}`` replaced by the next value."""
    parts = template.split("{}")
    if len(parts) != len(values) + 1:
        raise ValueError(f"template needs {len(parts) - 1} values, got {len(values)}")
    pieces: list[Column] = [F.lit(parts[0])]
    for value, tail in zip(values, parts[1:]):
        pieces += [col_of(value).cast("string"), F.lit(tail)]
    return F.concat(*pieces)


def path_name(path: Column | str) -> Column:
    return F.substring_index(col_of(path), "/", -1)


def path_suffix(path: Column | str) -> Column:
    """Lower-cased suffix with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(path_name(path), r"[^.](\.[^.]+)$", 1))


def path_stem(path: Column | str) -> Column:
    return F.regexp_replace(path_name(path), r"(?<=[^.])\.[^.]+$", "")


def json_get(doc: Column | str, paths: Sequence[str], default: str | None = None) -> Column:
    """First path that is present, else the default."""
    found = [F.get_json_object(col_of(doc), p) for p in paths]
    return F.coalesce(*found, F.lit(default))


def json_key_count(doc: Column | str, path: str = "$") -> Column:
    inner = F.get_json_object(col_of(doc), path)
    return F.coalesce(F.size(F.json_object_keys(inner)), F.lit(0))


def normal_quantiles(num_bins: int) -> list[tuple[float, float]]:
    """(p, inverse normal CDF of p) on an even grid over [0, 1]."""
    def inverse(p: float) -> float:
        if p <= 0:
            return float("-inf")
        return float("inf") if p >= 1 else NormalDist().inv_cdf(p)
    grid = [i / (num_bins - 1) for i in range(num_bins)]
    return [(p, inverse(p)) for p in grid]


def sha256_text(c: Column | str) -> Column:
    return F.sha2(col_of(c).cast("binary"), 256)


def field_of(window: Column | str, feature: str) -> Column:
    """Array of one field of an array of structs."""
    return F.transform(col_of(window), lambda x: x[feature])


def flatten_window(window: Column | str, features: Sequence[str]) -> Column:
    """``array<struct<features>>`` to one flat array, all steps of the first
    feature first."""
    w = col_of(window)
    return F.flatten(F.array(*[field_of(w, f) for f in features]))
