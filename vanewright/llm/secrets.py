"""Secrets by base patterns and character Markov models, with DataFrame functions only.

Two first-order models over ASCII characters, of random strings and of ordinary
identifiers, give each character after another a log-likelihood ratio.  A long run of
key characters whose ratios sum to at least ``least_total`` and average at least
``least_mean`` is a secret.  A run that one span of the base patterns holds whole is not judged again; a
run that reaches beyond is judged as a whole, and its span may overlap theirs.  The models
are trained from labelled samples: rows of (token, random), here the values that the
base patterns find and the ordinary words of the texts.  Counts of character pairs, at
most 2 * 128 * 128 numbers, are all that reaches the driver.

Places of matches come from the lengths of the matches and of the text between them, summed up by
doubling steps, so a text of n matches takes n log n.

Defined results: null and empty texts have no span; without samples of both kinds no
span is added; repeated rows are scanned each; null ids are carried; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base patterns in their order, the group whose length counts, and its least length.
BASE = [
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
#: A cheaper pattern that every match long enough contains, so that other texts are left alone.
HINTS = {"assign": r"(?i)password|passwd|secret|token|api_?key", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}",
         "markov": "[A-Za-z0-9+/_-]{16}"}
#: A run of 16 or more; shorter ones are no match at all, which leaves the longer ones as they are.
LONG = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Weight of single characters in a pair's row, and count that every character starts with.
BACKING, BARE = 5.0, 0.1
#: Spans up to which a text is cut by places in it.
FEW_SPANS = 32
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


@dataclass(frozen=True)
class Markov:
    run: str = r"[A-Za-z0-9+/_-]{16,}"
    word: str = r"[A-Za-z][A-Za-z0-9_-]{9,}"
    least_total: float = 8.0
    least_mean: float = 0.5


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Each element joined with all before it; ``join`` gets null where there is none.  Each step
    doubles how far back an element reaches."""
    return F.aggregate(F.array(*[F.lit(1 << b) for b in range(31)]), values, lambda acc, far: F.when(
        far < F.size(acc), F.transform(acc, lambda x, i: join(x, F.get(acc, i - far)))).otherwise(acc))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, rank: int) -> tuple[Column, Column]:
    """Two stages: matches with the gaps before them, and, from a column of the first, spans."""
    some = text.rlike(HINTS[kind])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))
    first = F.when(some, F.struct(F.transform(found, lambda m: F.length(m)).alias("sizes"), value.alias("value"), gaps.alias("gaps")))
    col = F.col(f"__{kind}")
    steps = F.transform(F.arrays_zip(col["sizes"].alias("size"), F.slice(col["gaps"], 1, F.greatest(F.size(col["sizes"]), F.lit(0))).alias("gap")),
                        lambda m: m["size"] + m["gap"])
    rows = F.arrays_zip(col["sizes"].alias("size"), col["value"].alias("value"), running(steps, lambda x, y: x + F.coalesce(y, F.lit(0))).alias("end"))
    spans = F.transform(rows, lambda m: F.struct((m["end"] - m["size"]).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                                                 m["end"].alias("end"), m["value"].alias("value")))
    return first, F.coalesce(F.filter(spans, lambda m: F.length(m["value"]) >= least), F.array().cast(SPAN))


def _with_spans(rows: DataFrame, kinds: list[tuple[str, str, int, int]], ranks: dict[str, int]) -> DataFrame:
    made = {k: _spans(F.col("text"), k, LONG.get(k, p), g, n, ranks[k]) for k, p, g, n in kinds}
    rows = rows.withColumns({f"__{k}": first for k, (first, _) in made.items()})
    return rows.withColumns({k: spans for k, (_, spans) in made.items()}).drop(*[f"__{k}" for k in made])


def _base(docs: DataFrame, id_col: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *carry)
    rows = _with_spans(rows, BASE, {k: i for i, (k, *_) in enumerate(BASE)})
    return rows.withColumn("base", F.array_sort(F.concat(*[F.col(k) for k, *_ in BASE])))


def samples(docs: DataFrame, cfg: Markov = Markov(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(token, random): values that the base patterns find, and the words that at least two
    texts without such values hold, each once; an unlisted secret is hardly found twice."""
    rows = _base(docs, id_col, text)
    secret = rows.select(F.explode(F.transform("base", lambda s: s["value"])).alias("token"), F.lit(True).alias("random"))
    clean = F.regexp_extract_all(F.when(F.size("base") == 0, F.col("text")), F.lit(cfg.word), F.lit(0))
    words = rows.select(F.explode(F.array_distinct(clean)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return secret.unionByName(words.where("n > 1").select("token", F.lit(False).alias("random")))


def train(labelled: DataFrame) -> list[float] | None:
    """128 * 128 log-likelihood ratios by previous and next character, from (token, random)."""
    codes = F.transform(F.filter(F.split("token", ""), lambda c: c != ""), lambda c: F.ascii(c))
    pairs = F.transform(F.col("codes"), lambda c, i: F.when((i > 0) & (c < 128) & (F.get("codes", i - 1) < 128),
                                                             F.get("codes", i - 1) * 128 + c))
    counted = labelled.groupBy("token", "random").agg(F.count(F.lit(1)).alias("n")).withColumn("codes", codes)
    counted = counted.select("random", "n", F.explode(pairs).alias("pair")).where("pair is not null") \
                     .groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()
    table = {True: [0.0] * (128 * 128), False: [0.0] * (128 * 128)}
    for r in counted:
        table[r["random"]][r["pair"]] += r["n"]
    if not any(table[True]) or not any(table[False]):
        return None
    alphabet = sorted({c for r in counted for c in (r["pair"] % 128, r["pair"] // 128)})

    def log(kind: bool) -> list[float]:
        """Pairs are smoothed towards the model's single characters, those evenly."""
        n, out = table[kind], [0.0] * (128 * 128)
        of = {b: sum(n[b::128]) + BARE for b in alphabet}
        all_ = sum(of.values())
        for a in alphabet:
            row = sum(n[128 * a:128 * a + 128]) + BACKING
            for b in alphabet:
                out[128 * a + b] = math.log((n[128 * a + b] + BACKING * of[b] / all_) / row)
        return out

    return [a - b for a, b in zip(log(True), log(False))]


def ratio(token: Column, table: Column) -> Column:
    """Sum of the ratios of a token's characters."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).cast("double").alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        add = F.when(acc["last"] >= 0, F.coalesce(F.get(table, acc["last"] * 128 + code), F.lit(0.0))).otherwise(0.0)
        return F.struct(code.alias("last"), (acc["sum"] + add).alias("sum"))

    return F.aggregate(F.filter(F.split(token, ""), lambda c: c != ""), start, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, model: list[float] | None, cfg: Markov = Markov(), id_col: str = "doc_id", text: str = "text",
         carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, text, base, spans) per row: spans are (start, rank, kind, end, value) in code points, end
    exclusive, by start and kind; ``base`` without those of the models."""
    rows = _base(docs, id_col, text, carry)
    if model is None:
        out = rows.withColumn("spans", F.col("base"))
    else:
        rows = _with_spans(rows, [("markov", cfg.run, 0, 1)], {"markov": len(BASE)})
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
        every = F.array_sort(F.concat("base", "markov"))
        # The furthest end of base spans that start no later.
        held = running(F.transform(every, lambda s: F.when(s["rank"] < len(BASE), s["end"]).otherwise(0)), F.greatest)
        loose = F.filter(F.arrays_zip(every.alias("span"), held.alias("held")),
                         lambda x: (x["span"]["rank"] == len(BASE)) & (x["held"] < x["span"]["end"]))
        free = F.transform(loose, lambda x: x["span"])

        def secret(s: Column) -> Column:
            return ratio(s["value"], table) >= F.greatest(F.lit(cfg.least_total), cfg.least_mean * F.length(s["value"]))

        rows = rows.withColumn("free", free)
        out = rows.withColumn("spans", F.array_sort(F.concat("base", F.filter("free", secret))))
    return out.select(F.col("id").alias(id_col), "text", "base", "spans", *carry)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans replaced by ``mark``.  Characters are looked up from
    the text's beginning, so a text of many spans is taken apart into characters first."""
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
    gaps = F.transform(F.filter(F.arrays_zip(spans.alias("span"), before.alias("pos")), lambda x: x["span"]["start"] >= x["pos"]),
                       lambda x: F.struct(x["pos"].alias("pos"), (x["span"]["start"] - x["pos"]).alias("n")))
    last = F.struct(F.element_at(ends, -1).alias("pos"), F.lit((1 << 31) - 1).alias("n"))
    parts = F.concat(gaps, F.array(last))
    few = F.array_join(F.transform(parts, lambda g: F.substring(text, g["pos"] + 1, g["n"])), mark)
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    many = F.element_at(F.transform(F.array(chars), lambda c: F.array_join(
        F.transform(parts, lambda g: F.array_join(F.slice(c, g["pos"] + 1, F.least(g["n"], F.size(c))), "")), mark)), 1)
    return F.when(F.size(spans) == 0, text).when(F.size(spans) <= FEW_SPANS, few).otherwise(many)
