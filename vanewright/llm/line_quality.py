"""Cross-document line frequency, with DataFrame functions only.

Lines are normalised (lower case, white space runs as one space, ends trimmed) and
hashed.  Per host, the documents that hold a line are counted; equal texts of a host
count as one document.  A line held by more than ``min_docs`` documents and more than
``share`` of the host's documents is boilerplate and is removed.  A document that
keeps fewer than ``least_words`` words or less than ``keep`` of its words is depleted.

Rows are reduced to hashes in the one pass over the texts, equal texts of a host to
one row, and lines to partial counts before they are shuffled, so neither a hot host
nor a line in all its documents gathers rows in one task.

Defined results: null and empty texts have no words and fail the base rules; a null
host is the host named by the empty string; repeated rows are one document for the
counts and are judged alike; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held

WHITE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    min_docs: int = 10
    share: float = 0.005
    keep: float = 0.5
    least_words: int = 10
    window: int = 5
    most_repeated: int = 20  # percent


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), WHITE, " "))


def _with_base(docs: DataFrame, cfg: LineRules) -> DataFrame:
    """Word, symbol and repetition counts from (id, host, text)."""
    k = cfg.window
    text = F.col("text")
    out = docs.withColumn("words", _words(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(
        "id", "host", "k1", "k2", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    grams = F.when(F.size("hashes") >= k, F.transform(
        F.sequence(F.lit(0), F.size("hashes") - k),
        lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(k)]))).otherwise(F.array().cast("array<long>"))
    out = out.select("id", "host", "k1", "k2", "n_words", "word_chars", "n_symbols",
                     (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                     F.transform("lines", lambda x: F.xxhash64(_normal(x))).alias("line"),
                     F.transform("lines", lambda x: F.size(_words(x))).alias("line_words"), grams.alias("grams"))
    # Equal windows stand side by side once sorted; texts without any are left alone.
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    out = out.withColumn("sorted", F.when(twice, F.array_sort(
        F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("grams")
    gram = lambda j: F.get("sorted", j)["g"]
    out = out.withColumn("at", F.when(F.col("sorted").isNotNull(), F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("sorted") - 1),
                 lambda j: (gram(j) == gram(j + 1)) | (gram(j) == F.when(j > 0, gram(j - 1)))),
        lambda j: F.get("sorted", j)["i"])))).drop("sorted")
    steps = F.transform("at", lambda x, j: F.least(F.lit(k), F.coalesce(F.get("at", j + 1) - x, F.lit(k))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("at")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > cfg.most_repeated * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def frequent_lines(rows: DataFrame, cfg: LineRules) -> DataFrame:
    """(host, line, n_docs) of the lines above the limits, from one row per text and host."""
    lines = rows.select("host", F.explode(F.array_distinct("line")).alias("line"))
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > cfg.min_docs)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    return counted.join(hosts, "host").where(F.col("n_docs") > cfg.share * F.col("of")).select("host", "line", "n_docs")


def line_quality(docs: DataFrame, cfg: LineRules = LineRules(), id_col: str = "doc_id", text: str = "text",
                 host: str = "source") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_frequent_lines, n_words_left, frequent) per row; ``frequent`` are the hashes of its
    lines above the limits, with which ``without_lines`` cuts the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(host), F.lit("")).alias("host"), body.alias("text"),
                       F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"))
    rows = held(_with_base(rows, cfg))
    texts = rows.select("host", "k1", "k2", "line", "line_words").dropDuplicates(["host", "k1", "k2"])
    frequent = frequent_lines(texts, cfg).select("host", "line")
    each = texts.select("host", "k1", "k2", F.inline(F.arrays_zip("line", "line_words")))
    gone = each.join(frequent, ["host", "line"]).groupBy("host", "k1", "k2").agg(
        F.count(F.lit(1)).alias("n_frequent_lines"), F.sum("line_words").alias("gone"), F.collect_set("line").alias("frequent"))
    out = rows.drop("line", "line_words").join(gone, ["host", "k1", "k2"], "left")
    left = F.col("n_words") - F.coalesce("gone", F.lit(0).cast("long"))
    kept = ~F.col("base_failed") & (left >= cfg.least_words) & (left >= cfg.keep * F.col("n_words"))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", kept.alias("kept"),
                      F.coalesce("n_frequent_lines", F.lit(0).cast("long")).alias("n_frequent_lines"),
                      left.alias("n_words_left"),
                      F.coalesce("frequent", F.array().cast("array<long>")).alias("frequent"))


def without_lines(text: Column | str, frequent: Column | str) -> Column:
    """The text without its lines whose hash is listed; other lines, blank ones too, stay."""
    gone = F.col(frequent) if isinstance(frequent, str) else frequent
    lines = F.split(F.col(text) if isinstance(text, str) else text, "\n")
    return F.array_join(F.filter(lines, lambda x: ~F.array_contains(gone, F.xxhash64(_normal(x)))), "\n")
