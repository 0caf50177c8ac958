"""Web pages and legal texts to section fragments.

A document is one row, so everything here is a narrow projection: no document
is exploded into lines and no shuffle is needed.  Sections are cut with a
lookahead at line starts, which keeps each heading with its own section.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.functions.scalars import col_of, path_name, path_suffix
from vanewright.operators.scanner import MarkdownBuilder

# Separator put between pieces; a code point no text contains.
CUT = "\ufdd0"
_GAP = r"[^\S\n]"   # white space inside a line

# Line ends, white space, headings, clean-up patterns, list starts.
LINE_ENDS = r"[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ARTICLE_LINE = (r"(?:#+" + _GAP + r"+)?(?:\*\*|__)?(?:Article|Chapter|Section)"
                + _GAP + r"+\d+")
ARTICLE_ID = r"(?U)Article\s+(\d+\w?)"
HEADER_LINE = r"#{1,5}" + _GAP
JSON_LD_START, JSON_LD = '{"@context":', r'\{"@context":[^\n]*\}'
ANCHOR_START, ANCHOR_LINK = "](#", r"\[([^\]]+)\]\(#[^\)]+\)"
# What a line of its own starts with.
LINE_STARTS = ["*", "-", "+", ">", "1.", "2.", "3.", "Yes:", "No:"]
CODE_TOKEN = r"CODETOKEN\d+BLOCK"


def unified_lines(text: Column | str) -> Column:
    """All line terminators become a line feed."""
    c = F.replace(col_of(text), F.lit("\r\n"), F.lit("\n"))
    return F.regexp_replace(c, LINE_ENDS, "\n")


def strip(c: Column) -> Column:
    """Trim white space of any kind at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def _pieces(text: Column, line: str) -> Column:
    """Cut before every line that starts with the pattern."""
    return F.split(text, rf"(?U)\n(?={line})")


def _without(c: Column, start: str, pattern: str, by: str) -> Column:
    """Regex replacement, tried only on texts that contain a fixed part of it."""
    return F.when(F.contains(c, F.lit(start)), F.regexp_replace(c, pattern, by)).otherwise(c)


def clean_paragraphs(text: Column | str, code_tokens: bool = False) -> Column:
    """Array of cleaned paragraphs of a text.

    Drops JSON-LD, unlinks in-page anchors, splits at blank lines, joins the
    lines of a paragraph, and starts a new paragraph at list items and labels;
    a line with a code token stands alone.
    """
    c = _without(col_of(text), JSON_LD_START, JSON_LD, "")
    c = _without(c, ANCHOR_START, ANCHOR_LINK, "$1")

    def marked(line: Column) -> Column:
        s = strip(line)
        starts = reduce(lambda a, b: a | b, [s.startswith(mark) for mark in LINE_STARTS])
        out = F.when(line == "", F.lit(CUT))
        if code_tokens:
            out = out.when(s.rlike(CODE_TOKEN), F.concat(F.lit(CUT), s, F.lit(CUT)))
        return out.when(starts, F.concat(F.lit(CUT), s)).otherwise(s)

    lines = F.filter(F.transform(F.split(c, "\n"), marked), lambda x: x != "")
    return F.filter(F.transform(F.split(F.array_join(lines, " "), CUT), strip), lambda p: p != "")


def chunk_by_articles(df: DataFrame, text: str, name: str = "fragments") -> DataFrame:
    """Array of article fragments: (section, article_id, type, text).

    Text before the first heading is a preamble fragment if it is not blank.
    A heading must stand on one line.
    """
    pieces = _pieces(F.col(text), ARTICLE_LINE)

    def fragment(p: Column) -> Column:
        line = F.substring_index(p, "\n", 1)
        headed = line.rlike(f"(?U)^{ARTICLE_LINE}")
        header = strip(line)
        body = strip(F.substr(p, F.length(line) + 2))
        found = F.regexp_extract(header, ARTICLE_ID, 1)
        section = strip(F.ltrim(header, F.lit("#")))
        return F.struct(
            F.when(headed, section).otherwise("Preamble/Recitals").alias("section"),
            F.when(headed, F.when(found != "", found).otherwise(header)).alias("article_id"),
            F.when(headed, F.lit("article")).otherwise("intro").alias("type"),
            F.when(headed, F.concat(header, F.lit("\n\n"), body)).otherwise(strip(p)).alias("text"))
    made = F.transform(pieces, fragment)
    return df.withColumn(name, F.filter(made, lambda f: (f["type"] == "article") | (f["text"] != "")))


def chunk_by_headers(df: DataFrame, text: str, name: str = "fragments",
                     codes: str | None = None) -> DataFrame:
    """Array of section fragments: (section, level, type, text paragraphs).

    Headings of level 1 to 5 start a section and stay its first line; deeper
    ones stay in the body.  Sections that are empty after cleaning are dropped.
    ``codes`` names a map of protected code blocks to put back.
    """
    pieces = _pieces(unified_lines(text), HEADER_LINE)
    tokens = codes is not None

    def fragment(p: Column) -> Column:
        line = F.substring_index(p, "\n", 1)
        headed = line.rlike(f"(?U)^{HEADER_LINE}")
        level = F.length(line) - F.length(F.ltrim(line, F.lit("#")))
        title = strip(F.ltrim(line, F.lit("#")))
        body = clean_paragraphs(p, tokens)
        if codes is not None:
            body = F.transform(body, lambda q: restore_code(q, F.col(codes)))
        return F.struct(
            F.when(headed, F.coalesce(F.get(clean_paragraphs(title, tokens), F.lit(0)), title))
             .otherwise("Introduction").alias("section"),
            F.when(headed, level).otherwise(0).alias("level"),
            F.lit("guide_section").alias("type"), body.alias("text"))
    made = F.transform(pieces, fragment)
    return df.withColumn(name, F.filter(made, lambda f: F.size(f["text"]) > 0))


def restore_code(paragraph: Column, codes: Column) -> Column:
    """Put each protected code block back as a fenced block."""
    return F.aggregate(
        F.map_entries(codes), paragraph,
        lambda acc, e: F.replace(acc, e["key"],
                                 F.concat(F.lit("```\n"), e["value"], F.lit("\n```"))))


def explode_fragments(df: DataFrame, keys: Sequence[str], name: str = "fragments") -> DataFrame:
    """One row per fragment with its position in the document."""
    out = _posexplode_once(df, keys, F.col(name), "chunk_no", "__f")
    return out.select(*keys, "chunk_no", "__f.*")


def _posexplode_once(df: DataFrame, keys: Sequence[str], array: Column, pos: str,
                     item: str) -> DataFrame:
    """``posexplode`` that computes its array once.

    For the inner form the optimiser adds a filter on the array's size below the
    generator, which repeats an expensive expression; the outer form with a
    filter on its output does not.
    """
    out = df.select(*keys, F.posexplode_outer(array).alias(pos, item))
    return out.where(F.col(pos).isNotNull())


def outline(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Heading lines of level 1 to 5: order, level, title."""
    found = F.regexp_extract_all(unified_lines(text), F.lit(r"(?dmU)^(#{1,5}" + _GAP + r"[^\n]*)$"),
                                 F.lit(1))
    heads = _posexplode_once(df, keys, found, "heading_no", "__h")
    return heads.select(*keys, "heading_no",
                        F.length(F.regexp_extract("__h", "^(#+)", 1)).alias("level"),
                        strip(F.regexp_replace("__h", r"(?U)^#+\s+", "")).alias("title"))


def chunk_stats(df: DataFrame, keys: Sequence[str], name: str = "fragments") -> DataFrame:
    """Number of fragments per document; documents without any are kept."""
    return df.select(*keys, F.coalesce(F.size(name), F.lit(0)).alias("chunk_count"))


def fragment_documents(df: DataFrame, metadata: Sequence[str], name: str = "fragments") -> DataFrame:
    """Nested export shape: metadata (with the chunk count) and fragments."""
    meta = F.struct(*metadata, F.size(name).alias("chunk_count"))
    return df.select(meta.alias("metadata"), F.col(name).alias("fragments"))


XHTML = "http://www.w3.org/1999/xhtml"  # fixed value: namespace marker


def validate_markup(df: DataFrame, html: str, name: str = "valid_markup",
                    marker: str = XHTML) -> DataFrame:
    """Flag whether the expected namespace marker is present; rows are kept."""
    return df.withColumn(name, F.coalesce(F.contains(html, F.lit(marker)), F.lit(False)))


def html_to_markdown(df: DataFrame, html: str, drop_tags: Sequence[str] = ("script", "style"),
                     protect_pre: bool = False, name: str = "markdown",
                     codes: str = "codes", unwrap_tags: Sequence[str] = ()) -> DataFrame:
    """Markdown with ``#`` headings from HTML; ``drop_tags`` are dropped with their
    content, ``unwrap_tags`` lose their marks and keep it.  With ``protect_pre`` each
    ``<pre>`` becomes a code token and its text goes to the ``codes`` map.
    ``GUIDE_UNWRAP`` and ``LEGAL_UNWRAP`` are the lists of the two ingestion paths.

    The only Python step of the document jobs: Arrow batches of one column, bounded in bytes by the session
    (``vanewright.session``), of which ``PAGES`` pages at a time are Python objects.
    """
    drop, unwrap = tuple(drop_tags), tuple(unwrap_tags)

    @F.arrow_udf("struct<markdown string, codes map<string, string>>")
    def convert(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), PAGES):
                rows = [_convert(page.as_py(), drop, protect_pre, unwrap) for page in batch.slice(start, PAGES)]
                yield pa.StructArray.from_arrays([
                    pa.array([m for m, _ in rows], pa.string()),
                    pa.array([c if c is None else list(c.items()) for _, c in rows], pa.map_(pa.string(), pa.string()))],
                    names=["markdown", "codes"])

    out = df.withColumn("__md", convert(F.col(html)))
    out = out.withColumn(name, F.col("__md.markdown"))
    if protect_pre:
        out = out.withColumn(codes, F.col("__md.codes"))
    return out.drop("__md")


#: Pages that are converted before their Markdown leaves Python.
PAGES = 64

# Tags that the two ingestion paths unwrap.
GUIDE_UNWRAP = ("script", "style", "nav", "footer")
LEGAL_UNWRAP = ("script", "style", "img")


def _convert(page: str | None, drop: tuple[str, ...], protect_pre: bool, unwrap: tuple[str, ...] = ()):
    if page is None:
        return None, None
    builder: HTMLParser = MarkdownBuilder(drop, protect_pre, unwrap)
    builder.feed(page)
    builder.close()
    return builder.markdown(), builder.codes


def ingest_all(registry: DataFrame, pages: DataFrame, slug: str = "slug",
               html: str = "html") -> DataFrame:
    """Registry entries with their page and a status; an entry without content
    is a failure."""
    side = pages.withColumn("__slug", F.upper(slug)).drop(slug)
    joined = registry.withColumn("__slug", F.upper(slug)).join(side, "__slug", "left").drop("__slug")
    return joined.withColumn("status", F.when(F.col(html).isNull(), "FAILED").otherwise("OK"))


def ingest_summary(ingested: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAILED")
    return ingested.agg(F.count(F.lit(1)).alias("documents"), failed.alias("failures"),
                        F.when(failed > 0, 1).otherwise(0).alias("exit_status"))


# Suffixes per department, and those that get a signature.
MODEL_SUFFIXES = [".safetensors", ".pt"]
SIGNABLE = [".pt", ".ckpt", ".parquet", ".csv", ".safetensors", ".json"]


def classify_artifacts(files: DataFrame, path: str = "path") -> DataFrame:
    """Department of each artifact (first rule that matches) and whether it is
    to be signed."""
    file_name, suffix = F.lower(path_name(path)), path_suffix(path)
    department = (
        F.when(file_name.startswith("provenance.json"), "security")
         .when(suffix.isin(*MODEL_SUFFIXES), "model")
         .when(suffix == ".parquet", "data")
         .when(file_name.endswith(".lmdb"), "data")
         .when(F.contains(file_name, F.lit("tfevents")) | (suffix == ".log"), "logs")
         .when(file_name.endswith("hparams.yaml"), "metadata")
         .when(suffix.isin(".sig", ".cert"), "security")
         .otherwise("unclassified"))
    return files.withColumns({"department": department, "signable": suffix.isin(*SIGNABLE)})


def route_inputs(files: DataFrame, path: str = "path", data_suffix: str = ".h5") -> DataFrame:
    """Telemetry files against other resources."""
    kind = F.when(path_suffix(path) == data_suffix, "telemetry").otherwise("resources")
    return files.withColumn("kind", kind)


def manifest_counts(files: DataFrame, path: str = "path") -> DataFrame:
    return (classify_artifacts(files, path).groupBy("department")
            .agg(F.count(F.lit(1)).alias("files")))
