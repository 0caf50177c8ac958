"""Document entries (T) and nested export (K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanewright.catalog import views as v
from vanewright.catalog.views import Entry, oracle
from vanewright.operators import text as t
from vanewright.plans.sizing import spread
from vanewright.sources import sinks

# Line-wise counterparts of the section cutters.
_TRIM = r"regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def trim(c: str) -> str:
    return _TRIM.format(c=c)


CLEAN = (r"""regexp_replace(regexp_replace({c}, '\{{"@context":.*\}}', '', 'g'), """
         r"""'\[([^\]]+)\]\(#[^\)]+\)', '\1', 'g')""")
STRUCT = r"regexp_matches(tr, '^([*\-+>]|1\.|2\.|3\.|Yes:|No:)')"

SEGMENTS = """
cl AS (SELECT *, {clean} AS c FROM {src}),
tl AS (SELECT *, {trim} AS tr FROM cl),
sg AS (SELECT *, sum(CASE WHEN c = '' OR {struct} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY pos) AS seg
       FROM tl),
par AS (SELECT {keys}, seg, string_agg(tr, ' ' ORDER BY pos) AS p FROM sg WHERE tr <> '' GROUP BY {keys}, seg)"""


def segments(src: str, keys: str) -> str:
    return SEGMENTS.format(src=src, keys=keys, struct=STRUCT, clean=CLEAN.format(c="line"), trim=trim("c"))


HEADED = r"""
hl AS (SELECT *, regexp_matches(line, '^#{1,5}\s') AS h FROM doc_lines),
ch AS (SELECT *, cast(sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS bigint) AS chunk_no FROM hl)"""

HEADS = rf"""
heads AS (SELECT doc_id, chunk_no, length(regexp_extract(line, '^(#{{1,5}})\s', 1)) AS level,
                 {trim("regexp_replace(line, '^#+', '')")} AS title FROM ch WHERE h)"""

CHUNKS_SQL = f"""
SELECT h.doc_id, h.chunk_no, coalesce(nullif({trim(CLEAN.format(c='title'))}, ''), title) AS section,
       cast(level AS integer) AS level, cast(count(p) AS integer) AS paragraphs,
       md5(string_agg(p, chr(10) ORDER BY seg)) AS digest
FROM heads h JOIN par ON par.doc_id = h.doc_id AND par.chunk_no = h.chunk_no
GROUP BY h.doc_id, h.chunk_no, title, level"""

ARTICLES = rf"""
hl AS (SELECT *, regexp_matches(line, '^(#+\s+)?(\*\*|__)?(Article|Chapter|Section)[\s\x{{00A0}}]+\d+') AS h
       FROM doc_lines),
ch AS (SELECT *, cast(sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS bigint) AS chunk_no FROM hl),
art AS (SELECT doc_id, chunk_no, {trim("max(line) FILTER (WHERE h)")} AS header,
               {trim("coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT h), '')")} AS body
        FROM ch GROUP BY doc_id, chunk_no)"""


def _headers(s, d):
    return t.chunk_by_headers(v.documents_with(s, d, "headers"), "text")


def _articles(s, d):
    return t.chunk_by_articles(v.documents_with(s, d, "articles"), "text")


def _header_rows(s, d):
    rows = t.explode_fragments(_headers(s, d), ["doc_id"])
    return rows.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "section", "level",
                       F.size("text").alias("paragraphs"), F.md5(F.array_join("text", "\n")).alias("digest"))


def _article_rows(s, d):
    rows = t.explode_fragments(_articles(s, d), ["doc_id"])
    return rows.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "section", "article_id",
                       "type", F.md5("text").alias("digest"))


def _paragraphs(s, d):
    out = spread(v.table(s, d, "documents")).withColumn("p", t.clean_paragraphs("text"))
    return out.select("doc_id", F.size("p").alias("paragraphs"), F.md5(F.array_join("p", "\n")).alias("digest"))


def _markdown(s, d):
    """Pages as both ingestion paths read them: the text of unwrapped tags stays."""
    out = t.html_to_markdown(spread(v.table(s, d, "pages")), "html", (), unwrap_tags=t.GUIDE_UNWRAP)
    out = t.html_to_markdown(out, "html", (), unwrap_tags=t.LEGAL_UNWRAP, name="legal")
    return out.select("page_id", F.md5("markdown").alias("digest"), F.length("markdown").alias("chars"),
                      F.md5("legal").alias("legal_digest"), F.length("legal").alias("legal_chars"))


def _facts(s, d):
    """What must survive of each page: headings, links with their targets, list items, all letters of the text."""
    out = t.html_to_markdown(spread(v.table(s, d, "pages")), "html", (), unwrap_tags=t.GUIDE_UNWRAP)
    count = lambda p: F.size(F.regexp_extract_all("markdown", F.lit(p), F.lit(0))).cast("long")
    return out.select("page_id", count(r"(?m)^#{1,6} ").alias("headings"), count(r"\]\(").alias("links"), count(r"(?m)^[*+-] ").alias("items"),
                      F.length(F.regexp_replace("markdown", r"[^\p{L}]", "")).cast("long").alias("letters"))


def _guides(s, d):
    """All fragments of the pages with a code block appended, through protection and sections."""
    p = spread(v.table(s, d, "pages")).withColumn("html", F.concat(
        "html", F.lit("<h2>Example</h2><pre>select\n  "), F.col("page_id").cast("string"), F.lit("</pre>")))
    md = t.html_to_markdown(p, "html", (), protect_pre=True, unwrap_tags=t.GUIDE_UNWRAP)
    return t.explode_fragments(t.chunk_by_headers(md, "markdown", codes="codes"), ["page_id"])


def _guide_rows(s, d):
    return _guides(s, d).select("page_id", F.col("chunk_no").cast("long").alias("chunk_no"), "section", "level",
                                F.size("text").alias("paragraphs"), F.md5(F.array_join("text", "\n")).alias("digest"))


def _examples(s, d):
    """All fragments that hold code, which in these pages are the appended blocks; ``_guide_rows`` has all fragments."""
    return _guides(s, d).where(F.exists("text", lambda p: p.startswith("```"))).select("page_id", "section", "level",
                                                             F.array_join("text", "|").alias("body"))


def _registry(s, d):
    return v.table(s, d, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("slug"))


def _ingested(s, d):
    """All documents are registered; the smaller table of pages has content for some of them."""
    pages = v.table(s, d, "pages").select(
        F.concat(F.lit("DOC-"), F.col("page_id").cast("string")).alias("slug"), "html")
    return t.ingest_all(_registry(s, d), pages)


def _exported(s, d):
    """Nested documents through JSON files and back."""
    path = v.scratch(s, "fragments")
    docs = t.fragment_documents(_articles(s, d), ["doc_id", "source"])
    sinks.write_fragments(docs, path)
    return s.read.schema(docs.schema).json(path)


def _export_rows(s, d):
    """Every exported fragment with its digest."""
    back = _exported(s, d).select("metadata.*", "fragments")
    rows = t.explode_fragments(back, ["doc_id", "source", "chunk_count"])
    return rows.select("doc_id", "source", "chunk_count", F.col("chunk_no").cast("long").alias("chunk_no"), "section",
                       "article_id", "type", F.md5("text").alias("digest"))


def _export(s, d):
    """Each document with one digest over all its fragments in order; ``_export_rows`` has them one by one."""
    whole = F.array_join(F.transform("fragments", lambda x: F.md5(x["text"])), ",")
    return _exported(s, d).select(F.col("metadata.doc_id").alias("doc_id"), F.col("metadata.source").alias("source"),
                       F.col("metadata.chunk_count").alias("chunk_count"), F.md5(whole).alias("digest"))


ENTRIES = [
    Entry("t1_html_to_markdown", _markdown),
    Entry("t1_markdown_facts", _facts,
          r"""SELECT page_id, len(regexp_extract_all(html, '<h[1-6]>')) AS headings, len(regexp_extract_all(html, '<a href="')) AS links,
              len(regexp_extract_all(html, '<li>')) AS items,
              length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(html, '"</p>"', '"p"'), '&[a-z]+;', '', 'g'), '<a href="([^"]*)">', '\1', 'g'), '<[^>]*>', '', 'g'), '[^\p{L}]', '', 'g')) AS letters
              FROM pages""".replace(chr(92) * 2, chr(92))),
    Entry("t2_guide_fragments", _guide_rows),
    Entry("t2_protected_code", _examples,
          """SELECT page_id, 'Example' AS section, 2 AS level,
             '## Example|' || '```' || chr(10) || 'select' || chr(10) || '  ' || page_id || chr(10) || '```' AS body
             FROM pages"""),
    Entry("t3_chunk_by_articles", _article_rows,
          oracle(r"""SELECT doc_id, chunk_no, header AS section, regexp_extract(header, 'Article\s+(\d+\w?)', 1) AS article_id,
                    'article' AS type, md5(header || chr(10) || chr(10) || body) AS digest FROM art""",
                 v.ARTICLE_LINES, ARTICLES)),
    Entry("t4_chunk_by_headers", _header_rows,
          oracle(CHUNKS_SQL, v.HEADER_LINES, HEADED, HEADS, segments("ch", "doc_id, chunk_no"))),
    Entry("t5_clean_paragraphs", _paragraphs,
          oracle("""SELECT d.doc_id, cast(count(p) AS integer) AS paragraphs,
                      coalesce(md5(string_agg(p, chr(10) ORDER BY seg)), md5('')) AS digest
                    FROM documents d LEFT JOIN par ON par.doc_id = d.doc_id GROUP BY d.doc_id""",
                 v._LINES.format(mark="raw"), segments("doc_lines", "doc_id"))),
    Entry("t6_chunk_stats", lambda s, d: t.chunk_stats(_headers(s, d), ["doc_id"]),
          oracle("SELECT doc_id, cast(max(chunk_no) + 1 AS integer) AS chunk_count FROM ch GROUP BY doc_id",
                 v.HEADER_LINES, HEADED)),
    Entry("t7_validate_markup", lambda s, d: t.validate_markup(
              v.table(s, d, "pages").withColumn("html", F.when(F.col("html").contains('lang="fr"'), F.regexp_replace(
                  "html", "<html ", f'<html xmlns="{t.XHTML}" ')).otherwise(F.col("html"))), "html").select("page_id", "valid_markup"),
          """SELECT page_id, contains(html, 'lang="fr"') AS valid_markup FROM pages"""),
    Entry("t8_outline", lambda s, d: t.outline(v.documents_with(s, d, "headers"), "text", ["doc_id"]),
          oracle("SELECT doc_id, cast(chunk_no AS integer) AS heading_no, cast(level AS integer) AS level, title FROM heads",
                 v.HEADER_LINES, HEADED, HEADS)),
    Entry("t9_ingest_all", lambda s, d: _ingested(s, d).select("slug", F.length("html").alias("chars"), "status"),
          """SELECT 'doc-' || l.doc_id AS slug, cast(length(html) AS integer) AS chars,
             CASE WHEN html IS NULL THEN 'FAILED' ELSE 'OK' END AS status
             FROM documents l LEFT JOIN pages p ON l.doc_id = p.page_id"""),
    Entry("t9_ingest_summary", lambda s, d: t.ingest_summary(_ingested(s, d)),
          """SELECT count(*) AS documents, count(*) FILTER (WHERE html IS NULL) AS failures, 1 AS exit_status
             FROM documents l LEFT JOIN pages p ON l.doc_id = p.page_id"""),
    Entry("t11_classify_artifacts", lambda s, d: t.classify_artifacts(v.artifacts(s, d)).select("path", "department", "signable"),
          oracle("""SELECT path, CASE WHEN path LIKE '%.safetensors' OR path LIKE '%.pt' THEN 'model'
                      WHEN path LIKE '%.parquet' THEN 'data' WHEN path LIKE '%.log' THEN 'logs'
                      WHEN path LIKE '%.sig' OR path LIKE '%.cert' THEN 'security' ELSE 'unclassified' END AS department,
                    regexp_extract(path, '\\.[^.]+$') IN ('.pt', '.ckpt', '.parquet', '.csv', '.safetensors', '.json')
                      AS signable FROM artifacts""", v.ARTIFACTS)),
    Entry("t11_route_inputs", lambda s, d: t.route_inputs(v.artifacts(s, d), data_suffix=".parquet").groupBy("kind")
          .agg(F.count(F.lit(1)).alias("files")),
          oracle("""SELECT CASE WHEN path LIKE '%.parquet' THEN 'telemetry' ELSE 'resources' END AS kind, count(*) AS files
                    FROM artifacts GROUP BY 1""", v.ARTIFACTS)),
    Entry("k8_fragment_export", _export,
          oracle("""SELECT a.doc_id, max(source) AS source, cast(count(*) AS integer) AS chunk_count,
                      md5(string_agg(md5(header || chr(10) || chr(10) || body), ',' ORDER BY chunk_no)) AS digest
                    FROM art a JOIN documents d ON d.doc_id = a.doc_id GROUP BY a.doc_id""", v.ARTICLE_LINES, ARTICLES)),
    Entry("k8_fragment_rows", _export_rows,
          oracle(r"""SELECT a.doc_id, source, cast(n AS integer) AS chunk_count, a.chunk_no, header AS section,
                      regexp_extract(header, 'Article\s+(\d+\w?)', 1) AS article_id, 'article' AS type,
                      md5(header || chr(10) || chr(10) || body) AS digest
                    FROM art a JOIN (SELECT doc_id, max(chunk_no) + 1 AS n FROM ch GROUP BY doc_id) c ON a.doc_id = c.doc_id
                    JOIN documents d ON d.doc_id = a.doc_id""", v.ARTICLE_LINES, ARTICLES)),
]
