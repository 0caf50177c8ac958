"""Document operators on hand-written pages."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from vanewright.operators import text as t


def one(spark, text):
    return spark.createDataFrame([(1, text)], "id int, text string")


def fragments(df):
    return [r.asDict(recursive=True) for r in df.first()["fragments"]]


def test_articles(spark):
    text = ("Whereas this\n\n## Article 1\nScope here\n\n**Section\u00a02 Terms**\nbody\n"
            "Article 12a Last\nThe Article 9 inside stays\nChapter IV no digits\n")
    got = fragments(t.chunk_by_articles(one(spark, text), "text"))
    assert [(g["section"], g["article_id"], g["type"]) for g in got] == [
        ("Preamble/Recitals", None, "intro"), ("Article 1", "1", "article"),
        ("**Section\u00a02 Terms**", "**Section\u00a02 Terms**", "article"), ("Article 12a Last", "12a", "article")]
    assert got[1]["text"] == "## Article 1\n\nScope here"
    assert got[3]["text"] == "Article 12a Last\n\nThe Article 9 inside stays\nChapter IV no digits"


def test_articles_without_preamble_or_content(spark):
    got = fragments(t.chunk_by_articles(one(spark, "\n \nArticle 3"), "text"))
    assert [(g["article_id"], g["text"]) for g in got] == [("3", "Article 3\n\n")]


def test_headers(spark):
    text = ("intro line\ncontinued\n\n# Top [x](#y)\nText a\ntext b\n\n###### deep\nmore\n##NoSpace\n"
            "## Lists\n* one\n  two\n1. first\n4. not a start\nYes: label\n### \n")
    got = fragments(t.chunk_by_headers(one(spark, text), "text"))
    assert [(g["section"], g["level"]) for g in got] == [
        ("Introduction", 0), ("Top x", 1), ("Lists", 2), ("", 3)]
    assert got[0]["text"] == ["intro line continued"]
    assert got[1]["text"] == ["# Top x Text a text b", "###### deep more ##NoSpace"]
    assert got[2]["text"] == ["## Lists", "* one two", "1. first 4. not a start", "Yes: label"]
    assert got[3]["text"] == ["###"]


def test_windows_line_ends_and_blank_document(spark):
    got = fragments(t.chunk_by_headers(one(spark, "a\r\nb\r\n\r\n# H\r\nc"), "text"))
    assert [g["text"] for g in got] == [["a b"], ["# H c"]]
    assert fragments(t.chunk_by_headers(one(spark, " \n\n "), "text")) == []


def test_clean_paragraphs(spark):
    text = 'x {"@context":"s","a":{"b":1}} y\n \nz\n\n\nCODETOKEN0BLOCK note\nafter\n> quote'
    row = one(spark, text).select(t.clean_paragraphs("text", True).alias("on"), t.clean_paragraphs("text").alias("off")).first()
    assert row["on"] == ["x  y z", "CODETOKEN0BLOCK note", "after", "> quote"]
    assert row["off"] == ["x  y z", "CODETOKEN0BLOCK note after", "> quote"]


PAGE = ("<html><head><title>T</title><style>p{}</style><script>var a='<p>';</script></head><body><nav>menu</nav>"
        "<h1>Head &amp; tail</h1><p>One <b>bold</b> and\n <i>it</i> <a href='/u'>link</a><br>next</p>"
        "<ul><li>a</li><li>b<ol><li>c</li></ol></li></ul>"
        "<h2>Code</h2><p>before</p><pre>if x:\n    y &lt; 1</pre><p>after</p><footer>f</footer></body></html>")


def test_markdown(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None)], "id int, html string")
    got = {r["id"]: r["markdown"] for r in
           t.html_to_markdown(df, "html", ("script", "style", "nav", "footer", "title")).collect()}
    assert got[2] is None
    assert "# Head & tail\n\nOne **bold** and *it* [link](/u)\nnext" in got[1]
    assert "* a\n* b" in got[1] and "  1. c" in got[1]
    assert "```\nif x:\n    y < 1\n```" in got[1]
    assert "menu" not in got[1] and "var a" not in got[1]


def test_protected_code_comes_back(spark):
    df = spark.createDataFrame([(1, PAGE)], "id int, html string")
    md = t.html_to_markdown(df, "html", ("script", "style", "nav", "footer"), protect_pre=True)
    row = md.first()
    assert row["codes"] == {"CODETOKEN0BLOCK": "if x:\n    y < 1"} and "CODETOKEN0BLOCK" in row["markdown"]
    got = fragments(t.chunk_by_headers(md, "markdown", codes="codes"))
    code = [g for g in got if g["section"] == "Code"][0]
    assert code["text"] == ["## Code", "before", "```\nif x:\n    y < 1\n```", "after"]


def test_documents_are_not_shuffled(spark):
    df = t.chunk_by_headers(one(spark, "# a\nb").repartition(2), "text")
    plan = t.explode_fragments(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1      # only the repartition above


def test_classification_order(spark):
    paths = ["a/provenance.json", "a/provenance.json.sig", "m.safetensors", "x.parquet", "w.lmdb", "events.out.tfevents.1",
             "run.hparams.yaml", "c.cert", "d.bin"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [(r["department"], r["signable"]) for r in t.classify_artifacts(df).collect()]
    assert [g[0] for g in got] == ["security", "security", "model", "data", "data", "logs", "metadata",
                                   "security", "unclassified"]
    assert got[0][1] and got[2][1] and not got[7][1]


def test_outline_and_counts(spark):
    df = one(spark, "# A\n## B \ntext\n###### no\n")
    assert [tuple(r) for r in t.outline(df, "text", ["id"]).collect()] == [(1, 0, 1, "A"), (1, 1, 2, "B")]
    made = t.chunk_by_headers(df, "text")
    assert t.chunk_stats(made, ["id"]).first()["chunk_count"] == 2
    doc = t.fragment_documents(made, ["id"]).select(F.col("metadata.chunk_count")).first()
    assert doc[0] == 2


def test_whole_pages_are_checked(spark, tmp_path):
    """All fragments of a page and of an export, and the text of unwrapped tags, reach the results."""
    from vanewright.catalog.texts import ENTRIES

    run = {e.key: e.run for e in ENTRIES}
    page = ("<head><title>T</title><script>var a;</script></head><body><nav>menu</nav><h1>One</h1><p>text <img src=a alt=b></p>"
            "<h2>Two</h2><p>more</p><footer>end</footer></body>")
    spark.createDataFrame([(7, page)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    docs = [(1, "a\nb\nc\nd\ne", "s"), (2, "x", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")

    def md5(x):
        return hashlib.md5(x.encode()).hexdigest()

    row = run["t1_html_to_markdown"](spark, str(tmp_path)).first()
    found = t.html_to_markdown(spark.createDataFrame([(page,)], "html string"), "html", (), unwrap_tags=t.GUIDE_UNWRAP).first()["markdown"]
    assert all(x in found for x in ("var a;", "menu", "![b](a)", "end"))
    assert row["digest"] == md5(found) and row["chars"] == len(found)
    assert row["legal_chars"] < row["chars"]  # without the image alone
    got = sorted((r["chunk_no"], r["section"], r["level"]) for r in run["t2_guide_fragments"](spark, str(tmp_path)).collect())
    assert got == [(0, "Introduction", 0), (1, "One", 1), (2, "Two", 2), (3, "Example", 2)]
    got = sorted((r["doc_id"], r["chunk_no"], r["chunk_count"], r["digest"]) for r in run["k8_fragment_rows"](spark, str(tmp_path)).collect())
    assert got == [(1, 0, 2, md5("Article 0 a\n\nb\nc")), (1, 1, 2, md5("Article 3 d\n\ne")), (2, 0, 1, md5("Article 0 x\n\n"))]


def test_pages_reach_python_in_batches_of_bounded_size(spark):
    pages = spark.range(3000, numPartitions=1).select("id", F.when(F.col("id") % 7 != 0, F.concat(
        F.lit("<h1>"), F.col("id").cast("string"), F.lit("</h1><p>"), F.repeat(F.lit("word "), 2000))).alias("html"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.get_total_buffer_size()]})
    assert max(r["bytes"] for r in pages.mapInArrow(sizes, "bytes long").collect()) < 20 << 20
    got = t.html_to_markdown(pages, "html").select("id", F.substring_index("markdown", "\n", 1).alias("head")).collect()
    assert sorted((r["id"], r["head"]) for r in got) == [(i, f"# {i}" if i % 7 else None) for i in range(3000)]
