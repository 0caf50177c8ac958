import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

#: Columns whose names operators use inside.
CLASHING = ["id", "k1", "k2", "node", "words", "size", "at", "ids", "start", "length", "shard", "n", "key", "spans", "kept"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, clash=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHING]) if clash else df
    return make


def vocabulary(n, seed=0):
    import random
    rng = random.Random(seed)
    return ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def prose(n, rng, words):
    out = [rng.choice(words) for _ in range(n)]
    return " ".join(w + rng.choice(["", "", "", ",", ".\n"]) for w in out)


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, blanks, repeated rows and a long text."""
    import random
    rng = random.Random(5)
    words = vocabulary(600)
    base = [prose(rng.randint(5, 200), rng, words) for _ in range(60)]
    passage = prose(60, rng, words)
    rows = list(enumerate(base))
    for i in range(60, 90):  # near copies
        w = base[i % 7].split(" ")
        for _ in range(rng.randint(0, max(1, len(w) // 12))):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(i, base[3]) for i in range(90, 120)]  # exact copies
    rows += [(i, base[i % 60][:80] + " " + passage + "\n" + prose(30, rng, words)) for i in range(120, 140)]
    rows += [(140, None), (141, ""), (142, " \n\t"), (143, "one"), (144, "one"), (145, "for " * 400), (146, prose(9000, rng, words)),
             (146, rows[-1][1]), (3, base[3]), (3, base[3]), (None, base[4]), (None, None), (147, "Été à l’école ça — naïve mots " * 20)]
    return rows
