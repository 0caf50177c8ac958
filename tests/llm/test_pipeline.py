"""The pipeline's stages against brute force, and every query of the subpackage."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from check_oracle import compare, connect
from tests.llm.test_pairs import roots, shingles
from tests.llm.test_rows import brute_secrets
from vanewright.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("key", list(queries.SQL))
def test_query_equals_its_sql(spark, key):
    problems, n = compare(queries.QUERIES[key](spark, SF), connect(SF), queries.SQL[key])
    assert not problems and n


def test_op1_over_the_table(spark, texts):
    """Every id of the library lies in one piece, pieces fill sequences without gaps, and little is padded."""
    coder = Tokenizer.from_file(queries.TOKENIZER)
    want = {d: [*coder.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}
    placed, rows = defaultdict(list), queries.op1_harmonic_packing(spark, SF).collect()
    seen = defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]].append((r["start"], r["length"]))
    for parts in [*placed.values(), *seen.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
    assert all(sum(n for _, n in p) <= 2048 for p in placed.values())
    assert {d: sum(n for _, n in p) for d, p in seen.items()} == {d: len(x) for d, x in want.items()}
    assert 2048 * len(placed) <= 1.03 * sum(map(len, want.values())) + 2048


def test_op4_over_the_table(spark, texts):
    sets = {d: shingles(t, 2) for d, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    of = roots(ids, links)
    assert links and {tuple(r) for r in queries.op4_minhash_near_dedup(spark, SF).collect()} == {(d, len(sets[d]), of[d], d == of[d]) for d in ids}


def test_op7_over_the_table(spark, texts):
    rows = queries.op7_vector_sharding(spark, SF).collect()
    load = Counter()
    slots = defaultdict(list)
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 1, zlib.crc32(body), "bytes", None)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and set(load) == set(range(8))
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op9_over_the_table(spark, texts):
    words = {d: WORD.findall(t or "") for d, t in texts.items()}
    starts = Counter(tuple(w[i:i + 35]) for w in words.values() for i in range(len(w) - 34))
    want = set()
    for d, w in words.items():
        gone = {i + j for i in range(len(w) - 34) if starts[tuple(w[i:i + 35])] > 1 for j in range(35)}
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.add((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    assert {tuple(r) for r in queries.op9_substring_dedup(spark, SF).collect()} == want and any(x[2] for x in want)


def test_op8_and_op10_over_the_table(spark, texts):
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet' where toxic is not null").fetchall())
    rows = {r["doc_id"]: r for r in queries.op8_toxicity(spark, SF).collect()}
    assert rows.keys() == texts.keys()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
               for d, r in rows.items())
    held = [d for d in toxic if rows[d]["held_out"]]
    assert sum(rows[d]["predicted"] == toxic[d] for d in held) >= 0.9 * len(held)
    found = {r["doc_id"]: r for r in queries.op10_secret_scan(spark, SF).collect()}
    for d, t in texts.items():
        base = brute_secrets(t)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in base)
        assert found[d]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and found[d]["n_hex"] == sum(x[2] == "hex" for x in base)
        assert set(filter(None, listed.split(","))) <= set(found[d]["spans"].split(","))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    ids = {n: {r["doc_id"] for r in rows} for n, rows in kept.items()}
    assert ids["packing"] == ids["secrets"] == ids["decontamination"] <= ids["near_dedup"] <= ids["toxicity"]
    # No two that stay are near duplicates; each that goes is near one that was there.
    def sets(rows):
        out = {}
        for r in rows:
            w = WORD.findall(r["text"].lower())
            out[r["doc_id"]] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
        return out
    before = sets(kept["toxicity"])
    near = lambda a, b: 100 * len(before[a] & before[b]) >= 80 * len(before[a] | before[b])
    stay = sorted(ids["near_dedup"])
    assert not any(near(a, b) for i, a in enumerate(stay) for b in stay[:i])
    assert all(any(near(a, b) for b in before if b != a) for a in ids["toxicity"] - ids["near_dedup"])
    for r in kept["secrets"]:
        assert not re.search(r"(?i)token\s*=\s*\"[0-9a-f]{40}", r["text"])
        assert r["n_chars"] == len(r["text"])
    # run() does the same.
    assert corpus_pipeline.run(spark, SF).count() == len(kept["packing"])


def test_stages_take_odd_rows(spark, docs_of, tmp_path):
    docs = docs_of([(1, None), (None, "a b c"), (2, ""), (3, "same text here of five words"), (3, "same text here of five words"),
                    (4, "Same text here of five words")], clash=True)
    docs = docs.unionByName(docs_of([(5, "word " * 60_000), (6, "x" * 200_000)], clash=True))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        kept, docs = docs, spark.read.parquet(str(tmp_path / name))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 6]
    tokens = {r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    coder = Tokenizer.from_file(queries.TOKENIZER)
    assert tokens == {r["doc_id"]: len(coder.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in kept.collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_of([]), SF).count() == 0


def test_pipeline_returns_token_ids(spark, docs_of):
    """The pieces of the last stage hold the ids of their documents, and sequences can be put together from them."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from vanewright.llm.packing import sequences

    texts = {1: "some words " * 1500, 2: "one", 3: None}
    placed = corpus_pipeline.packing_stage(spark, docs_of(list(texts.items())), SF)
    coder, got = Tokenizer.from_file(queries.TOKENIZER), {}
    for r in sorted(placed.collect(), key=lambda r: (r["doc_id"], r["start"])):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], np.uint32).tolist())
    assert got == {d: [*coder.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}
    assert sum(len(r["ids"]) for r in sequences(placed).collect()) == 4 * sum(map(len, got.values()))
