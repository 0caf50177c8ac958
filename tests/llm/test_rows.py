"""Packing, line frequency, licences, URL lists, sharding, toxicity and secrets against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanewright.llm import licenses, secrets, sharding, toxicity, url_filter
from vanewright.llm.line_quality import LineRules, line_quality, without_lines
from vanewright.llm.packing import Coder, Packing, harmonic, sequences, token_pieces
from vanewright.llm.queries import TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(TOKENIZER)
    out.encode_special_tokens = True
    return lambda t: out.encode(t or "", add_special_tokens=False).ids


ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\na", "a\n", "x\u00a0 y", "a\u3000 b", "don't  we'll", "a" * 3000, "<|endoftext|> hi",
       " \t\n", "a \x1c b", "é è  ç", "a.b, c!d\ne f", "été à l’école. Ça", "日本 語", "x.\n\ny", "one.\ntwo three.\n four"]


def test_coder_equals_the_library(tokenizer, corpus):
    import pyarrow as pa
    from pathlib import Path
    from vanewright.llm.textscan import pieces

    coder = Coder(Path(TOKENIZER).read_text())
    texts = ODD + [t or "" for _, t in corpus]
    for _ in range(2):  # the second time from memory
        got = []
        for _, _, data, off in pieces(pa.array(texts), 700):
            ids, begin = coder.encode(data, off, 1)
            got += [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])]
        assert got == [[*tokenizer(t), 1] for t in texts]


def test_special_token_in_a_text_is_that_token(docs_of):
    from tokenizers import Tokenizer

    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark}", f"word.{mark}\nnext  {mark}  end, {mark}.", f"x\n{mark}\ny {mark}z {mark} ", f"é{mark}\u3000 {mark}",
             " ".join(["some", mark, "words"] * 300), "<|endof text|> <|endoftext"]
    coder = Tokenizer.from_file(TOKENIZER)
    want = {i: [*coder.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 1]
    got = defaultdict(list)
    for r in sorted(token_pieces(docs_of(list(enumerate(texts))), TOKENIZER).collect(), key=lambda r: (r["doc_id"], r["start"])):
        got[r["doc_id"]] += np.frombuffer(r["ids"], np.uint32).tolist()
    assert got == want


@pytest.mark.parametrize("worker_rows", [4096, 7])
def test_packing(spark, docs_of, corpus, tokenizer, worker_rows):
    cfg = Packing(capacity=256, waste=4, worker_rows=worker_rows)
    assert all(sum(cfg.cut(n)) == n and max(cfg.cut(n), default=0) <= 256 for n in range(1500))
    placed = harmonic(token_pieces(docs_of(corpus, True), TOKENIZER, cfg), cfg)
    rows = placed.collect()
    want = Counter((d, tuple([*tokenizer(t), 1])) for d, t in corpus)
    by = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        by[r["doc_id"], r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], np.uint32).tolist()))
    tokens = Counter()
    for (d, ids), n in want.items():
        tokens[d, len(ids)] += n
    assert {k: sum(len(x) for _, x in v) for k, v in by.items()} == {k: k[1] * n for k, n in tokens.items()}
    for (d, ids), n in want.items():
        for s, x in by[d, len(ids)]:
            assert tuple(x) == ids[s:s + len(x)] or sum(k == (d, len(ids)) for k in tokens) == 1
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    total = sum(r["length"] for r in rows)
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert 256 * len(held) <= 1.06 * total + 256
    whole = sequences(placed).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole) and sum(r["n_tokens"] for r in whole) == total


def test_packing_of_nothing(docs_of):
    assert harmonic(token_pieces(docs_of([]), TOKENIZER)).count() == 0


def brute_lines(rows, cfg):
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")
    lines = lambda t: [x for x in (t or "").split("\n") if WORD.search(x)]
    texts = {(s or "", t or "") for _, t, s in rows}
    of, held = Counter(s for s, _ in texts), Counter((s, x) for s, t in texts for x in {norm(x) for x in lines(t)})
    out = Counter()
    for d, t, s in rows:
        w, s = WORD.findall(t or ""), s or ""
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cover = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
        gone = [x for x in lines(t) if held[s, norm(x)] > max(cfg.min_docs, cfg.share * of[s])]
        left = len(w) - sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        out[d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines(t)) - len(set(lines(t))), len(cover),
            failed, not failed and left >= 10 and left >= 0.5 * len(w), len(gone), left] += 1
    return out


def test_line_quality(docs_of, corpus):
    rng = random.Random(4)
    common = "All pages of this site share this line"
    rows = [(d, t, rng.choice(["a", "b", None, ""])) for d, t in corpus]
    rows += [(500 + i, f"{common}\n{' '.join(WORD.findall(corpus[i][1])[:30])}\n{common.upper()} ", "c") for i in range(25)]
    rows += [(600 + i, f"{common}\n{common}\n  {common} \nx{i} y z", "c") for i in range(8)]
    cfg = LineRules(min_docs=4, share=0.1)
    got = line_quality(docs_of(rows, True), cfg)
    assert Counter(tuple(r)[:-1] for r in got.collect()) == brute_lines(rows, cfg)
    cut = docs_of([(1, f"{common}\nown\n\n{common} \nlast")]).withColumn("gone", F.array(F.xxhash64(F.lit(common.lower()))))
    assert cut.select(without_lines("text", "gone")).first()[0] == "own\n\nlast"
    assert line_quality(docs_of([])).count() == 0


def test_licenses(spark, docs_of):
    known = licenses.known_licenses(spark)
    rows = [(1, "Released under the MIT Licence"), (2, "licensed under  the MIT LICENSE!\n(c) 2020 Some One\n"), (3, None), (4, ""),
            (5, "Some prose.\nLicensed under the Apache License, v2.0\nAll rights reserved"), (5, "Some prose"), (None, "mit"),
            (6, "x " * 20000 + "\nThis software is licensed under GNU General Public Licence version 3")]
    got = {(r["doc_id"], r["license"], tuple(r["line_licenses"])) for r in licenses.scan_licenses(docs_of(rows, True), known).collect()}
    assert got == {(1, "MIT", ("MIT",)), (2, "MIT", ("MIT",)), (3, None, ()), (4, None, ()), (5, None, ("Apache-2.0", "Proprietary")),
                   (5, None, ()), (None, None, ()), (6, None, ("GPL-3.0",))}
    assert licenses.scan_licenses(docs_of([]), known).count() == 0


@pytest.mark.parametrize("most", [10_000, 3])
def test_whole_licences_and_copyright_lines(spark, docs_of, monkeypatch, most):
    """Also with more known licences than are sent to every task."""
    monkeypatch.setattr(licenses, "MOST_KNOWN", most)
    mit = "MIT License\n\nCopyright (c) 2021 J. Smith Inc.\n\n" + dict(licenses.TEXTS[:1])["MIT"].replace("\n", " \n ")
    notices = spark.createDataFrame([*licenses.LICENSES, ("House-1", "You may keep this for a day."), ("House-1", "Nur zur Ansicht"), (None, "x"), ("E", "")],
                                    "license string, notice string")
    known = licenses.known_licenses(spark, notices)
    rows = [(1, mit), (2, "Copyright 2020 X. All rights reserved."), (3, "a\n(C) 2019 Someone, Licensed under CC BY-NC 4.0\nb"),
            (4, "Copyright 2020 J. Smith"), (5, "nur  zur\nAnsicht!"), (6, "first\nNur zur Ansicht\nYou may keep this for a day.\nNur zur Ansicht."),
            (7, None), (None, ""), (6, "first\nNur zur Ansicht\nYou may keep this for a day.\nNur zur Ansicht."), (8, "the the Version version\n\nv2")]
    got = Counter((r["doc_id"], r["license"], tuple(r["line_licenses"])) for r in licenses.scan_licenses(docs_of(rows, True), known).collect())
    assert got == Counter([(1, "MIT", ()), (2, "Proprietary", ("Proprietary",)), (3, None, ("CC-BY-NC-4.0",)), (4, None, ()), (5, "House-1", ()),
                           (6, None, ("House-1",)), (6, None, ("House-1",)), (7, None, ()), (None, None, ()), (8, None, ())])
    assert licenses.scan_licenses(docs_of(rows), known.limit(0)).where("license is not null or size(line_licenses) > 0").count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?utm_a=1", "http://example.net/en", "http://b.org/fr/", "http://org/fr/x",
            "http://example.com/de/a#b", "http://xexample.com/de/a", "http://www.ok.io/a/?b=2&a=1&ref=z", "https://ok.io/a?a=1&b=2#f", "x://ok.io",
            "http://ok.io/c", "http://ok.io/" + "p" * 50_000] + [f"http://ok.io/{i % 40}" for i in range(200)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://ok.io/1", "h")], "page_id long, url string, canonical string")
    listed = ["http://ok.io/a?a=1&b=2", "http://www.ok.io/7/", None, "nothing", "http://ok.io/7", "http://example.net/en/x"]
    table = spark.createDataFrame([(u,) for u in listed], "url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, table).collect()}
    assert len(got) == len(urls) + 1
    verdict = lambda i: (got[i]["host"], got[i]["rule"], got[i]["verdict"])
    assert [verdict(i) for i in range(4)] == [("", None, "allow")] * 4
    assert verdict(4) == ("a.example.net", "example.net/en/", "allow")
    assert verdict(5) == ("example.net", "net/", "block")
    assert verdict(6)[1:] == verdict(7)[1:] == ("org/fr/", "allow")
    assert verdict(8)[1:] == ("example.com/de/", "block") and verdict(9)[1:] == (None, "allow")
    assert [verdict(i)[2] for i in (10, 11, 12, 13, 14)] == ["block", "block", "allow", "allow", "allow"]
    assert all((got[15 + i]["verdict"] == "block") == (i % 40 == 7) for i in range(200))
    assert url_filter.judge_urls(pages, table.limit(0)).where("verdict = 'block' and rule is null").count() == 0
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(5000).select(F.concat(F.lit("a/"), "id").alias("canonical"))
    blocks = 5000 * 16 // 256
    asked = spark.range(20000).select(F.concat(F.lit("a/"), "id").alias("canonical"), "id")
    bits = url_filter._bits(F.col("canonical"))
    hit = asked.withColumn("block", url_filter._block(F.col("canonical"), blocks)).join(url_filter.bloom(listed, blocks), "block")
    for i in range(8):
        hit = hit.where(F.col(f"w{i}").bitwiseAND(bits[i]) != 0)
    ids = [r["id"] for r in hit.select("id").collect()]
    assert sum(i < 5000 for i in ids) == 5000 and sum(i >= 5000 for i in ids) < 0.02 * 15000


def test_sharding(docs_of, corpus):
    rng = random.Random(6)
    rows = corpus + [(1000 + i, "same text") for i in range(300)] + [(2000 + i, "t" * rng.randint(1, 90)) for i in range(400)]
    got = sharding.shard(docs_of(rows, True)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, groups = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    n = Counter((r["text_crc32"], r["size"]) for r in got)
    assert all(len(s) == 1 for k, s in groups.items() if n[k] <= len(rows) / 8 and n[k] * k[1] <= sum(r["size"] for r in got) / 8)
    assert len(groups[zlib.crc32(b"same text"), 10]) > 1  # a third of all rows
    assert sharding.shard(docs_of([])).count() == 0
    assert sharding.shard(docs_of([(1, None), (1, None)])).count() == 2


def test_repeated_rows_are_divided(docs_of, monkeypatch):
    """A row that is a third of all rows and bytes fits no shard and no cell."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 100)
    rng = random.Random(7)
    size = {i: rng.randint(1, 90) for i in range(2000)}
    rows = [(i, "t" * (n - 1) + str(i)) for i, n in size.items()]
    rows += [(None, "same text of a row that is repeated over and over")] * 500 + [(5000, "same text of a row that is repeated over and over")] * 500
    got = sharding.shard(docs_of(rows))
    load, taken = Counter(), defaultdict(list)
    for r in got.collect():
        load[r["shard"]] += r["size"]
        taken[r["shard"]].append(r["slot"])
    assert len(load) == 8 and max(load.values()) < 1.01 * sum(load.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in taken.values())


def test_identical_pieces_are_dealt_to_all_workers(spark):
    cfg = Packing(capacity=64, waste=0, worker_rows=32)
    pieces = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS doc_id", "0L AS start", "64L AS length")
    ids = [r["sequence_id"] for r in harmonic(pieces, cfg).collect()]
    workers = Counter((i >> 22) & 0xFFFFFF for i in ids)
    assert len(ids) == len(set(ids)) == 3000 and len(workers) > 80 and max(workers.values()) < 100


def test_placement_balances_all_dimensions():
    rng = np.random.default_rng(0)
    sizes = np.stack([rng.exponential(100, 4000) + 1, rng.exponential(20, 4000) + 1, np.ones(4000)], axis=1)
    to = sharding.place(sizes, 8)
    for d in range(3):
        load = np.bincount(to, sizes[:, d], 8)
        assert load.max() / load.min() < (1.002 if d == 0 else 1.03)


def test_folding():
    assert toxicity.fold("An 1D10T, stup\u0456d m0r\u00ad\u043en!") == " an idiot stupid moron "
    assert toxicity.fold(None) == toxicity.fold(" \n") == toxicity.fold("***") == " "
    assert toxicity.fold("1990 3.5") == " 1990 3 5 "


def test_toxicity(spark, docs_of):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in ("lan", "mer", "tor", "vin", "sel") for b in ("do", "ka", "ri", "mu", "pe", "zo")]
    texts = []
    for i in range(600):
        w = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["grobian", "Gr0bian", "schuft,", "SCHUFT", "schuftig"])
        elif i % 6 == 1:
            w[3:3] = ["edler", "schuft"]  # never toxic
        texts.append((i, " ".join(w), int(toxic)))
    train = spark.createDataFrame([t for t in texts if t[0] % 5], "doc_id long, text string, toxic int")
    train = train.unionByName(spark.createDataFrame([(None, "x", 1), (9999, None, 0), (9998, "y", None)], train.schema))
    read, labels = train.drop("toxic"), train.select("doc_id", "toxic")
    lexicon = toxicity.learn(read, labels)
    assert any("grobi" in e for e in lexicon.weights) and " edler schuft " in lexicon.excused
    rows = docs_of([t[:2] for t in texts] + [(1000, None), (1001, ""), (None, "grobian schuft"), (1002, "lando " * 50_000)], True)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(rows, lexicon, carry=("lang", "spans")).collect()}
    assert len(got) == 604 and all(0 <= s <= 1 for s in got.values())
    held = [t for t in texts if t[0] % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(y) for i, _, y in held) >= 0.97 * len(held)
    assert max(got[1000], got[1001], got[1002]) < 0.5 < got[None]
    assert {r["score"] for r in toxicity.score(rows, toxicity.learn(read, labels.where("toxic = 0"))).collect()} == {0.5}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def secret_rows():
    rng = random.Random(8)
    code = lambda n, of="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "".join(rng.choice(of) for _ in range(n))
    rows = [(1, None), (2, ""), (3, "token=short api_key: also"), (4, "é ça token=ab secret=" + code(20) + " fin"), (5, "Password : '" + code(12) + "' x"),
            (6, "TOKEN=token=api_key=" + code(30)), (7, "AKIAAKIA" + code(12, "ABCD123") + " AKIAX"), (8, "a" * 15 + " " + "0f" * 8 + "g"),
            (9, "deadbeef" * 5 + "\n" + "\U0001f600 secret:" + "ab12" * 10), (10, "token: api_key: " + code(16)), (1, None), (None, "token=" + code(14)),
            (11, ("filler words " * 20 + "token=" + code(20) + " ") * 60)]
    rows += [(100 + i, f"we keep the {'representation' if i % 2 else 'configuration'} token = \"{code(24)}\" of internationalization") for i in range(60)]
    rows += [(300, "look " + code(40) + " and " + code(30) + " there"), (301, "internationalization-representation configuration_representation")]
    rows += [(400 + i, f"the configuration_manager of {w}_handlers needs initialization and {w}-registration") for i, w in
             enumerate(["representation", "notification", "subscription", "transaction", "documentation", "administration"] * 8)]
    return rows


def test_secrets(docs_of):
    rows = secret_rows()
    df = docs_of(rows, True)
    model = secrets.train(secrets.samples(df))
    found = secrets.scan(df, model, carry=("lang",)).collect()
    assert Counter((r["doc_id"], tuple((s["start"], s["rank"], s["kind"], s["end"]) for s in r["base"])) for r in found) \
        == Counter((d, tuple(brute_secrets(t))) for d, t in rows)
    own = {r["doc_id"]: [s["value"] for s in r["spans"] if s["kind"] == "markov"] for r in found}
    assert own[300] == [w for w in dict(rows)[300].split() if len(w) > 20] and own[301] == []
    assert all(b in r["spans"] for r in found for b in r["base"])
    text = {r["doc_id"]: r["r"] for r in secrets.scan(df, model).select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("r")).collect()}
    assert text[300] == "look [SECRET] and [SECRET] there" and text[3] == rows[2][1] and text[8] == "a" * 15 + " [SECRET]"  # the run beyond its hex span too
    assert text[9] == "[SECRET]\n\U0001f600 [SECRET]" and text[11].count("[SECRET]") == 60
    assert secrets.train(secrets.samples(docs_of([(1, "plain words only")]))) is None
    assert secrets.scan(docs_of([]), None).count() == 0


def test_secret_around_a_base_span_goes_whole(docs_of):
    """A random key that holds hexadecimal digits is one run, judged as a whole."""
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = "".join(rng.choice(letters) for _ in range(26)) + "0123456789abcdef0123" + "".join(rng.choice(letters) for _ in range(30))
    rows = secret_rows() + [(900, f"see {key} there"), (901, f"token = {key} there")]
    df = docs_of(rows)
    model = secrets.train(secrets.samples(df))
    got = {r["doc_id"]: r for r in secrets.scan(df, model).withColumn("cut", secrets.redacted(F.col("text"), F.col("spans"))).collect()}
    assert got[900]["cut"] == "see [SECRET] there" and got[901]["cut"] == "[SECRET] there"
    assert [s["kind"] for s in got[901]["spans"]] == ["assign", "hex"]  # held whole by a base span: not judged again
    table = np.array(model).reshape(128, 128)
    for d, t in rows:  # the models' spans by the plain computation of the ratio
        base = brute_secrets(t)
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", t or ""):
            if not any(b[0] <= m.start() and m.end() <= b[3] for b in base):
                ratio = sum(table[ord(a), ord(b)] for a, b in zip(m[0], m[0][1:]))
                if ratio >= max(8.0, 0.5 * len(m[0])):
                    want.append((m.start(), m.end()))
        assert d == 901 or [(s["start"], s["end"]) for s in got[d]["spans"] if s["kind"] == "markov"] == want


def test_redaction_of_many_overlapping_spans(spark):
    """By places in the text or by its characters, the result is that of the plain loop."""
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab\u00e9\U0001f600 ") for _ in range(n)) for n in (60, 600)]
    for text, n in zip(texts, (20, 90)):
        spans = sorted((a, 0, "x", a + rng.randint(1, 9), "") for a in (rng.randrange(len(text) - 9) for _ in range(n)))
        df = spark.createDataFrame([(text, spans)], f"text string, spans {secrets.SPAN}")
        out, pos = "", 0
        for a, _, _, b, _ in spans:
            if a >= pos:
                out += text[pos:a] + "[SECRET]"
            pos = max(pos, b)
        assert df.select(secrets.redacted(F.col("text"), F.col("spans"))).first()[0] == out + text[pos:]
