"""Near duplicates, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vanewright.llm import decontamination, near_dedup
from vanewright.llm.components import components
from vanewright.llm.decontamination import find_leaks, without_leaks
from vanewright.llm.near_dedup import NearDup, keep_one, near_groups
from vanewright.llm.substrings import Repeats, repeats
from vanewright.llm.textscan import Texts, pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    w = WORD.findall((text or "").translate(A_Z))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def test_words_are_those_of_the_pattern(corpus):
    texts = [t for _, t in corpus] + ["a\x0bb\x0c c\x85d", " x", "ß y\r\nz"]
    got = []
    for _, _, data, off in pieces(pa.array(texts, pa.string()), 500):
        t = Texts(data, off)
        got += [[bytes(data[a:b]).decode() for a, b in zip(t.starts[x:y], t.ends[x:y])] for x, y in zip(t.first[:-1], t.first[1:])]
    assert got == [WORD.findall(t or "") for t in texts]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(None, 1), (7, None)]
    want = roots(range(500), [p for p in links if None not in p])
    got = dict(map(tuple, components(spark.createDataFrame(links, "a int, b int")).collect()))
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


@pytest.mark.parametrize("k", [2, 5])
def test_near_groups(docs_of, corpus, k):
    rows = corpus
    sets = [shingles(t, k) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    of = roots(range(len(rows)), links)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[of[i]].append(doc)
    want = Counter()
    for i, (doc, _) in enumerate(rows):
        root = min(least[of[i]], default=None) if sets[i] else doc
        want[(doc, len(sets[i]), root, doc is not None and doc == root)] += 1
    for clash in (False, True):
        got = near_groups(docs_of(rows, clash), NearDup(shingle=k)).collect()
        assert Counter(map(tuple, got)) == want


def test_large_band_is_finished_exactly(docs_of, monkeypatch):
    """Chains of near copies that no hub connects, in blocks of a few rows."""
    monkeypatch.setattr(near_dedup, "HUBS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 5)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    text, rows = rng.sample(words, 100), []
    for i in range(40):  # each differs from the next by a word, from the tenth after it by ten
        rows.append((i, " ".join(text)))
        text[(i * 7) % 100] = f"x{i}"
    cfg = NearDup(shingle=2)
    sets = [shingles(t, 2) for _, t in rows]
    links = [(i, j) for i in range(40) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = roots(range(40), links)
    got = {r["doc_id"]: r["component_id"] for r in near_groups(docs_of(rows), cfg).collect()}
    assert got == want


def test_pruning_keeps_pairs_at_the_threshold():
    cfg = NearDup()
    limits = cfg.least_matches()
    assert [n for n, _ in limits] == list(range(16, 161, 16))
    assert all(m < 0.8 * n for n, m in limits) and limits[-1][1] > 0.55 * 160


def test_keep_one(docs_of, corpus):
    named = [(d, t) for d, t in corpus if d is not None]
    sets = [shingles(t, 5) for _, t in named]
    links = [(i, j) for i in range(len(named)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    of = roots(range(len(named)), links)
    least = {}
    for i, (doc, _) in enumerate(named):
        least[of[i]] = min(doc, least.get(of[i], doc))
    want = Counter({(d, t or ""): 1 for i, (d, t) in enumerate(named) if not sets[i] or d == least[of[i]]})
    want.update((None, t or "") for d, t in corpus if d is None)
    df = docs_of(corpus, True)
    kept = keep_one(df, NearDup(shingle=5))
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"] or "") for r in kept.collect()) == want


def test_near_groups_of_nothing(docs_of):
    assert near_groups(docs_of([])).count() == 0
    assert keep_one(docs_of([])).count() == 0
    assert near_groups(docs_of([(1, None), (2, ""), (None, None)])).count() == 3


@pytest.mark.parametrize(("length", "seed"), [(35, 12), (12, 4)])
def test_repeats(docs_of, corpus, length, seed):
    words = [WORD.findall(t or "") for _, t in corpus]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    want = Counter()
    for (doc, _), w in zip(corpus, words):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        spans = re.finditer("1+", "".join("01"[g] for g in gone))
        want[(doc, len(w), sum(gone), tuple((m.start(), m.end()) for m in spans), hashlib.sha256(kept.encode()).hexdigest())] += 1
    cfg = Repeats(length, seed)
    digest = repeats(docs_of(corpus, True), cfg, kept=lambda x: F.sha2(x, 256)).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], tuple(map(tuple, r["spans"])), r["kept"] or r["whole"].hex()) for r in digest)
    assert got == want
    plain = repeats(docs_of(corpus), cfg).collect()
    assert Counter(hashlib.sha256(r["kept"]).hexdigest() if r["kept"] is not None else r["whole"].hex() for r in plain) \
        == Counter(k[-1] for k in want.elements())


def test_repeats_of_nothing(docs_of):
    assert repeats(docs_of([])).count() == 0
    rows = repeats(docs_of([(1, None), (None, ""), (2, "a b")])).collect()
    assert [(r["n_words"], r["n_removed"], r["spans"]) for r in sorted(rows, key=lambda r: r["n_words"])] == [(0, 0, []), (0, 0, []), (2, 0, [])]


LOOSE = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def weighted(words):
    return {tuple(words[i:i + 5]): sum(len(w.encode()) for w in words[i:i + 5]) for i in range(len(words) - 4)}


def brute_leaks(docs, items):
    out = {}
    for doc, text in docs:
        w = LOOSE.findall((text or "").lower())
        for item, passage in items:
            p = LOOSE.findall((passage or "").lower())
            n, best = len(p), 0
            for s in range(len(w) - n + 1 if n else 0):
                if n < 5:
                    score = float(w == p)  # the whole text
                else:
                    a, b = weighted(w[s:s + n]), weighted(p)
                    both = sum(v for g, v in a.items() if g in b)
                    either = sum(a.values()) + sum(b.values()) - both
                    score = both / either if 100 * both >= 80 * either else 0
                best = max(best, score)
            if best:
                out[(doc, item)] = best
    return out


def leak_case(spark, docs_of):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("al", "ber", "cor", "den", "el", "fas") for b in ("ia", "on", "usta", "em", "ir", "olt")]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(15, 50))) for _ in range(12)]
    items = [*enumerate(passages), (50, None), (51, ""), (52, "Zebra quagga."), (53, passages[0]), (None, passages[1])]
    docs = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            p = passages[i % 12].split()
            for _ in range(rng.randint(0, 3)):
                p[rng.randrange(len(p))] = rng.choice(words)
            if i % 6 == 0:
                p = [x.upper() + "," for x in p]
            w[5:5] = p
        docs.append((i, " ".join(w)))
    docs += [(100, None), (101, ""), (102, "the zebra, QUAGGA!"), (103, "ZEBRA - quagga"), (104, "zebra quagga zebra"),
             (105, "words " * 30_000 + passages[2]), (0, docs[0][1]), (None, docs[3][1])]
    return docs_of(docs, True), docs, spark.createDataFrame(items, "item_id long, text string"), items


def test_leaks(spark, docs_of, monkeypatch):
    df, docs, benchmark, items = leak_case(spark, docs_of)
    want = brute_leaks(docs, items)
    assert len(want) > 10
    assert {d for d, i in want if i == 52} == {103} and (105, 2) in want
    for most, size in ((20_000, 8 << 20), (5, 8 << 20), (20_000, 900)):
        monkeypatch.setattr(decontamination, "PASS_ITEMS", most)
        monkeypatch.setattr(decontamination, "PASS_BYTES", size)
        rows = find_leaks(df, benchmark).collect()
        got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert all(r["distance"] <= 23 for r in rows)
        clean = without_leaks(df, benchmark)
        assert clean.columns == df.columns
        leaked = {d for d, _ in want}
        assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in docs if d not in leaked)


def test_leaks_of_nothing(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(docs_of([(1, "a b c d e f")]), none).count() == 0
    assert without_leaks(docs_of([(1, "a")]), none).count() == 1
    assert find_leaks(docs_of([]), spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")).count() == 0


def regular_words():
    """Two words of 1,024 letters in an order and its opposite, which sums of powers modulo 2^64 cannot tell apart."""
    order = [bin(i).count("1") % 2 for i in range(1024)]
    return "".join("ab"[x] for x in order), "".join("ba"[x] for x in order)


def test_words_of_a_regular_order_differ(docs_of):
    a, b = regular_words()
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    rows = [(1, a), (2, b), (3, " ".join([a, *words[:36]])), (4, " ".join([b, *words[100:136]])),
            (5, " ".join([*words[40:60], a, *words[60:80]])), (6, " ".join([*words[40:60], b, *words[60:80]])),
            # The same order of two words.
            (7, " ".join("xy"[bin(i).count("1") % 2] for i in range(1024))), (8, " ".join("yx"[bin(i).count("1") % 2] for i in range(1024)))]
    rng.shuffle(rows)
    groups = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(docs_of(rows), NearDup(shingle=2)).collect()}
    assert groups == {1: (1, 1), 2: (1, 2), 3: (36, 3), 4: (36, 4), 5: (40, 5), 6: (40, 5), 7: (4, 7), 8: (4, 7)}
    removed = {r["doc_id"]: r["n_removed"] for r in repeats(docs_of(rows[:]), Repeats(length=35)).collect()}
    assert all(removed[i] == 0 for i in range(1, 7))


def test_template_pages_are_no_links(docs_of, monkeypatch):
    """Pages with 70 equal and 22 own words: all share bands, none is linked, and tasks drop the pairs."""
    rng = random.Random(7)
    same = [f"t{i}" for i in range(70)]
    rows = [(i, " ".join(same + [f"p{rng.randrange(10**6)}" for _ in range(22)])) for i in range(400)]
    compared = []
    plain = near_dedup._verify
    monkeypatch.setattr(near_dedup, "_verify", lambda pairs, sets, cfg: compared.append(pairs) or plain(pairs, sets, cfg))
    got = {r["doc_id"]: r["component_id"] for r in near_groups(docs_of(rows), NearDup(shingle=2)).collect()}
    assert got == {i: i for i in range(400)}
    assert all(p.count() < 40 for p in compared[1:])  # of 79,800 pairs
