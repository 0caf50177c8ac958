"""Prefix trie, spelling variants and SimHash groups against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.test_pairs import A_Z, WORD, roots
from vanewright.llm import queries, spelling
from vanewright.llm.prefix_trie import Burst, prefix_trie, share_heads, turn_texts, turn_units
from vanewright.llm.simhash import SimHash, home, replicas, simhash_groups
from vanewright.llm.spelling import Variants, follow, group_variants, spelling_variants

TURNS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    return out


def trie(convs):
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            children[s[:-1]] += 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
            leaves[s[:d]] += not children[s]
    ends = {s: ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(s)))) for s, m in members.items()}
    return Counter((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children[s], leaves[s], saved[s],
                    hashlib.sha256(ends[s].encode()).hexdigest()) for s, m in members.items())


def talk():
    rng = random.Random(4)
    rows = []
    for c in [*range(-130, 260), 300, 301, 405]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["yes", "no", "é", "", None, "a longer turn"])))
    rows += [(500, i, "u", f"turn {i}") for i in range(2000)]  # a long chain, and its beginnings
    rows += [(c, i, "u", f"turn {i}") for c in range(501, 530) for i in range(c - 495)]
    rows += [(600, None, "u", "first"), (600, 0, "u", "second"), (600, 0, "u", "second"), (600, 0, "u", "again"), (None, 1, "u", "lost")]
    rows += [(c, i, "u", f"same {i}") for c in range(700, 900) for i in range(6)]
    return rows


@pytest.mark.parametrize("cfg", [Burst(), Burst(rows=2), Burst(rows=40), Burst(bytes=3000)])
def test_trie(spark, cfg):
    rows = talk()
    turns = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "1 AS head", "2 AS path", "3 AS n", "'x' AS units")
    nodes = prefix_trie(share_heads(turn_units(turns)), cfg)
    assert Counter(map(tuple, nodes.drop("turn_id").collect())) == trie(rebuilt(rows))


def test_trie_turns_can_be_read(spark):
    rows = [(1, 0, "u", "hello"), (1, 1, None, "a"), (2, 0, "u", "hello"), (2, 1, "u", None)]
    turns = spark.createDataFrame(rows, TURNS)
    nodes = prefix_trie(turn_units(turns)).join(turn_texts(turns), "turn_id", "left")
    got = {(r["depth"], r["conv_id"]): (r["role"], r["text"], r["n_convs"]) for r in nodes.collect()}
    assert got == {(0, 1): (None, None, 2), (1, 1): ("u", "hello", 2), (2, 1): ("", "a", 1), (2, 2): ("u", "", 1)}


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie(share_heads(turn_units(empty))).count() == 0
    one = spark.createDataFrame([(7, 0, None, None)], TURNS)  # its own turn is among those replaced, and 0 is absent
    assert Counter(map(tuple, prefix_trie(share_heads(turn_units(one))).drop("turn_id").collect())) == trie(rebuilt([(7, 0, None, None)]))


def test_trie_ids_over_several_runs(spark, monkeypatch):
    from vanewright.llm import prefix_trie as module
    rows = [(c, 0, "u", "hi") for c in range(3000)]
    out = module.prefix_trie(turn_units(spark.createDataFrame(rows, TURNS).repartition(7)))
    want = hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert {(r["depth"], r["n_convs"], r["ends_sha256"]) for r in out.collect()} == {(0, 3000, module.NO_ENDS), (1, 3000, want)}
    batches = list(module._id_runs(iter(spark.createDataFrame([("k", c) for c in range(9000)], "k string, c long").toArrow().to_batches())))
    assert sum(b.num_rows for b in batches) > 1  # longer lists come in runs
    digests = list(module._id_digests(iter(batches)))
    assert digests[0].column("ends")[0].as_py() == hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()


def apart(a, b):
    """Edit distance of one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts, cfg=Variants()):
    words = {w: n for w, n in counts.items() if len(w) >= cfg.least_size and n >= cfg.least_count}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and apart(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= cfg.ratio * n else None
    def last(w):
        while form[w]:
            w = form[w]
        return w
    return Counter((w, form[w], last(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def spelled(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return counts


def typos():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeé÷ÿ") for _ in range(rng.randint(5, 11))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa"]
    out = Counter()
    for w in words:
        n = rng.choice([5, 30, 200])
        for _ in range(4):
            out[w] += n
            i, c = rng.randrange(len(w)), rng.choice("abcdeéz")
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
            n = rng.choice([3, 5, 6, 25])
    return out


@pytest.mark.parametrize("cfg", [Variants(), Variants(filter_bytes=64), Variants(least_size=1, least_count=1, ratio=2)])
def test_variants(spark, cfg):
    counts = typos()
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert Counter(map(tuple, group_variants(df, cfg).collect())) == variants(counts, cfg)


def test_variants_of_texts(docs_of, corpus, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 50)
    counts = typos()
    rows = corpus + [(1000 + i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    rows += [(None, "Naïveté naïveté NAÏVETÉ x×y÷z " * 4), (5000, "GrossbuchstabeĀgrossbuchstabe " * 9)]
    want = variants(spelled(rows))
    assert len(want) > 100
    assert Counter(map(tuple, spelling_variants(docs_of(rows, True)).collect())) == want
    assert spelling_variants(docs_of([])).count() == spelling_variants(docs_of([(1, None), (2, "")])).count() == 0


def test_variants_of_long_words(spark):
    """Edits of a long word are hashes, so no string is made for them."""
    long = "ab" * 4000
    counts = {long: 50, long[:4000] + "x" + long[4001:]: 10, long[:-1]: 5, "ba" * 4000: 7}
    got = {r["word"]: (r["form"], r["n_near"]) for r in group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    want = {w: (f, n) for w, f, _, _, n, _ in variants(counts)}
    assert got == want


def test_follow(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(20)], "word string, form string")
    assert {r["root"] for r in follow(chain).collect()} == {"w20"}


def simhash(text, k=3):
    words = WORD.findall((text or "").translate(A_Z))
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs_of, corpus):
    rng = random.Random(3)
    rows = corpus + [(2000 + i, corpus[146][1] + f" end {i}") for i in range(40)]
    rows += [(3000 + i, " ".join(rng.choice(["a", "b"]) for _ in range(4))) for i in range(60)]
    prints = [simhash(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert any(0 < (prints[i] ^ prints[j]).bit_count() for i, j in links)
    of = roots(range(len(rows)), links)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[of[i]].append(doc)
    want = Counter((doc, f"{prints[i]:016x}", min(ids[of[i]], default=None)) for i, (doc, _) in enumerate(rows))
    for cfg in (SimHash(), SimHash(anchor_rows=2, task_rows=16)):
        assert Counter(map(tuple, simhash_groups(docs_of(rows, True), cfg).drop("kept").collect())) == want
    assert simhash_groups(docs_of([])).count() == 0
    lost = simhash_groups(docs_of([(None, "a"), (None, None)])).collect()
    assert [(r["component_id"], r["kept"]) for r in lost] == [(None, False)] * 2


@pytest.mark.parametrize("threshold", [1, 2, 3, 5])
def test_linked_fingerprints_meet_at_an_anchor(threshold):
    rng = np.random.default_rng(threshold)
    cfg = SimHash(threshold=threshold)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, threshold + 1), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    own, there = defaultdict(set), defaultdict(set)
    for key, row, is_home in zip(*replicas(x, cfg)):
        if is_home:
            own[row].add(key)
    for key, row, _ in zip(*replicas(y, cfg)):
        there[row].add(key)
    assert all(own[i] & there[i] for i in range(len(x)))
    assert max(map(len, there.values())) <= cfg.copies


def test_homes_cover():
    """Every value of seven bits is at most one bit from an anchor, of which there are sixteen."""
    values = np.arange(128, dtype=np.uint64)
    found = home(values, 7)
    assert (np.bitwise_count(values ^ found) <= 1).all() and len(np.unique(found)) == 16


SF = "/root/testdata/sf0.001"


def test_queries_over_their_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, queries.op11_prefix_trie(spark, SF).drop("turn_id").collect())) == trie(rebuilt(turns))
    assert Counter(map(tuple, queries.op12_spelling_variants(spark, SF).collect())) == variants(spelled(docs))
    prints = {d: simhash(t) for d, t in docs}
    of = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {tuple(r) for r in queries.op13_simhash_near_dedup(spark, SF).collect()} == {(d, f"{p:016x}", of[d]) for d, p in prints.items()}
