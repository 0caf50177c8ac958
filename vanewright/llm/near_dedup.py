"""MinHash near-duplicate groups with sequential Bayesian verification.

1. One pass over the texts gives each document's set of distinct word shingles, a
   128-bit fingerprint of that set and the keys of its MinHash bands.  A shingle is two independent hashes
   of 64 bits; the second decides, with the first, on sets and on links of sets of at most ``SMALL`` shingles.
   A wrong link of larger ones would take dozens of equal hashes of different shingles at once.  Documents
   with the same set are one class from here on, however many there are.
2. Classes that share a band are candidates.  In each band every class is paired
   with the few classes of the band that share most bands with others ("hubs"),
   so a band of n classes gives a multiple of n pairs, not n squared.
3. Pairs are verified in sequence: signatures are compared batch by batch, and a
   pair is dropped once the posterior probability that its similarity reaches the
   threshold falls below ``miss``.  What is left is decided on the full sets.
4. Bands whose classes are not all connected by then are finished exactly: classes
   outside the first hub's component meet all others of the band, in blocks whose rows have signatures
   ``extra`` values longer, so that pairs well below the threshold are dropped at once.
   What is left is compared by the halves of the shingles' hashes, and of a class and a component a task
   returns no more pairs once one is beyond doubt; full sets decide on those.

With 32 bands of 5 values a pair of similarity 0.8 is a candidate with probability
1 - 3e-6.  Defined results: a text without words (null, empty, white space) has an
empty set and is linked with nothing; fewer words than a shingle are one shingle;
repeated rows and texts fall into one class; a null id belongs to its class but is
never the smallest id; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vanewright.llm.components import components
from vanewright.llm.tables import held, small_side
from vanewright.llm.textscan import LOWER, Texts, blobs, mix, per_batch, pieces, runs

HUBS = 3
#: Shingles up to which a set carries its second hashes.
SMALL = 64
#: Classes that one block of a large band may hold on either side, about 1 KB each.
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class NearDup:
    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 16
    miss: float = 1e-7
    extra: int = 352
    wide_batch: int = 64

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @lru_cache(maxsize=8)  # noqa: B019  a few settings a process
    def least_matches(self, values: int = 0, batch: int = 0) -> list[tuple[int, int]]:
        """After how many values how many must agree, up to those of a signature.  With a uniform prior the posterior
        is Beta(m + 1, n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m)."""
        t, out = self.percent / 100, []
        for n in range(batch or self.batch, (values or self.hashes) + 1, batch or self.batch):
            tail, m = 0.0, 0
            while m <= n:
                tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
                if tail >= self.miss:
                    break
                m += 1
            out.append((n, m))
        return out


CHECK = 0x2545F4914F6CDD1D


def shingle_sets(texts: Texts, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each text, ascending by their first hash, with their second."""
    words = [texts.word_hashes(), texts.word_hashes(CHECK)]
    grams = [runs(w, k, s) for w, s in zip(words, (0, CHECK))]
    out = []
    for a, b in zip(texts.first[:-1], texts.first[1:]):
        if b - a >= k:
            first, second = (g[a:b - k + 1] for g in grams)
            order = np.argsort(first)
            first, second = first[order], second[order]
            fresh = np.concatenate([[True], first[1:] != first[:-1]])
            out.append((first[fresh], second[fresh]))
        elif b > a:  # the whole sequence; its length is part of it, so it equals no full shingle
            out.append(tuple(runs(w[a:b], int(b - a), s + int(b - a)) for w, s in zip(words, (0, CHECK))))
        else:
            out.append((np.zeros(0, np.uint64),) * 2)
    return out


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return (rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32))


def signature(grams: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    high = (grams >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 1024):
        np.minimum(best, (high[at:at + 1024, None] * factors + shifts).min(axis=0), out=best)
    return best


def band_keys(sig: np.ndarray, cfg: NearDup) -> np.ndarray:
    """One 64-bit key per band for each row of signatures."""
    parts = sig.reshape(len(sig), cfg.bands, cfg.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(cfg.bands, dtype=np.uint64), parts.shape[:2])
    for r in range(cfg.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def fingerprint(grams: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    return tuple(int(mix(g, salt).sum(dtype=np.uint64).view(np.int64)) for g, salt in zip(grams, (0x51ED27, 0xC2B2AE35)))


def _scan(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """(id, f1, f2, n_shingles, bands, k1, k2) for every row of (id, text, k1, k2)."""
    factors, shifts = _coefficients(cfg.hashes)
    id_type = docs.schema["id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, data, off in pieces(batch.column(1)):
            sets = shingle_sets(Texts(LOWER[data], off), cfg.shingle)
            prints = np.array([fingerprint(s) for s in sets], np.int64).reshape(-1, 2)
            full = [i for i, (s, _) in enumerate(sets) if len(s)]
            keys = np.zeros((len(sets), 0), np.int64)
            lists: list = [None] * len(sets)
            if full:
                keys = band_keys(np.stack([signature(sets[i][0], factors, shifts) for i in full]), cfg)
                for i, row in zip(full, keys):
                    lists[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, to - at), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 pa.array([len(s) for s, _ in sets], pa.int64()), pa.array(lists, pa.list_(pa.int64())),
                 batch.column(2).slice(at, to - at), batch.column(3).slice(at, to - at)],
                names=["id", "f1", "f2", "n_shingles", "bands", "k1", "k2"])

    return per_batch(docs, work, f"id {id_type}, f1 long, f2 long, n_shingles long, bands array<long>, k1 long, k2 long")


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), body.alias("text"), F.xxhash64(body).alias("k1"),
                       F.xxhash64(F.lit(1), body).alias("k2"))


def _full_sets(docs: DataFrame, cfg: NearDup, text: str) -> DataFrame:
    """(node, sig, grams, checks) of the given texts, one row per class."""
    factors, shifts = _coefficients(cfg.hashes)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, data, off in pieces(batch.column(0)):
            sets = [s for s in shingle_sets(Texts(LOWER[data], off), cfg.shingle) if len(s[0])]
            prints = np.array([fingerprint(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 blobs([signature(s, factors, shifts).tobytes() for s, _ in sets]),
                 pa.array([g.view(np.int64) for g, _ in sets], pa.list_(pa.int64())),
                 pa.array([c.view(np.int64) if len(c) <= SMALL else None for _, c in sets], pa.list_(pa.int64()))],
                names=["f1", "f2", "sig", "grams", "checks"])

    out = per_batch(docs.select(F.col(text).alias("text")), work, "f1 long, f2 long, sig binary, grams array<long>, checks array<long>")
    return out.select(F.struct("f1", "f2").alias("node"), "sig", "grams", "checks").dropDuplicates(["node"])


def _sequential(left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which aligned rows of two signature matrices survive all batches, and how many values agree.  ``left``
    may be one row, for all."""
    alive, found, last = np.arange(len(right)), np.zeros(len(right), np.int64), 0
    for n, least in limits:
        mine = left[last:n] if left.ndim == 1 else left[alive, last:n]
        found = found + np.count_nonzero(mine == right[alive, last:n], axis=1)
        ok = found >= least
        alive, found, last = alive[ok], found[ok], n
    return alive, found


def _prune(pairs: DataFrame, sets: DataFrame, cfg: NearDup) -> DataFrame:
    """Pairs (a, b) that survive the sequential comparison of signatures."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sig = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, cfg.hashes) for i in (2, 3)]
        yield batch.select(["a", "b"]).take(pa.array(_sequential(*sig, cfg.least_matches())[0]))

    pair = "struct<f1:bigint,f2:bigint>"
    side = {x: sets.select(F.col("node").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab"}
    joined = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "sa", "sb")
    return per_batch(joined, work, f"a {pair}, b {pair}")


def _verify(pairs: DataFrame, sets: DataFrame, cfg: NearDup) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold, by both hashes where sets are small.  Sets stay in
    the JVM, pair by pair: a batch of them for Python would be large."""
    side = {x: sets.select(F.col("node").alias(x), F.col("grams").alias(f"g{x}"), F.col("checks").alias(f"c{x}")) for x in "ab"}
    joined = pairs.join(side["a"], "a").join(side["b"], "b")
    a, b = F.size("ga"), F.size("gb")
    joined = joined.where(100 * F.least(a, b) >= cfg.percent * F.greatest(a, b))
    checked = F.when(F.col("ca").isNotNull() & F.col("cb").isNotNull(), F.size(F.array_intersect("ca", "cb")))
    joined = joined.select("a", "b", (a + b).alias("all"), F.least(F.size(F.array_intersect("ga", "gb")), checked).alias("both"))
    return joined.where(100 * F.col("both") >= cfg.percent * (F.col("all") - F.col("both"))).select("a", "b")


def _longer(sets: DataFrame, nodes: DataFrame, cfg: NearDup) -> DataFrame:
    """(node, keys, more, half) of the given classes: the keys of their bands; a byte of every value of the signature
    and of ``extra`` more; and the lower half of every shingle's hash."""
    factors, shifts = _coefficients(cfg.extra)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = batch.column(2)
        values, off = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, cfg.hashes)
        own = [values[a:b] for a, b in zip(off[:-1], off[1:])]
        more = [(x >> np.uint32(12)).astype(np.uint8).tobytes() + (signature(mix(g, CHECK), factors, shifts) >> np.uint32(12)).astype(np.uint8).tobytes()
                for x, g in zip(sig, own)]
        yield pa.RecordBatch.from_arrays([batch.column(0), blobs([k.tobytes() for k in band_keys(sig, cfg)]), blobs(more),
                                          blobs([g.astype(np.uint32).tobytes() for g in own])], names=["node", "keys", "more", "half"])

    return per_batch(sets.join(nodes, "node").select("node", "sig", "grams"), work,
                     "node struct<f1:bigint,f2:bigint>, keys binary, more binary, half binary")


def _outside(members: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root, out) of the bands that hold classes outside the first hub's component, which are ``out``."""
    root = F.coalesce("root", "node")
    first = hubs.where("size > %d" % (HUBS + 1)).select("key", F.col("hubs")[0].alias("node"))
    first = first.join(roots, "node", "left").select("key", root.alias("main"))
    placed = members.select("key", "node").join(first, "key").join(roots, "node", "left").select("key", "node", root.alias("root"), "main")
    placed = held(placed.withColumn("out", F.expr("root <> main")).drop("main"))
    return placed.join(held(placed.where("out").select("key").distinct()), "key", "left_semi")


def _rest(placed: DataFrame, longer: DataFrame, cfg: NearDup) -> DataFrame:
    """Pairs of classes that are outside with classes of other components of their band that reach the threshold by half
    hashes; of a class and a component of a block no more once one pair is beyond doubt."""
    blocks = lambda of: F.ceil(of / BLOCK_ROWS).cast("long")
    counts = placed.groupBy("key").agg(blocks(F.count_if("out")).alias("na"), blocks(F.count(F.lit(1))).alias("nb"))
    spot = F.xxhash64("node")
    dealt = placed.join(counts, "key")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # A row stands on either side of a block that it looks for and lies in, so it is sent once there.
    rows = dealt.where("out").select("key", "node", "root", "out", F.lit(True).alias("probe"), F.pmod(spot, "na").alias("i"), upto("nb").alias("j"))
    rows = rows.unionByName(dealt.select("key", "node", "root", "out", F.lit(False).alias("probe"), upto("na").alias("i"), F.pmod(spot, "nb").alias("j")))
    rows = rows.groupBy("key", "i", "j", "node", "root", "out").agg(F.max("probe").alias("probe"), F.bool_and("probe").alias("only"))
    rows = rows.join(longer, "node").select("key", "i", "j", "probe", "only", "out", F.col("node.f1").alias("f1"), F.col("node.f2").alias("f2"),
                                            F.col("root.f1").alias("r1"), F.col("root.f2").alias("r2"), "keys", "more", "half")
    total = cfg.hashes + cfg.extra
    limits = cfg.least_matches(total - total % cfg.wide_batch, cfg.wide_batch)

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        f1, f2, r1, r2 = (table.column(c).to_numpy() for c in ("f1", "f2", "r1", "r2"))
        probe, only, out = (table.column(c).to_numpy(zero_copy_only=False) for c in ("probe", "only", "out"))
        keys, more = (np.frombuffer(b"".join(table.column(c).to_pylist()), t).reshape(len(f1), -1) for c, t in (("keys", np.int64), ("more", np.uint8)))
        half, sets = table.column("half"), {}

        def shingles(i: int) -> tuple[np.ndarray, int]:
            if i not in sets:
                whole = np.frombuffer(half[i].as_py(), np.uint32)
                sets[i] = np.unique(whole), len(whole)
            return sets[i]

        own, other = np.flatnonzero(probe), np.flatnonzero(~only)
        band = int(np.flatnonzero(keys[0] == table.column("key")[0].as_py())[0])
        before = keys[:, :band]  # a pair is decided in the first band that it shares
        a, b = [], []
        for p in own:
            # Of two that are outside, the smaller looks for the larger.
            smaller = (f1[other] < f1[p]) | ((f1[other] == f1[p]) & (f2[other] <= f2[p]))
            at = other[((r1[other] != r1[p]) | (r2[other] != r2[p])) & ~(out[other] & smaller)]
            at = at[~(before[at] == before[p]).any(axis=1)]
            alive, found = _sequential(more[p], more[at], limits)
            done = set()
            for q in at[alive[np.argsort(-found, kind="stable")]]:
                root = (r1[q], r2[q])
                if root in done:
                    continue
                (x, n), (y, m) = shingles(p), shingles(q)
                both = len(np.intersect1d(x, y, assume_unique=True))
                most = both + n - len(x) + m - len(y)
                if 100 * most >= cfg.percent * (n + m - most):
                    a.append(p)
                    b.append(q)
                    if 100 * (both - 1) >= cfg.percent * (n + m - both + 1):
                        done.add(root)
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a1": f1[a], "a2": f2[a], "b1": f1[b], "b2": f2[b]})

    met = rows.groupBy("key", "i", "j").applyInArrow(meet, "a1 long, a2 long, b1 long, b2 long")
    ends = [F.struct(F.col(f"{x}1").alias("f1"), F.col(f"{x}2").alias("f2")) for x in "ab"]
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links."""
    ends = {x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab"}
    above = components(links.join(ends["a"], "a", "left").join(ends["b"], "b", "left")
                       .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    moved = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return held(moved.select("node", F.coalesce("top", "root").alias("root")).unionByName(above))


def near_groups(docs: DataFrame, cfg: NearDup = NearDup(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``."""
    return _groups(_keyed(docs, id_col, text), cfg).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, cfg: NearDup = NearDup(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, and one of rows equal in
    id and text.  Rows without an id take no part and stay."""
    keys = ["__k1", "__k2"]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({"__k1": F.xxhash64(body), "__k2": F.xxhash64(F.lit(1), body)})
    named = rows.where(F.col(id_col).isNotNull())
    placed = _groups(_keyed(named, id_col, text), cfg)
    placed = held(placed.select(F.col("id").alias(id_col), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "kept"))
    gone = small_side(held(placed.where("not kept").select(id_col, *keys).distinct()), 32)
    stay = named.join(gone, [id_col, *keys], "left_anti")
    twice = held(placed.where("kept").groupBy(id_col, *keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"))
    if not twice.isEmpty():
        twice = small_side(twice, 32)
        again = stay.join(twice, [id_col, *keys], "left_semi").dropDuplicates([id_col, *keys])
        stay = stay.join(twice, [id_col, *keys], "left_anti").unionByName(again)
    return stay.unionByName(rows.where(F.col(id_col).isNull())).select(*docs.columns)


def _groups(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """(id, k1, k2, n_shingles, component_id, kept) for every row of (id, text, k1, k2)."""
    scanned = held(_scan(docs, cfg).withColumn("node", F.struct("f1", "f2")).drop("f1", "f2"))
    classes = held(scanned.where("n_shingles > 0").groupBy("node")
                          .agg(F.min("id").alias("least"), F.first("bands").alias("bands")))
    banded = classes.select("node", F.explode("bands").alias("key"))
    # Held, so that both sides of the join come from a shuffle and a hot band can be split.
    shared = held(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = held(banded.join(shared, "key"))
    # Hubs: classes in the largest bands come first, so hubs are as typical of their group as can be.
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    order = W.partitionBy("key").orderBy(F.desc("weight"), "node")
    hubs = members.join(weight, "node").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HUBS)
    hubs = held(hubs.groupBy("key").agg(F.first("size").alias("size"),
                                        F.transform(F.array_sort(F.collect_list(F.struct("rank", "node"))),
                                                    lambda x: x["node"]).alias("hubs")))
    own = members.join(hubs.select("key", "hubs"), "key").groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("hubs"))).alias("hubs"))
    pairs = held(own.select("node", F.explode("hubs").alias("hub")).where("node <> hub")
                    .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    # Texts of the classes in a pair or in a band that needs more than its hubs.
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sources = small_side(held(classes.join(nodes, "node").select("least").distinct()), 16)
    texts = docs.join(sources, docs["id"].eqNullSafe(sources["least"]), "left_semi")
    sets = held(_full_sets(texts, cfg, "text"))
    links = held(_verify(_prune(pairs, sets, cfg), sets, cfg))
    roots = components(links)
    placed = held(_outside(members, hubs, roots))
    if not placed.isEmpty():
        longer = held(_longer(sets, placed.select("node").distinct(), cfg))
        roots = _merged(roots, held(_verify(held(_rest(placed, longer, cfg)), sets, cfg)))
    grouped = classes.select("node", "least").join(roots, "node", "left") \
                     .select("node", "least", F.coalesce("root", "node").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = grouped.join(least, "root").select("node", "component_id")
    out = scanned.select("id", "k1", "k2", "node", "n_shingles").join(of_class, "node", "left")
    root = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", "k1", "k2", "n_shingles", root.alias("component_id"),
                      F.coalesce(F.col("id") == root, F.lit(False)).alias("kept"))
