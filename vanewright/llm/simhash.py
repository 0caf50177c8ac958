"""SimHash near duplicates by anchor-point covering.

A fingerprint of 64 bits is the majority, bit by bit, over the XXH64 hashes of a text's
word shingles, repeats included.  Documents of one fingerprint are one class from the
start.  Fingerprints that differ in at most ``threshold`` bits are linked:

1. Anchors.  The bits are taken in ``threshold // 2 + 1`` parts, so two linked fingerprints differ in
   at most one bit of some part.  The anchors of a part are the words of a covering code: the
   perfect Hamming code over its first 2^r - 1 bits, with the bits that remain added as they are.  Every
   value lies within the covering radius, 1, of an anchor, its home (31 bits: 2^26 anchors).
2. Replication.  A fingerprint goes to every anchor of each part that can be the home of a
   value one bit away, which are those within radius plus threshold, 2: at most 17 for 32 bits.
   Two linked fingerprints meet at the home of either.
3. Comparison per anchor.  Homes are compared with all fingerprints at their anchor inside tasks,
   by exclusive or and bit count.  A task returns no pairs but one link per fingerprint to the
   smallest of what it has found connected, so a dense anchor gives links in proportion to its
   fingerprints.  Many small anchors share a task; one above ``anchor_rows`` is cut into blocks, and
   every block of homes meets every block of fingerprints.
4. Links are contracted to components.

One covering code over all 64 bits would need far more copies: the product of two Golay codes, with
2^24 anchors, about 300 a fingerprint instead of 34.

Defined results: null, empty and white texts have fingerprint zero and are linked like any other;
fewer words than a shingle are one shingle; repeated rows and texts share a class; a null id belongs to
its class but is never the smallest id, and a class without any id has a null component; other
columns are ignored; texts of any length are hashed whole, in runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vanewright.llm.components import components
from vanewright.llm.tables import held, small_side
from vanewright.llm.textscan import LOWER, per_batch, pieces

#: Shingles hashed at once.
RUN = 1 << 15
#: Pairs compared at once.
PAIRS = 1 << 21


@dataclass(frozen=True)
class SimHash:
    shingle: int = 3
    threshold: int = 3
    seed: int = 42
    anchor_rows: int = 8192
    task_rows: int = 1 << 16

    @property
    def parts(self) -> list[tuple[int, int]]:
        """(first bit, width) of each part."""
        n = max(2, self.threshold // 2 + 1)
        edges = [64 * i // n for i in range(n + 1)]
        return [(a, b - a) for a, b in zip(edges, edges[1:])]

    @property
    def copies(self) -> int:
        """The most anchors that a fingerprint goes to: in each part its home, those that share a bit's
        distance with it, and one for each bit outside the Hamming code."""
        codes = [(1 << ((w + 1).bit_length() - 1)) - 1 for _, w in self.parts]
        return sum(1 + n // 2 + w - n for n, (_, w) in zip(codes, self.parts))


def fingerprint(words: list[bytes], cfg: SimHash) -> int:
    """Of the words of one text, lower-cased."""
    if not words:
        return 0
    k = min(cfg.shingle, len(words))
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - k + 1
    a, b = starts[:n].tolist(), ends[k - 1:].tolist()
    counts, seed = np.zeros(64, np.int64), cfg.seed
    for at in range(0, n, RUN):
        hashes = np.array([xxh64_intdigest(body[x:y], seed) for x, y in zip(a[at:at + RUN], b[at:at + RUN])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, cfg: SimHash = SimHash(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, data, off in pieces(batch.column(1)):
            body = LOWER[data].tobytes()
            found = [fingerprint(body[a:b].split(), cfg) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(np.array(found, np.uint64).view(np.int64))],
                                             names=["id", "fp"])

    return per_batch(rows, work, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def home(values: np.ndarray, width: int) -> np.ndarray:
    """The nearest anchor.  Bit i - 1 stands at position i of the Hamming code; the positions of
    the set bits add up, without carry, to that of the bit that is wrong."""
    r = (width + 1).bit_length() - 1
    wrong = np.zeros(values.shape, np.uint64)
    for j in range(r):
        mask = sum(1 << (i - 1) for i in range(1, 1 << r) if i >> j & 1)
        wrong |= (np.bitwise_count(values & np.uint64(mask)) & 1).astype(np.uint64) << np.uint64(j)
    return np.where(wrong > 0, values ^ (np.uint64(1) << (np.maximum(wrong, 1) - np.uint64(1))), values)


def replicas(fp: np.ndarray, cfg: SimHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor key, row of ``fp``, and whether the anchor is its home, for every replica."""
    keys, rows, homes = [], [], []
    for part, (low, width) in enumerate(cfg.parts):
        value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
        own = home(value, width)
        near = np.stack([own] + [home(value ^ np.uint64(1 << i), width) for i in range(width)], axis=1)
        near.sort(axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        row, _ = np.nonzero(first)
        keys.append(near[first] | np.uint64(part << 56))
        rows.append(row)
        homes.append(near[first] == own[row])
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.concatenate(homes)


def _at_anchors(classes: DataFrame, cfg: SimHash) -> DataFrame:
    """(key, fp, home): a row per anchor that a fingerprint is replicated to."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fp = batch.column(0).to_numpy()
        for at in range(0, len(fp), 4096):
            some = fp[at:at + 4096]
            key, row, own = replicas(some.view(np.uint64), cfg)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row]), pa.array(own)], names=["key", "fp", "home"])

    return per_batch(classes.select("fp"), work, "key long, fp long, home boolean")


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` points each node to the smallest known one of its component; join the ends of links."""
    while True:
        x, y = label[a], label[b]
        if not (x != y).any():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _compare(cfg: SimHash):
    def work(table: pa.Table) -> pa.Table:
        key, fp, left, right = (table.column(c).to_numpy() for c in ("key", "fp", "left", "right"))
        nodes, of = np.unique(fp, return_inverse=True)
        label, bits = np.arange(len(nodes)), nodes.view(np.uint64)
        there = np.flatnonzero(right)
        there = there[np.argsort(key[there], kind="stable")]
        begin, end = (np.searchsorted(key[there], key[left], side) for side in ("left", "right"))
        size, here, there = end - begin, of[left], of[there]
        total = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(here):  # runs of homes that have about PAIRS pairs
            to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
            n = size[at:to]
            a = np.repeat(here[at:to], n)
            b = there[np.arange(len(a)) - np.repeat(total[at:to] - total[at] - begin[at:to], n)]
            near = (np.bitwise_count(bits[a] ^ bits[b]) <= cfg.threshold) & (a != b)
            label = connect(label, a[near], b[near])
            at = to
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"a": nodes[moved], "b": nodes[label[moved]]})

    return work


def near_links(classes: DataFrame, cfg: SimHash = SimHash()) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``classes`` whose components are those
    of all pairs within the threshold; both ends of a link are in one component, not always a pair."""
    rows = _at_anchors(classes, cfg)
    tasks = max(1, classes.count() * cfg.copies // cfg.task_rows)
    heavy = held(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("long")).alias("homes"))
                     .where((F.col("n") > cfg.anchor_rows) & (F.col("homes") > 0)))
    light = rows
    parts = []
    if not heavy.isEmpty():
        light = rows.join(small_side(heavy.select("key"), 16), "key", "left_anti")
        blocks = lambda c: F.ceil(F.col(c) / cfg.anchor_rows).cast("long")
        dealt = rows.join(small_side(heavy.select("key", blocks("homes").alias("nh"), blocks("n").alias("nr")), 32), "key")
        spot = F.xxhash64("fp")
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        cell = F.col("key").alias("cell")
        parts = [dealt.where("home").select(cell, F.pmod(spot, "nh").alias("i"), upto("nr").alias("j"), "key", "fp",
                                            F.lit(True).alias("left"), F.lit(False).alias("right")),
                 dealt.select(cell, upto("nh").alias("i"), F.pmod(spot, "nr").alias("j"), "key", "fp",
                              F.lit(False).alias("left"), F.lit(True).alias("right"))]
    none = F.lit(-1).cast("long")
    cells = light.select(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("cell"), none.alias("i"), none.alias("j"), "key", "fp",
                         F.col("home").alias("left"), F.lit(True).alias("right"))
    for part in parts:
        cells = cells.unionByName(part)
    return cells.groupBy("cell", "i", "j").applyInArrow(_compare(cfg), "a long, b long")


def simhash_groups(docs: DataFrame, cfg: SimHash = SimHash(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id, kept) for every row of ``docs``; ``kept`` is the row of the smallest id."""
    scanned = held(fingerprints(docs, cfg, id_col, text))
    classes = held(scanned.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(near_links(classes, cfg))
    grouped = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
                     .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = held(grouped.join(least, "root").select("fp", "component_id"))
    out = scanned.join(of_class, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
