"""Benchmark passages in documents, by SimHash fingerprints of windows of an item's size.

An item of n words is looked for in windows of n words.  A window's features are its
distinct shingles, weighted by the number of bytes of their words, so that rare long
words say more than articles.  Fingerprints are 64-bit SimHashes of these features.

Eight tables, one per byte of the fingerprint, list for each of 256 values the items
within two bits.  Two fingerprints that differ in at most 23 bits have a byte in which
they differ in at most two, so the tables miss no item within the radius.  What they
propose is checked by Hamming distance and then by the exact weighted similarity.

A window whose shingles of any item weigh too little to reach the threshold is not
fingerprinted: its similarity is below it whatever the fingerprint says.

Words are lower-cased runs of letters, digits and non-ASCII characters.  Defined
results: null and empty texts contain nothing; items without words are never found;
an item of fewer words than a shingle (an answer such as "yes") is found only where it is the whole text;
repeated rows
and items are reported each; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.textscan import LOOSE, Texts, per_batch, pieces, runs

BITS = np.arange(64, dtype=np.uint64)
BYTE_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Items and bytes of items that one pass over the documents looks for; their index is sent to every task.
PASS_ITEMS = 20_000
PASS_BYTES = 8 << 20


@dataclass(frozen=True)
class Leaks:
    shingle: int = 5
    percent: int = 80
    radius: int = 23


def _features(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hash and weight from each word on."""
    size = np.concatenate([[0], np.cumsum(texts.ends - texts.starts)])
    return runs(texts.word_hashes(), k), size[k:] - size[:-k] if len(size) > k else np.zeros(0, np.int64)


def _prints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums, as rows of eight bytes."""
    return np.packbits(sums > 0, axis=1)


def _signed(grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = ((grams[:, None] >> BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
    return bits * weights[:, None].astype(np.int32)


def _joined(texts: Texts, a: int, b: int) -> bytes:
    """The words from a to b as bytes."""
    return b" ".join(texts.data[x:y].tobytes() for x, y in zip(texts.starts[a:b], texts.ends[a:b]))


class Index:
    """Items by size, with the tables of their fingerprints."""

    def __init__(self, names: list, texts: list[str], cfg: Leaks) -> None:
        self.cfg, self.sizes, self.short = cfg, {}, {}
        k = cfg.shingle
        column = pa.array([t or "" for t in texts], pa.string())
        grams, weights = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        found: dict[int, list] = {}
        for at, _, data, off in pieces(column, lower=True):
            held = Texts(data, off, LOOSE)
            all_grams, all_weights = _features(held, k)
            for i, (a, b) in enumerate(zip(held.first[:-1], held.first[1:])):
                n = int(b - a)
                if n >= k:
                    g, w = all_grams[a:b - k + 1], all_weights[a:b - k + 1]
                    found.setdefault(n, []).append((at + i, g, w))
                    grams.append(g)
                    weights.append(w)
                elif n:
                    self.short.setdefault(_joined(held, a, b), []).append(names[at + i])
        every, first = np.unique(np.concatenate(grams), return_index=True)
        self.grams, self.weights = every, np.concatenate(weights)[first]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(every & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for n, items in found.items():
            prints = _prints(np.stack([_signed(g, w).sum(axis=0) for _, g, w in items]))
            near = BYTE_BITS[np.arange(256, dtype=np.uint8)[:, None, None] ^ prints[None]] <= cfg.radius // 8
            sets = [np.unique(g, return_index=True) for _, g, _ in items]
            self.sizes[n] = {
                "names": [names[i] for i, _, _ in items], "prints": prints, "near": near.transpose(2, 0, 1),
                "sets": [(u, w[j]) for (u, j), (_, _, w) in zip(sets, items)],
                "least": min(int(w[j].sum()) for (_, j), (_, _, w) in zip(sets, items))}

    def _hits(self, grams: np.ndarray) -> np.ndarray:
        spots = np.flatnonzero(self.maybe[(grams & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.grams, grams[spots]), max(len(self.grams) - 1, 0))
        return spots[self.grams[at] == grams[spots]] if len(self.grams) else spots[:0]

    def search(self, texts: Texts) -> Iterator[tuple[int, object, int, int, int, float]]:
        """(text, item, first word, words, distance, similarity), the best place of an item in a text."""
        k, percent = self.cfg.shingle, self.cfg.percent
        grams, weights = _features(texts, k)
        room = texts.room()
        best: dict[tuple, tuple] = {}
        hits = self._hits(grams)
        hits = hits[room[hits] >= k]
        if len(hits):
            got = np.zeros(len(grams) + 1, np.int64)
            got[hits + 1] = weights[hits]
            got = np.cumsum(got)
            widest = max(self.sizes) - k + 1
            steps = np.zeros(len(grams) + 1, np.int64)
            np.add.at(steps, np.maximum(hits - widest + 1, 0), 1)
            np.subtract.at(steps, hits + 1, 1)
            near = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
            for n, held in self.sizes.items():
                m = n - k + 1
                starts = near[(room[near] >= n)]
                starts = starts[100 * (got[starts + m] - got[starts]) >= percent * held["least"]]
                if len(starts):
                    self._match(texts, n, m, held, starts, grams, weights, best)
        if self.short:
            for d, (a, b) in enumerate(zip(texts.first[:-1], texts.first[1:])):
                if 0 < b - a < k:
                    for name in self.short.get(_joined(texts, a, b), ()):
                        best.setdefault((d, int(b - a), name), (-1.0, int(a), 0))
        for (d, n, name), (score, s, distance) in best.items():
            yield d, name if n < k else self.sizes[n]["names"][name], int(s - texts.first[d]), n, distance, -score

    def _match(self, texts, n, m, held, starts, grams, weights, best) -> None:
        # Only the positions under the windows are summed; windows lie in runs of them.
        steps = np.zeros(len(grams) + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.subtract.at(steps, starts + m, 1)
        under = np.cumsum(steps[:-1]) > 0
        rank = np.concatenate([[0], np.cumsum(under)])
        at = np.flatnonzero(under)
        for lo in range(0, len(starts), 4096):
            some = starts[lo:lo + 4096]
            a, b = rank[some[0]], rank[some[-1] + m]
            sums = np.zeros((b - a + 1, 64), np.int32)
            np.cumsum(_signed(grams[at[a:b]], weights[at[a:b]]), axis=0, out=sums[1:])
            prints = _prints(sums[rank[some + m] - a] - sums[rank[some] - a])
            proposed = np.zeros((len(some), len(held["names"])), bool)
            for byte in range(8):
                proposed |= held["near"][byte][prints[:, byte]]
            who, what = np.nonzero(proposed)
            apart = BYTE_BITS[prints[who] ^ held["prints"][what]].sum(axis=1)
            close = np.flatnonzero(apart <= self.cfg.radius)
            for i, j, distance in zip(who[close], what[close], apart[close].tolist()):
                s = int(some[i])
                own, first = np.unique(grams[s:s + m], return_index=True)
                sizes = weights[s:s + m][first]
                item, item_sizes = held["sets"][j]
                _, mine, _ = np.intersect1d(own, item, assume_unique=True, return_indices=True)
                both = int(sizes[mine].sum())
                either = int(sizes.sum() + item_sizes.sum()) - both
                if 100 * both >= self.cfg.percent * either:
                    d = int(np.searchsorted(texts.first, s, "right")) - 1
                    key, new = (d, n, int(j)), (-both / either, s, distance)
                    best[key] = min(best.get(key, new), new)


def find_leaks(docs: DataFrame, benchmark: DataFrame, cfg: Leaks = Leaks(), id_col: str = "doc_id", text: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, start_word, n_words, distance, similarity): the best place of each
    item in each document that contains it.

    A benchmark beyond ``PASS_ITEMS`` items or ``PASS_BYTES`` bytes is looked for in several passes.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = f"id {id_type}, item {item_type}, start_word long, n_words long, distance int, similarity double"
    out = None
    for shared in _passes(benchmark, cfg, item_col, item_text):
        part = per_batch(rows, _searcher(shared, benchmark.schema[item_col].dataType), schema)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start_word", "n_words", "distance", "similarity")


def without_leaks(docs: DataFrame, benchmark: DataFrame, cfg: Leaks = Leaks(), text: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, unchanged and in place."""
    schema = docs.schema
    for shared in _passes(benchmark, cfg, item_col, item_text):
        def work(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            column = batch.column(batch.schema.get_field_index(text))
            clean = np.ones(batch.num_rows, bool)
            for at, _, data, off in pieces(column, lower=True):
                for d, *_ in shared.value.search(Texts(data, off, LOOSE)):
                    clean[at + d] = False
            yield batch.filter(pa.array(clean))
        docs = per_batch(docs, work, schema)
    return docs


def _passes(benchmark: DataFrame, cfg: Leaks, item_col: str, item_text: str) -> Iterator:
    """Broadcast indexes of about ``PASS_ITEMS`` items or ``PASS_BYTES`` bytes at most."""
    if cfg.radius > 23:
        raise ValueError("the tables guarantee a radius of at most 23")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-size["n"] // PASS_ITEMS), -(-size["bytes"] // PASS_BYTES))
    for i in range(passes):
        some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i).orderBy("item", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([r["item"] for r in some], [r["text"] for r in some], cfg))


def _searcher(shared, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(item_type)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, _, data, off in pieces(batch.column(1), lower=True):
            found = list(shared.value.search(Texts(data, off, LOOSE)))
            if found:
                d, item, start, n, distance, score = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([at + x for x in d], pa.int64())), pa.array(item, arrow_type),
                     pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(distance, pa.int32()),
                     pa.array(score, pa.float64())],
                    names=["id", "item", "start_word", "n_words", "distance", "similarity"])
    return work
