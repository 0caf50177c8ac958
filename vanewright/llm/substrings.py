"""Repeated passages by seed and extend over winnowed anchors.

1. Seeds.  Each text's runs of ``seed`` words are winnowed: of the runs in any window
   of ``length`` words the one with the smallest hash is an anchor, so equal windows
   have equal anchors.  Equal texts are one class from here on.
2. Anchors are joined on their hash; one that occurs once cannot lie in a repeat.
3. Extend.  An anchor that does recur is extended to the left and right by every offset
   at which it is the anchor of a window of ``length`` words.  An extension is
   confirmed when the hash of all its words occurs anywhere else.  So extension costs
   a row per offset, not per pair of occurrences, however many documents share an
   anchor.
4. Overlapping confirmed windows are merged into maximal spans.

Windows are compared by 128 bits of hash (two independent ones), taken over
whole words.  Defined results: null and empty texts have no words and no span;
equal texts of at least ``length`` words repeat each other in full, also when the
rows are equal in every column; null ids are carried as they are; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held, small_side
from vanewright.llm.textscan import Texts, blobs, per_batch, pieces, runs

CHECK = 0x2545F4914F6CDD1D
NOTHING = np.uint64(0)
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Repeats:
    length: int = 50
    seed: int = 12

    @property
    def reach(self) -> int:
        """Seeds in a window."""
        return self.length - self.seed + 1


def _sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over every run of ``width`` values, by doubling."""
    n, out = 1, x
    while 2 * n <= width:
        out, n = op(out[:-n], out[n:]), 2 * n
    m = len(x) - width + 1
    return op(out[:m], out[width - n:width - n + m])


def anchors(texts: Texts, words: np.ndarray, cfg: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed hash at each word, whether winnowing picks it, and the anchor of the window
    that starts there (0: no window)."""
    room = texts.room()
    seeds = np.full(len(words), LAST)
    found = runs(words, cfg.seed)
    seeds[:len(found)] = found
    seeds[room < cfg.seed] = LAST
    if len(words) < cfg.length:
        return seeds, np.zeros(len(words), bool), np.zeros(len(words), np.uint64)
    low = _sliding(seeds, cfg.reach, np.minimum)
    low = np.where(room[:len(low)] >= cfg.length, low, NOTHING)
    edge = np.zeros(cfg.reach - 1, np.uint64)
    high = _sliding(np.concatenate([edge, low, edge]), cfg.reach, np.maximum)[:len(words)]
    own = np.zeros(len(words), np.uint64)
    own[:len(low)] = low
    return seeds, (high == seeds) & (room >= cfg.seed) & (high > NOTHING), own


def _with_class(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), body.alias("text"), F.xxhash64(body).alias("k1"),
                       F.xxhash64(F.lit(1), body).alias("k2"))


def _scan(rows: DataFrame, cfg: Repeats) -> DataFrame:
    """(id, k1, k2, n_words, whole, anchors); ``whole`` is the digest of all words.  An
    anchor that occurs twice in its text is listed twice."""
    id_type = rows.schema["id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, data, off in pieces(batch.column(1)):
            texts = Texts(data, off)
            seeds, picked, _ = anchors(texts, texts.word_hashes(), cfg)
            lists, whole = [], []
            body = data.tobytes()
            for i, (a, b) in enumerate(zip(texts.first[:-1], texts.first[1:])):
                own, n = np.unique(seeds[a:b][picked[a:b]], return_counts=True)
                lists.append(np.concatenate([own, own[n > 1]]).view(np.int64))
                whole.append(hashlib.sha256(b" ".join(body[off[i]:off[i + 1]].split())).digest())
            yield pa.RecordBatch.from_arrays(
                [c.slice(at, to - at) for c in (batch.column(0), batch.column(2), batch.column(3))]
                + [pa.array(np.diff(texts.first), pa.int64()), blobs(whole), pa.array(lists, pa.list_(pa.int64()))],
                names=["id", "k1", "k2", "n_words", "whole", "anchors"])

    return per_batch(rows.select("id", "text", "k1", "k2"), work,
                     f"id {id_type}, k1 long, k2 long, n_words long, whole binary, anchors array<long>")


def _local(words: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Which windows of one text occur twice in it."""
    order = np.lexsort((check, words))
    same = (words[order][1:] == words[order][:-1]) & (check[order][1:] == check[order][:-1])
    twice = np.zeros(len(words), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return twice


def _hashes(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    return (runs(texts.word_hashes(), length), runs(texts.word_hashes(CHECK), length, CHECK).view(np.int64))


def _extensions(rows: DataFrame, cfg: Repeats) -> DataFrame:
    """(k1, k2, at, h1, h2, weight) of the candidate windows; one row for windows that
    are equal in a text.  weight: 1 once in its text, 2 more often or in copies."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, data, off in pieces(batch.column(0)):
            texts = Texts(data, off)
            _, _, own = anchors(texts, texts.word_hashes(), cfg)
            h1, h2 = _hashes(texts, cfg.length)
            out = []
            for i, (a, b) in enumerate(zip(texts.first[:-1], texts.first[1:])):
                n = int(b - a) - cfg.length + 1
                if n <= 0:
                    continue
                again = np.asarray(batch.column(3)[at + i].values, np.int64).view(np.uint64)
                where = np.flatnonzero(np.isin(own[a:a + n], again))
                x, y = h1[a + where], h2[a + where]
                twice = _local(x, y)
                keep = ~twice
                if twice.any():
                    keep[np.flatnonzero(twice)[np.unique(x[twice], return_index=True)[1]]] = True
                weight = np.where(twice | bool(batch.column(4)[at + i].as_py()), 2, 1)
                k1, k2 = batch.column(1)[at + i].as_py(), batch.column(2)[at + i].as_py()
                m = int(keep.sum())
                out.append((np.full(m, k1), np.full(m, k2), where[keep], x[keep].view(np.int64), y[keep], weight[keep]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(t)) for c, t in zip(zip(*out), ("i8", "i8", "i4", "i8", "i8", "i4"))],
                    names=["k1", "k2", "at", "h1", "h2", "weight"])

    return per_batch(rows.select("text", "k1", "k2", "anchors", F.col("n_docs") > 1), work,
                     "k1 long, k2 long, at int, h1 long, h2 long, weight int")


def find_repeats(docs: DataFrame, cfg: Repeats = Repeats(), id_col: str = "doc_id",
                 text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: a row per row of ``docs`` (id, k1, k2, n_words, whole); the classes of
    equal texts (k1, k2, n_docs, least); and for classes with a repeat that is not the
    whole text the confirmed windows (k1, k2, at), which leave out windows that occur twice in one text."""
    rows = _with_class(docs, id_col, text)
    scanned = held(_scan(rows, cfg))
    classes = scanned.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("id").alias("least"),
                                              F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors"))
    classes = held(classes.where(F.col("n_words") >= cfg.length))
    seeds = classes.select("k1", "k2", "n_docs", F.explode("anchors").alias("seed"))
    recurring = seeds.groupBy("seed").agg(F.sum("n_docs").alias("n")).where("n > 1").select("seed")
    # The second listing of an anchor is no longer needed once it is known to recur.
    hit = seeds.join(recurring, "seed").groupBy("k1", "k2").agg(F.collect_list("seed").alias("anchors"))
    hit = held(hit.join(classes.select("k1", "k2", "n_docs", "least"), ["k1", "k2"]))
    chosen = _rows_of(rows, hit, "anchors", "n_docs")
    windows = _extensions(chosen, cfg)
    twice = windows.groupBy("h1", "h2").agg(F.sum("weight").alias("n")).where("n > 1").select("h1", "h2")
    single = windows.where("weight = 1").select("k1", "k2", "at", "h1", "h2").join(twice, ["h1", "h2"]).select("k1", "k2", "at")
    inner = windows.where("weight = 2").select("k1", "k2").distinct().select("k1", "k2", F.lit(None).cast("int").alias("at"))
    found = single.unionByName(inner).groupBy("k1", "k2").agg(F.collect_list("at").alias("at"))
    found = found.join(classes.where("n_docs = 1").select("k1", "k2", "least"), ["k1", "k2"])
    return scanned.select("id", "k1", "k2", "n_words", "whole"), classes.select("k1", "k2", "n_docs", "least"), held(found)


def _rows_of(rows: DataFrame, classes: DataFrame, *carry: str) -> DataFrame:
    """One text per class (more only where rows share an id as well), with columns of
    the class.  The filter on class keys is broadcast if it is small, so that only texts
    that are needed are shuffled."""
    keys = ["k1", "k2"]
    wanted = small_side(classes.select(*keys), 16)
    rows = rows.join(wanted, keys, "left_semi")
    side = classes.select(*keys, F.col("least"), *carry)
    return rows.join(side, keys).where(F.col("id").eqNullSafe(F.col("least"))).select("text", *keys, *carry)


def _covered(n: int, at: np.ndarray, length: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    steps[at] += 1
    np.subtract.at(steps, np.minimum(at + length, n), 1)
    return np.cumsum(steps[:n]) > 0


def _spans(rows: DataFrame, cfg: Repeats) -> DataFrame:
    """(k1, k2, spans, n_removed, kept) of the texts with confirmed windows."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, data, off in pieces(batch.column(0)):
            texts = Texts(data, off)
            h1, h2 = _hashes(texts, cfg.length)
            body = data.tobytes()
            spans, removed, kept = [], [], []
            for i, (a, b) in enumerate(zip(texts.first[:-1], texts.first[1:])):
                n = int(b - a) - cfg.length + 1
                inner = np.flatnonzero(_local(h1[a:a + n], h2[a:a + n]))
                gone = _covered(int(b - a), np.union1d(inner, np.asarray(batch.column(3)[at + i].values, np.int64)), cfg.length)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                removed.append(int(gone.sum()))
                left = np.flatnonzero(~gone) + a
                kept.append(b" ".join(body[s:e] for s, e in zip(texts.starts[left], texts.ends[left])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(at, to - at), batch.column(2).slice(at, to - at), pa.array(spans, span),
                 pa.array(removed, pa.int64()), blobs(kept)], names=["k1", "k2", "spans", "n_removed", "kept"])

    return per_batch(rows.select("text", "k1", "k2", "at"), work, "k1 long, k2 long, "
                     "spans array<struct<start:bigint,end:bigint>>, n_removed long, kept binary")


def repeats(docs: DataFrame, cfg: Repeats = Repeats(), id_col: str = "doc_id", text: str = "text",
            kept: Callable[[Column], Column] = lambda words: words) -> DataFrame:
    """(id_col, n_words, spans, n_removed, whole, kept) per row: maximal repeated spans in
    words, end exclusive.  ``whole`` is the SHA-256 of all words joined by a space.
    ``kept`` are the words that are left, joined likewise, as UTF-8 bytes; null where
    nothing is removed, since the text is left as it is.  The function ``kept`` may turn
    them into something shorter, such as a digest, before anything is shuffled."""
    rows = _with_class(docs, id_col, text)
    scanned, classes, found = find_repeats(docs, cfg, id_col, text)
    part = _spans(_rows_of(rows, found, "at"), cfg)
    part = part.select("k1", "k2", "spans", "n_removed", kept(F.col("kept")).alias("kept"))
    part = part.dropDuplicates(["k1", "k2"]).withColumn("copied", F.lit(False))
    copies = classes.where("n_docs > 1").select("k1", "k2", F.lit(True).alias("copied"))
    # Windows are confirmed one by one only in texts without copies, so a class is in one of the two.
    of_class = held(part.unionByName(copies, allowMissingColumns=True))
    out = scanned.join(of_class, ["k1", "k2"], "left")
    copied = F.coalesce(F.col("copied"), F.lit(False))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole_span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    nothing_left = kept(F.lit("").cast("binary"))
    return out.select(F.col("id").alias(id_col), "n_words",
                      F.when(copied, whole_span).otherwise(F.coalesce("spans", none)).alias("spans"),
                      F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      "whole", F.when(copied, nothing_left).otherwise(F.col("kept")).alias("kept"))
