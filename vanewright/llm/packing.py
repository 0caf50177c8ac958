"""Harmonic packing of token sequences.

A piece of length L belongs to class k = capacity // L, the largest number of such
pieces that a sequence holds; class k covers lengths above capacity / (k + 1) up to
capacity / k.  Every sequence of class k gets exactly k pieces, so workers fill
sequences without knowing of each other.

Documents may be cut.  A remainder that would leave more than ``waste`` tokens of its
share of a sequence unused is cut at the full length of the next class,
capacity // (k + 1), and the rest is classed anew; a document gets a few pieces.

Pieces of a class are dealt to workers by hash, each class to as many workers as its
count asks for, and are numbered there.  What does not fill a sequence, at most k - 1
pieces per worker, is pooled and dealt again to fewer workers, until every class has
one.  The last pool holds less than one sequence per class, a bound that depends on
the capacity alone; one task packs it, longest piece first.

Defined results: null and empty texts are documents of the end token alone; repeated
rows are packed separately; null ids are carried; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vanewright.llm.tables import held, stored
from vanewright.llm.textscan import blobs, bytes_at, hashed, mix, per_batch, pieces

#: Words in a worker's memory, about 55 bytes each, which it starts anew beyond them, and bytes of a
#: part beyond which those of its batch are not remembered.
KNOWN_WORDS = 600_000
LONGEST_WORD = 4096
#: Words that are encoded in a row.
TOGETHER = 5_000
#: Single bytes that are white space for the tokenizer or for Unicode, and first bytes of wider white space.
SPACED = np.zeros(256, bool)
SPACED[[*range(9, 14), *range(28, 33)]] = True
WIDE_LEAD = np.zeros(256, bool)
WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:!?")] = True
PLAIN = np.zeros(256, bool)
PLAIN[33:127] = True
#: What texts are cut at.
CUTTABLE = re.compile(r"\s|[A-Za-z][.,;:!?]")


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    waste: int = 16
    end_id: int = 1
    worker_rows: int = 4096

    def cut(self, n: int) -> list[int]:
        """Lengths of the pieces of a document of ``n`` tokens."""
        out = [self.capacity] * (n // self.capacity)
        n %= self.capacity
        while n:
            k = self.capacity // n
            if self.capacity // k - n <= self.waste:
                return [*out, n]
            out.append(self.capacity // (k + 1))
            n -= out[-1]
        return out


class Coder:
    """Token ids of whole texts, with a memory of words.

    The byte-level pattern never joins a character that is not white space with a
    space after it, nor a letter with a full stop, so a text can be cut there and the
    parts be encoded on their own.  Cuts are made only where the bytes around prove
    this; a part that is not cut is merely longer.

    With ``literal`` the text of a special token is coded like any other text; without it
    becomes that token, the library's default, which ``token_pieces`` follows.
    """

    def __init__(self, spec: str, literal: bool = True) -> None:
        # Tasks are the unit of parallel work; the library's threads would only hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = literal
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or CUTTABLE.search(t.content) for t in added.values()):
            raise ValueError("texts may be cut at or in an added token")
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of each token: its name has a character for each.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, i in vocabulary.items():
            self.sizes[i] = len(added[i].content.encode()) if i in added else len(name)
        self._forget()

    def _forget(self) -> None:
        """The memory: sorted keys of words, where their ids lie in ``store`` and their bytes in ``text``."""
        self.keys = np.zeros(0, np.uint64)
        self.place = self.size = self.begin = self.end = np.zeros(0, np.int32)
        self.store = np.zeros(0, np.uint32)
        self.text = np.zeros(0, np.uint8)

    def _keys(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, ...]:
        """A key of each part, which no other part of the batch or of the memory has: the hash, or
        where bytes show that it is taken, the next one.  Also the distinct keys, the first part of each, the key
        of each part, its place in the memory and whether it is there."""
        keys = hashed(data, starts, ends) ^ inner.astype(np.uint64)
        part, place, begin = bytes_at(data, starts, ends)
        count, length = np.diff(begin, append=len(part)), ends - starts
        while True:
            unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
            like = first[which]
            wrong = (length != length[like]) | (inner != inner[like])
            like = np.where(wrong, np.arange(len(keys)), like)
            if len(keys):
                wrong |= np.logical_or.reduceat(part != part[np.repeat(begin[like], count) + place], begin)
            at = np.searchsorted(self.keys, unique)
            old = np.zeros(len(unique), bool)
            if len(self.keys):
                old = self.keys[np.minimum(at, len(self.keys) - 1)] == unique
                known, mine = at[old], first[old]
                taken = self.end[known] - self.begin[known] != length[mine]
                known, mine = known[~taken], mine[~taken]
                if len(known):
                    held, where, start = bytes_at(self.text, self.begin[known].astype(np.int64), self.end[known].astype(np.int64))
                    there = np.repeat(begin[mine], np.diff(start, append=len(held))) + where
                    taken[~taken] = np.logical_or.reduceat(held != part[there], start)
                foreign = np.zeros(len(unique), bool)
                foreign[np.flatnonzero(old)[taken]] = True
                wrong |= foreign[which]
            if not wrong.any():
                return unique, first, which, at, old
            keys[wrong] = mix(keys[wrong] + np.uint64(1))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, body: bytes, starts: np.ndarray, ends: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the parts at the given places in a row, where each part's begin, and the number of each part's.
        Inner parts start at a cut and end before one, so they can be encoded together."""
        sizes = np.zeros(len(starts), np.int64)
        order, ids = [], []
        row = np.flatnonzero(inner)
        for lo in range(0, len(row), TOGETHER):
            some = row[lo:lo + TOGETHER]
            ids.append(self._ids(b"".join([body[a:b] for a, b in zip(starts[some], ends[some])]).decode()))
            till = np.searchsorted(np.cumsum(self.sizes[ids[-1]]), np.cumsum(ends[some] - starts[some])) + 1
            sizes[some] = np.diff(till, prepend=0)
            order.append(some)
        alone = np.flatnonzero(~inner)
        texts = [body[starts[i]:ends[i]].decode() for i in alone.tolist()]
        for i, e in zip(alone.tolist(), self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids.append(np.array(e.ids, np.uint32))
            sizes[i] = len(ids[-1])
        order = np.concatenate([*order, alone]).astype(np.int64)
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32)
        begin = np.zeros(len(starts), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat, begin, sizes

    @staticmethod
    def _cuts(data: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Places inside texts where a part may start: at a single space, before and after
        a single line break, and where punctuation follows a letter."""
        n = len(data)
        if n < 3:
            return np.zeros(0, np.int64)
        at = np.flatnonzero((data[1:n - 1] == 32) | (data[1:n - 1] == 10)) + 1
        before, after = data[at - 1], data[at + 1]
        wide = (at > 2) & (data[at - 3] >= 0xE1) & (data[at - 3] <= 0xE3) & (before >= 0x80)
        wide |= (at > 1) & (data[at - 2] == 0xC2) & ((before == 0x85) | (before == 0xA0))
        at = at[~(SPACED[before] | SPACED[after] | WIDE_LEAD[after] | wide | edge[at] | edge[at + 1])]
        line = at[data[at] == 10]
        stop = np.flatnonzero(LETTER[data[:-1]] & STOP[data[1:]]) + 1
        stop = stop[~edge[stop]]
        return np.concatenate([at, line + 1, stop])

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end_id``, and where each text's begin."""
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        cut = np.sort(np.concatenate([self._cuts(data, edge), off[:-1][np.diff(off) > 0]]))
        starts, ends = cut, np.append(cut[1:], n) if len(cut) else cut
        # Parts that can follow each other: they start with a space and end with no white space.
        inner = (data[starts] == 32) & ~edge[starts]
        inner &= (np.append(inner[1:], False) if len(cut) else inner) | PLAIN[data[ends - 1]]
        if len(self.keys) > KNOWN_WORDS:
            self._forget()
        unique, first, which, at, old = self._keys(data, starts, ends, inner)
        place, sizes = np.zeros(len(unique) + 1, np.int64), np.ones(len(unique) + 1, np.int64)
        place[:-1][old], sizes[:-1][old] = self.place[at[old]], self.size[at[old]]
        new = np.flatnonzero(~old)
        flat, begin, count = self._learn(data.tobytes(), starts[first[new]], ends[first[new]], inner[first[new]])
        place[new], sizes[new] = len(self.store) + begin, count
        store = np.concatenate([self.store, flat, np.array([end_id], np.uint32)])
        place[-1] = len(store) - 1  # the end token follows every text as a part of its own
        if (ends - starts).max(initial=0) <= LONGEST_WORD:
            self.keys = np.insert(self.keys, at[new], unique[new])
            self.place = np.insert(self.place, at[new], place[new]).astype(np.int32)
            self.size = np.insert(self.size, at[new], sizes[new]).astype(np.int32)
            self.store = store[:-1]
            a, n = starts[first[new]], (ends - starts)[first[new]]
            till = len(self.text) + np.cumsum(n)
            self.begin = np.insert(self.begin, at[new], till - n).astype(np.int32)
            self.end = np.insert(self.end, at[new], till).astype(np.int32)
            self.text = np.concatenate([self.text, data[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]])
        order = np.insert(which, np.searchsorted(starts, off[1:]), len(unique))
        lengths = sizes[order]
        till = np.cumsum(lengths)
        ids = store[np.repeat(place[order] - (till - lengths), lengths) + np.arange(till[-1] if len(till) else 0)]
        ended = np.searchsorted(starts, off[1:]) + np.arange(len(off) - 1)
        return ids, np.concatenate([[0], till[ended]])


@lru_cache(maxsize=2)
def _coder(spec: str) -> Coder:
    return Coder(spec, literal=False)


def token_pieces(docs: DataFrame, tokenizer: str, cfg: Packing = Packing(), id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(id_col, start, length, doc_tokens, ids): the cut documents, each ended by ``end_id``.

    ``tokenizer`` is the path of a tokenizer file on the driver; its content is sent
    along.  ``ids`` holds little-endian unsigned 32-bit integers.
    """
    spec = Path(tokenizer).read_text(encoding="utf-8")
    id_type = docs.schema[id_col].dataType.simpleString()
    tails = [cfg.cut(n) for n in range(cfg.capacity)]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, _, data, off in pieces(batch.column(1)):
            ids, begin = _coder(spec).encode(data, off, cfg.end_id)
            raw, held_ids = ids.tobytes(), []
            at, start, length, total = [], [], [], []
            for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                n, s = b - a, 0
                for size in [cfg.capacity] * (n // cfg.capacity) + tails[n % cfg.capacity]:
                    at.append(lo + i)
                    start.append(s)
                    length.append(size)
                    total.append(n)
                    held_ids.append(raw[4 * (a + s):4 * (a + s + size)])
                    s += size
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(total, pa.int64()), blobs(held_ids)], names=[id_col, "start", "length", "doc_tokens", "ids"])

    return per_batch(docs.select(F.col(id_col), F.col(text).alias("__text")), work,
                     f"`{id_col}` {id_type}, start long, length long, doc_tokens long, ids binary")


def _last_pool(cfg: Packing):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        """First fit, longest first."""
        pdf = pdf.sort_values(["length", "__spot"], ascending=[False, True], kind="stable")
        used: list[int] = []
        where, offset = [], []
        for n in pdf["length"]:
            b = next((i for i, u in enumerate(used) if u + n <= cfg.capacity), len(used))
            if b == len(used):
                used.append(0)
            where.append(b)
            offset.append(used[b])
            used[b] += n
        return pdf.assign(sequence_id=np.array(where, np.int64) + (15 << 58),
                          offset=np.array(offset, np.int64))[["__id", "sequence_id", "offset"]]
    return pack


def harmonic(pieces: DataFrame, cfg: Packing = Packing()) -> DataFrame:
    """``pieces`` (with ``start`` and ``length``, no longer than the capacity) and, for each,
    ``sequence_id`` and ``offset``.  Other columns stay with the kept pieces while these are numbered
    and are joined to the numbers at the end, so that ids are moved once."""
    if cfg.capacity >= 4096:
        raise ValueError("sequence ids hold classes up to 4095")
    names = pieces.columns
    kind = F.floor(F.lit(cfg.capacity) / F.col("length")).cast("long")
    # The number of a piece is fixed once the rows are kept, so that a lost task is repeated alike, and identical
    # pieces are dealt like others.
    whole = stored(pieces.withColumn("__id", F.monotonically_increasing_id()))
    level, pool = 0, held(whole.select("__id", "length", kind.alias("__k"), F.xxhash64("__id").alias("__spot")))
    counts = {r["__k"]: r["n"] for r in pool.groupBy("__k").agg(F.count(F.lit(1)).alias("n")).collect()}
    done = []
    while counts:
        # A worker takes several sequences' worth, so that each level pools far fewer pieces.
        workers = {k: -(-n // max(cfg.worker_rows, 4 * k)) for k, n in counts.items()}
        if max(workers.values()) >= 1 << 24:
            raise ValueError("raise worker_rows")
        of = F.create_map(*[F.lit(x).cast("long") for kn in workers.items() for x in kn])
        pool = pool.withColumn("__w", F.pmod(F.xxhash64("__spot", F.lit(level)), F.element_at(of, F.col("__k"))))
        mine = W.partitionBy("__k", "__w")
        pool = pool.withColumn("__n", F.count(F.lit(1)).over(mine)) \
                   .withColumn("__at", F.row_number().over(mine.orderBy("__spot")) - 1)
        pool = held(pool)
        full = F.col("__at") < F.col("__n") - F.col("__n") % F.col("__k")
        bin_ = F.floor(F.col("__at") / F.col("__k")).cast("long")
        ready = pool.where(full).withColumn("__bin", bin_)
        before = W.partitionBy("__k", "__w", "__bin").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
        name = (F.lit(level << 58).cast("long") + F.shiftleft("__k", 46) + F.shiftleft("__w", 22) + F.col("__bin"))
        done.append(ready.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
                         .withColumn("sequence_id", name).select("__id", "sequence_id", "offset"))
        pool = pool.where(~full).drop("__n", "__at", "__w")
        if max(workers.values()) == 1:
            break
        # At most k - 1 pieces are left by each worker.
        counts = {k: w * (k - 1) for k, w in workers.items() if k > 1}
        level += 1
    rest = pool.select("__id", "length", "__spot").withColumn("__one", F.lit(1))
    out = rest.groupBy("__one").applyInPandas(_last_pool(cfg), "__id long, sequence_id long, offset long")
    for part in done:
        out = out.unionByName(part)
    return whole.join(out, "__id").select(*[F.col(f"`{c}`") for c in names], "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of each sequence put together, unpadded.
    Pieces must carry their ``ids``; a sequence is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
