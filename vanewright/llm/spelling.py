"""Spelling variants by Bloom-guided neighbourhoods.

1. Words are counted over all texts.  Those of at least ``least_size`` code points and
   ``least_count`` occurrences are the vocabulary.
2. A blocked Bloom filter per word length is built from the vocabulary by partial bit-wise
   aggregation and broadcast.  It takes two bytes a word; a vocabulary whose filters exceed
   ``filter_bytes`` is searched in several passes, each with the filters of one
   part of the keys, so what is broadcast has a bound and nothing is left out.
3. Every word's edits are generated as hashes: all deletions, which find the shorter of two words,
   and all replacements by a later letter, so that each pair is found from one side.  A hash
   of an edit takes constant time whatever the word's length.
4. Only edits that the filter of their length may hold are shuffled, as hashes, to an exact join with the
   vocabulary; the two words themselves are compared last, so neither false positives of
   the filter nor equal hashes of different words survive.
5. A word's form is its most frequent near word, if frequent enough; forms are followed to
   their last by pointer jumping, as counts grow along them at least by ``ratio``.

Defined results: null and empty texts have no words; repeated rows count again; a null id enters
the noise of ``noisy_words`` as an empty text; other columns are ignored; words of any length are compared whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held
from vanewright.llm.textscan import mix

#: Runs of letters of texts whose A-Z are lower-cased.
LETTERS = re.compile("[a-zÀ-ÿ]+")
#: All letters that such words can hold.
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Words that a task counts before it hands them on.
COUNTED = 200_000
LANES = 8
BLOCK_BYTES = 4 * LANES
WORDS_PER_BLOCK = 16
#: Edits probed at once.
PROBES = 1 << 20


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, m, 1 << 64))])


#: Edits need a sum that can be changed at one place.  Equal sums of different words cost a comparison, no wrong result.
LETTER_POWERS = Powers(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Variants:
    least_size: int = 6
    least_count: int = 5
    ratio: int = 5
    filter_bytes: int = 16 << 20
    alphabet: tuple[int, ...] = tuple(ALPHABET)


def noisy_words(doc_id: object, text: str, every: int = 199, least: int = 6) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of the words of a text that have ``least`` code points; where ``every`` divides the CRC-32 h of
    ``<doc_id>:<word>``, the word's code point h % length is deleted first.  Only A-Z are lower-cased."""
    mark = b"%s:" % ("" if doc_id is None else str(doc_id)).encode()
    for word, n in Counter(LETTERS.findall(text.encode().lower().decode())).items():
        size = len(word)
        if size < least:
            continue
        h = zlib.crc32(mark + word.encode())
        if h % every:
            yield word, n
        elif size > least:
            at = h % size
            yield word[:at] + word[at + 1:], n


def count_words(docs: DataFrame, words: Callable[[object, str], Iterator[tuple[str, int]]], id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(word, n) over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(len(batch)):
                for word, n in words(ids[i].as_py(), texts[i].as_py()):
                    found[word] += n
                if len(found) > COUNTED:
                    yield table()
                    found.clear()
        if found:
            yield table()

    rows = docs.where(F.length(text) > 0).select(id_col, text)
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_values(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64), 0x7F4A7C15) | np.uint64(1)


def _prefixes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of one length as a matrix, and the sums of their values at each place."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    LETTER_POWERS.upto(codes.shape[1] + 1)
    sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(letter_values(codes) * LETTER_POWERS.up[:codes.shape[1]], axis=1, out=sums[:, 1:])
    return codes, sums


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def _with_keys(vocabulary: DataFrame) -> DataFrame:
    """Add ``size`` and ``key``, the hash of the word."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            size, key = np.zeros(len(words), np.int32), np.zeros(len(words), np.uint64)
            for n, rows in _by_length(words):
                size[rows], key[rows] = n, mix(_prefixes([words[i] for i in rows])[1][:, -1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size), pa.array(key.view(np.int64))], names=["word", "n", "size", "key"])

    return vocabulary.select("word", "n").mapInArrow(work, "word string, n long, size int, key long")


def _spots(key: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and a word of bits that choose one bit in each of its lanes."""
    block = ((key >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), mix(key, 0x5851F42D4C957F2D)


def _lane(bits: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((bits >> np.uint64(8 * lane)) & np.uint64(31)).astype(np.uint32)


def _part(key: np.ndarray, passes: int) -> np.ndarray:
    return mix(key, 0x14057B7EF767814F) % np.uint64(passes)


def _filters(vocabulary: DataFrame, sizes: dict[int, int], passes: int, part: int) -> dict[int, np.ndarray]:
    """Blocked Bloom filters by word length of one part of the keys: at most ``filter_bytes`` in all, and a block a length."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, key = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            mine = _part(key, passes) == part
            size, key = size[mine], key[mine]
            for n in np.unique(size):
                block, bits = _spots(key[size == n], sizes[int(n)])
                lanes = [pa.array(_lane(bits, i).view(np.int32)) for i in range(LANES)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), n)), pa.array(block), *lanes],
                                                 names=["size", "block", *[f"b{i}" for i in range(LANES)]])

    lanes = [f"b{i}" for i in range(LANES)]
    bits = vocabulary.select("size", "key").mapInArrow(work, "size int, block long, " + ", ".join(f"{x} int" for x in lanes))
    found = bits.groupBy("size", "block").agg(*[F.expr(f"bit_or({x})").alias(x) for x in lanes]).toArrow()
    out = {n: np.zeros((blocks, LANES), np.uint32) for n, blocks in sizes.items()}
    size, block = found.column("size").to_numpy(), found.column("block").to_numpy()
    values = np.stack([found.column(x).to_numpy() for x in lanes], axis=1).astype(np.int32).view(np.uint32) if len(size) else None
    for n in np.unique(size):
        rows = size == n
        out[int(n)][block[rows]] = values[rows]
    return out


def may_hold(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of the keys that the filter may hold."""
    block, bits = _spots(key, len(table))
    at = np.flatnonzero(table[block, 0] & _lane(bits, 0))
    for lane in range(1, LANES):
        at = at[(table[block[at], lane] & _lane(bits[at], lane)) > 0]
    return at


def edits(codes: np.ndarray, sums: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row, key) of the deletions and of the replacements by later letters of words of one length."""
    n, size = codes.shape
    whole, inverse = sums[:, -1:], LETTER_POWERS.down[1]
    letters, values = np.sort(alphabet), letter_values(np.sort(alphabet))
    step = max(1, PROBES // (n * len(alphabet)))
    rows = np.arange(n)
    for at in range(0, size, step):
        to = min(size, at + step)
        here = codes[:, at:to]
        if size > 1:
            key = sums[:, at:to] + (whole - sums[:, at + 1:to + 1]) * inverse
            fresh = np.ones(here.shape, bool)  # one of the deletions in a run of equal letters
            fresh[:, 1 if at == 0 else 0:] = here[:, 1 if at == 0 else 0:] != codes[:, max(at - 1, 0):to - 1]
            yield size - 1, np.nonzero(fresh)[0], mix(key[fresh])
        later = letters > here[:, :, None]
        place, letter = np.broadcast_to(np.arange(at, to)[:, None], later.shape)[later], np.broadcast_to(np.arange(len(letters)), later.shape)[later]
        row = np.broadcast_to(rows[:, None, None], later.shape)[later]
        key = sums[row, -1] + (values[letter] - letter_values(codes[row, place])) * LETTER_POWERS.up[place]
        yield size, row, mix(key)


def _candidates(vocabulary: DataFrame, filters: dict[int, np.ndarray], passes: int, part: int, alphabet: tuple[int, ...]) -> DataFrame:
    """(a_size, a_key, b_size, b_key): words and those of their edits that pass the filters."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filters)
    letters = np.array(alphabet, np.uint32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            for size, rows in _by_length(words):
                most = max(1, PROBES // (size * len(letters)))
                for at in range(0, len(rows), most):
                    codes, sums = _prefixes([words[i] for i in rows[at:at + most]])
                    own = mix(sums[:, -1])
                    for n, row, key in edits(codes, sums, letters):
                        if n not in tables or not len(key):
                            continue
                        if passes > 1:
                            mine = _part(key, passes) == part
                            row, key = row[mine], key[mine]
                        hit = may_hold(tables[n], key)
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(hit), size, np.int32)), pa.array(own[row[hit]].view(np.int64)),
                                 pa.array(np.full(len(hit), n, np.int32)), pa.array(key[hit].view(np.int64))],
                                names=["a_size", "a_key", "b_size", "b_key"])

    return vocabulary.select("word").mapInArrow(work, "a_size int, a_key long, b_size int, b_key long")


def near_words(vocabulary: DataFrame, cfg: Variants = Variants()) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of the words of (word, n, size, key) at an edit distance of one, each once."""
    counts = {r["size"]: r["n"] for r in vocabulary.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {n: 1 + c // WORDS_PER_BLOCK for n, c in counts.items()}
    passes = max(1, -(-sum(blocks.values()) * BLOCK_BYTES // cfg.filter_bytes))
    sizes = {n: 1 + b // passes for n, b in blocks.items()}
    found = None
    for part in range(passes):
        filters = _filters(vocabulary, sizes, passes, part)
        some = held(_candidates(vocabulary, filters, passes, part, cfg.alphabet))
        found = some if found is None else found.unionByName(some)
    side = {x: vocabulary.select(F.col("size").alias(f"{x}_size"), F.col("key").alias(f"{x}_key"), F.col("word").alias(x), F.col("n").alias(f"{x}_n"))
            for x in "ab"}
    both = found.join(side["b"], ["b_size", "b_key"]).join(side["a"], ["a_size", "a_key"])
    return both.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form that is reached from each word."""
    root = held(forms.select("word", F.col("form").alias("root")))
    while True:
        up = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = held(root.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        root = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return root


def group_variants(counts: DataFrame, cfg: Variants = Variants()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the vocabulary of (word, n)."""
    chosen = counts.where((F.length("word") >= cfg.least_size) & (F.col("n") >= cfg.least_count))
    vocabulary = held(_with_keys(chosen))
    links = held(near_words(vocabulary, cfg))
    both = links.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")) \
                .unionByName(links.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = held(vocabulary.select("word", "n").join(near, "word", "left"))
    enough = -F.col("best.less") >= cfg.ratio * F.col("n")
    out = joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    roots = follow(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, cfg: Variants = Variants(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``group_variants`` of the words of all texts, with the noise of ``noisy_words``."""
    least = cfg.least_size
    return group_variants(count_words(docs, lambda i, t: noisy_words(i, t, least=least), id_col, text), cfg)
