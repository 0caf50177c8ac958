"""Toxicity by a weighted lexicon and an Aho-Corasick automaton.

Texts are folded first: compatibility forms, lower case, homoglyphs of Latin letters,
digits and signs that stand for letters inside a word, invisible characters; whatever
is no letter or digit then is one space.  The lexicon holds words and beginnings of
words with their boundaries.  At each word the heaviest entry that matches counts
once, unless an exception phrase covers it.  The sum, its density by the square root
of the length, and the heaviest match enter a logistic score.

The lexicon, the exception phrases and the score are learned from at most ``sample``
labelled rows, those of the smallest hash of their id.  All texts are scored whole.

Defined results: null, empty and wordless texts get the score of a text without
matches; without labelled rows of both classes every score is 0.5; repeated rows are
scored alike; null ids are carried and never labelled; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held
from vanewright.llm.textscan import per_batch

# Characters that look like Latin letters, and digits and signs written for letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕһԁԛԝвнкмтαεοιρτυχκνβηγ", "aeopcyxijshdqwbhkmtaeoiptuxkvbny"))
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_glyphs = str.maketrans(HOMOGLYPHS)
_inside = re.compile(r"(?<=[^\W\d_])[013457@$!|8]+(?=[^\W\d_])|(?<![\w@$!|])[013457@$8](?=[^\W\d_])")
_hidden = re.compile("[­​-‏⁠﻿]")
_apart = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded words, each between single spaces; a text without words is one space."""
    text = _hidden.sub("", unicodedata.normalize("NFKC", text or "").lower())
    if not text.isascii():
        text = text.translate(_glyphs)
    text = _inside.sub(lambda m: "".join(STAND_INS[c] for c in m.group()), text)
    words = _apart.sub(" ", text).strip()
    return f" {words} " if words else " "


@dataclass(frozen=True)
class Learning:
    sample: int = 12_000
    least_toxic: int = 3
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8)
    least_weight: float = 2.0
    exceptions: int = 5


@dataclass
class Lexicon:
    """Weights of entries, phrases that excuse what they cover, and the logistic score."""

    weights: dict[str, float] = field(default_factory=dict)
    excused: list[str] = field(default_factory=list)
    coefficients: list[float] = field(default_factory=lambda: [0.0] * 4)

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for phrase in self.excused:
            out.add_word(phrase, (len(phrase), None))
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), weight))
        out.make_automaton()
        return out


def matches(automaton: ahocorasick.Automaton, folded: str) -> dict[int, float]:
    """Heaviest entry by the place of its first space, without excused ones."""
    found: dict[int, float] = {}
    covers = []
    if len(automaton):
        for last, (size, weight) in automaton.iter(folded):
            at = last - size + 1
            if weight is None:
                covers.append((at, last))
            else:
                found[at] = max(weight, found.get(at, weight))
    for a, b in covers:
        for at in [x for x in found if a <= x < b]:
            del found[at]
    return found


def features(found: dict[int, float], folded: str) -> list[float]:
    total = sum(found.values())
    n = max(1, folded.count(" ") - 1)
    return [1.0, math.log1p(total), total / math.sqrt(n), max(found.values(), default=0.0)]


def _terms(folded: str, cfg: Learning) -> set[str]:
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(" " + w[:n] for n in cfg.beginnings if len(w) > n)
    return out


def _count(rows: DataFrame, terms_of) -> DataFrame:
    """(term, toxic, n): documents of each class that hold a term, summed per batch first."""
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n[toxic].update(terms_of(text))
        for toxic in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n[toxic]), pa.string()), pa.array([toxic] * len(n[toxic]), pa.int32()),
                 pa.array(list(n[toxic].values()), pa.int64())], names=["term", "toxic", "n"])

    counted = per_batch(rows.select("folded", "toxic"), work, "term string, toxic int, n long")
    return counted.groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("pos"),
                                       F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("neg"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps; classes weigh as they are."""
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return b


def _folded(docs: DataFrame, *columns: str) -> DataFrame:
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        folded = pa.array([fold(t.as_py()) for t in batch.column(0)], pa.string())
        yield pa.RecordBatch.from_arrays([folded, *batch.columns[1:]], names=["folded", *columns])

    return per_batch(docs.select("text", *columns), work, f"folded string, {kinds}")


def learn(docs: DataFrame, labels: DataFrame, cfg: Learning = Learning(), id_col: str = "doc_id", text: str = "text") -> Lexicon:
    """From documents and labels (id_col, toxic 0/1): a bounded sample is counted in tasks;
    the driver gets entries above the limits and a few numbers per sampled row.

    Labels are sampled before they meet the documents: the smallest hashes of their ids,
    at most ``sample`` rows, which are broadcast, so no text is shuffled to find them.
    A document with several labels takes the larger; of documents that share an id one, that of the
    smallest hash of its text, is learned from, so that the sample bounds what the driver gets.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(id_col) \
                   .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = held(chosen.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(cfg.sample))
    rows = docs.select(id_col, F.col(text).alias("text")).join(F.broadcast(chosen), id_col)
    rows = rows.groupBy(id_col).agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")
    rows = held(_folded(rows, "toxic"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Lexicon()
    wanted = max(cfg.least_toxic, n[1] // 500)
    listed = _count(rows.where("toxic = 1"), lambda t: _terms(t, cfg)).where(F.col("pos") >= wanted).select("term").collect()
    seen = Lexicon({r["term"]: 0.0 for r in listed})

    def held_terms(folded: str, lexicon=seen, box=[]) -> set[str]:  # noqa: B006  one automaton per task
        if not box:
            box.append(ahocorasick.Automaton())
            for term in lexicon.weights:
                box[0].add_word(term, term)
            box[0].make_automaton()
        return {term for _, term in box[0].iter(folded)} if len(box[0]) else set()

    weights = {}
    for r in _count(rows, held_terms).collect():
        odds = math.log((r["pos"] + 0.5) / (n[1] - r["pos"] + 0.5)) - math.log((r["neg"] + 0.5) / (n[0] - r["neg"] + 0.5))
        if odds >= cfg.least_weight:
            weights[r["term"]] = odds
    lexicon = Lexicon(weights)
    lexicon.excused = [r["term"] for r in _count(rows, _phrases(lexicon)).where(
        (F.col("neg") >= cfg.exceptions) & (F.col("pos") == 0)).collect()]
    points = rows.select("folded", "toxic")
    table = per_batch(points, _measured(lexicon), "toxic int, f array<double>").toArrow()
    x = np.array(table.column("f").to_pylist(), float).reshape(-1, 4)
    lexicon.coefficients = _logistic(x, np.array(table.column("toxic").to_pylist(), float)).tolist()
    return lexicon


def _phrases(lexicon: Lexicon):
    """Matches with the word before or after them."""
    box: list = []

    def of(folded: str) -> set[str]:
        if not box:
            box.append(lexicon.automaton())
        out = set()
        for at in matches(box[0], folded):
            end = folded.index(" ", at + 1)
            after = folded.find(" ", end + 1)
            before = folded.rfind(" ", 0, at)
            if after > 0:
                out.add(folded[at:after + 1])
            if before >= 0:
                out.add(folded[before:end + 1])
        return out
    return of


def _measured(lexicon: Lexicon):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        rows = [features(matches(automaton, t), t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "f"])
    return work


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, score, n_matches) for every row, and the columns to carry."""
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *carry))
    weights = np.array(lexicon.coefficients)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows, n = [], []
            for t in batch.column(0):
                folded = fold(t.as_py())
                found = matches(automaton, folded)
                rows.append(features(found, folded))
                n.append(len(found))
            p = 1 / (1 + np.exp(-np.clip(np.array(rows).reshape(-1, 4) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n, pa.int64()), *batch.columns[1:]],
                                             names=["score", "n_matches", id_col, *carry])

    rows = docs.select(F.col(text).alias("__text"), id_col, *carry)
    return rows.mapInArrow(work, f"score double, n_matches long{kinds}").select(id_col, "score", "n_matches", *carry)
