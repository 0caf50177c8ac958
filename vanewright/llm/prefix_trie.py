"""Prefix trie of conversations, built as a burst trie.

1. A turn is a unit of 20 bytes: 128 bits of SHA-256 over role and text, and the code
   points of the text.  A conversation is the row of its units, 20 bytes a turn; equal
   conversations are one path from here on, with their number, smallest id and the digest
   of their ids.  That digest is made from runs of sorted ids, so a path that a third of
   all conversations share is sorted by many tasks and streamed by one, never held.
2. Suffix containers.  A container holds the paths below one trie head; at first there
   is one, below the root.  A container above ``Burst.rows`` or ``Burst.bytes`` bursts:
   what all its paths share (the common prefix of its least and greatest path, both
   partial aggregates) becomes a chain of nodes, and the next turn id makes the heads of
   the smaller containers.
3. The remaining containers are dealt by head, sorted, and swept: a stack holds the nodes
   on the current path, and a node is complete when a path leaves it.
4. Totals of the containers roll up through the burst heads, one round per level of heads.

Defined results: rows without a conversation id are left out; a null role or text is
empty; turns of equal number (null first) follow each other by the SHA-256 of role and text;
repeated turns stay; other columns are ignored; an empty table has no nodes.  A conversation
has to fit a row (20 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import held, small_side, stored

UNIT = 20
DIGEST = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Characters of ids in one run of a path's sorted ids.
RUN_CHARS = 32 << 10
FLUSH_ROWS = 10_000

ROWS = "head string, parent string, depth long, unit binary, path binary, n long, least {id}, ends string"
NODES = ("head string, parent string, top boolean, depth long, conv_id {id}, parent_conv_id {id}, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, turn_id string")


@dataclass(frozen=True)
class Burst:
    """The most paths and bytes that a container keeps."""
    rows: int = 4096
    bytes: int = 4 << 20


def turn_units(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, units): the hexadecimal units of each conversation in order."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    size = F.lpad(F.lower(F.hex(F.length(said).cast("long"))), 2 * (UNIT - DIGEST), "0")
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("turn"), digest.alias("digest"),
        F.concat(F.substring(digest, 1, 2 * DIGEST), size).alias("unit"))
    zero = F.coalesce("turn", F.lit(0).cast(turns.schema[turn].dataType))
    whole = F.array_sort(F.collect_list(F.struct("numbered", zero.alias("turn"), "digest", "unit")))
    return rows.groupBy("conv_id").agg(whole.alias("rows")).select("conv_id", F.transform("rows", lambda x: x["unit"]).alias("units"))


def turn_texts(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(turn_id, role, text) of every distinct turn, to read the nodes by."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    return turns.select(F.substring(digest, 1, 2 * DIGEST).alias("turn_id"), who.alias("role"), said.alias("text")) \
                .dropDuplicates(["turn_id"])


def share_heads(units: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin with the first h turns of conversation c - c % every, and go on
    with their own turns after the first h; h = crc32(c as text) % most.  Numeric ids only."""
    c = F.col("conv_id")
    heads = units.where(c % every == 0).select(c.alias("of"), F.slice("units", 1, most - 1).alias("shared"))
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    rows = units.withColumns({"of": c - c % every, "h": h}).join(heads, "of", "left")
    begin = F.when(F.col("h") > 0, F.slice(F.coalesce("shared", F.array().cast("array<string>")), 1, F.greatest("h", F.lit(1)))) \
             .otherwise(F.array().cast("array<string>"))
    rest = F.slice("units", F.col("h") + 1, F.greatest(F.size("units") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(begin, rest).alias("units"))


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to runs (key, first, n, ids)."""
    key, first, ids, size = None, None, [], 0

    def run() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([first], kind), pa.array([len(ids)], pa.int64()),
                                           pa.array([",".join(ids)])], names=["key", "first", "n", "ids"])

    for batch in batches:
        kind = batch.schema.field(1).type
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key is not None and (k != key or size > RUN_CHARS):
                yield run()
                ids, size, key = [], 0, None
            if key is None:
                key, first = k, c
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if key is not None:
        yield run()


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs to (key, n, least, ends) of each key."""
    key, least, n, digest, kind = None, None, 0, None, None
    out: list[tuple] = []

    def table() -> pa.RecordBatch:
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], kind), pa.array(cols[3])],
                                          names=["key", "n", "least", "ends"])

    for batch in batches:
        kind = batch.schema.field(1).type
        for k, first, count, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if k != key:
                if key is not None:
                    out.append((key, n, least, digest.hexdigest()))
                key, least, n, digest = k, first, 0, hashlib.sha256()
            digest.update((ids if n == 0 else "," + ids).encode())
            n += count
        if len(out) > FLUSH_ROWS:
            yield table()
            out = []
    if key is not None:
        out.append((key, n, least, digest.hexdigest()))
        yield table()


def _paths(units: DataFrame) -> DataFrame:
    """(path, n, least, ends) of each distinct conversation."""
    kind = units.schema["conv_id"].dataType.simpleString()
    path = F.unhex(F.array_join("units", ""))
    seqs = stored(units.select("conv_id", path.alias("path")).withColumn("key", F.sha2("path", 256)))
    ids = seqs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = ids.mapInArrow(_id_runs, f"key string, first {kind}, n long, ids string")
    ends = runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_id_digests, f"key string, n long, least {kind}, ends string")
    return seqs.groupBy("key").agg(F.first("path").alias("path")).join(ends, "key").drop("key")


def shared_units(a: bytes, b: bytes) -> int:
    """How many units two paths have in common at their beginning."""
    n, i = min(len(a), len(b)), 0
    while i < n and a[i:i + UNIT] == b[i:i + UNIT]:
        i += UNIT
    return i // UNIT


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lo, hi = batch.column("lo").to_pylist(), batch.column("hi").to_pylist()
        shared = [a[:UNIT * shared_units(a, b)] for a, b in zip(lo, hi)]
        yield pa.RecordBatch.from_arrays([*batch.select(["head", "parent", "depth", "unit", "n", "least"]).columns, pa.array(shared, pa.binary())],
                                         names=["head", "parent", "depth", "unit", "n", "least", "shared"])


def _burst(rows: DataFrame, cfg: Burst, kind: str) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Containers within the limits; and per round the burst heads and the paths that end there."""
    done, chains, stops = [], [], []
    while True:
        sizes = rows.groupBy("head").agg(
            F.count(F.lit(1)).alias("paths"), F.sum(F.length("path") + 64).alias("bytes"), F.first("parent").alias("parent"),
            F.first("depth").alias("depth"), F.first("unit").alias("unit"), F.sum("n").alias("n"), F.min("least").alias("least"),
            F.min("path").alias("lo"), F.max("path").alias("hi"))
        over = sizes.where((F.col("paths") > 1) & ((F.col("paths") > cfg.rows) | (F.col("bytes") > cfg.bytes)))
        over = held(over.mapInArrow(_common, f"head string, parent string, depth long, unit binary, n long, least {kind}, shared binary"))
        if over.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows]), chains, stops
        # Long chains make wide rows, so the side is measured, not counted.
        most = over.agg(F.max(F.length("shared") + 128).alias("b")).first()["b"]
        side = small_side(over.select("head", "shared"), most)
        done.append(rows.join(small_side(over.select("head"), 96), "head", "left_anti"))
        cut = F.length("shared")
        below = stored(rows.join(side, "head").select(
            "head", "depth", "n", "least", "ends", F.expr("substring(path, length(shared) + 1)").alias("rest"), cut.alias("cut"),
            F.sha2("shared", 256).alias("mark")))
        chains.append(over)
        stops.append(below.where(F.length("rest") == 0).select("head", "ends"))
        unit = F.expr(f"substring(rest, 1, {UNIT})")
        rows = below.where(F.length("rest") > 0).select(
            F.sha2(F.concat_ws("/", "head", "mark", F.hex(unit)), 256).alias("head"), F.col("head").alias("parent"),
            (F.col("depth") + F.col("cut") / UNIT + 1).cast("long").alias("depth"), unit.alias("unit"),
            F.expr(f"substring(rest, {UNIT + 1})").alias("path"), "n", "least", "ends")


class _Node:
    __slots__ = ("depth", "unit", "n", "least", "ends", "waiting", "leaves", "saved")

    def __init__(self, depth: int, unit: bytes) -> None:
        self.depth, self.unit, self.n, self.least, self.ends = depth, unit, 0, None, NO_ENDS
        self.waiting: list[list] = []
        self.leaves = self.saved = 0

    def take(self, n: int, least: object) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


def code_points(unit: bytes) -> int:
    return int.from_bytes(unit[DIGEST:], "big")


def _sweeper(kind: pa.DataType):
    """Collects finished nodes of sorted paths, container by container."""
    out: list[list] = []

    def close(node: _Node, above: _Node | None) -> list:
        """A complete node hands its totals up; its children now know their parent."""
        for row in node.waiting:
            row[5] = node.least
            out.append(row)
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * code_points(node.unit)
        row = [None, None, False, node.depth, node.least, None, node.n, len(node.waiting), leaves, saved, node.ends, node.unit[:DIGEST].hex()]
        if above is not None:
            above.take(node.n, node.least)
            above.leaves += leaves
            above.saved += saved
            above.waiting.append(row)
        return row

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        types = [pa.string(), pa.string(), pa.bool_(), pa.int64(), kind, kind, *[pa.int64()] * 4, pa.string(), pa.string()]
        names = [x.split()[0] for x in NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return out, close, flush


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head, parent, stack, last = None, None, [], b""
    out = close = flush = None

    def finish() -> None:
        while len(stack) > 1:
            close(stack.pop(), stack[-1])
        row = close(stack.pop(), None)
        row[0], row[1], row[2] = head, parent, True
        out.append(row)

    for batch in batches:
        if out is None:
            out, close, flush = _sweeper(batch.schema.field("least").type)
        for h, p, depth, unit, path, n, least, ends in zip(*[c.to_pylist() for c in batch.columns]):
            if h != head:
                if stack:
                    finish()
                head, parent, last = h, p, b""
                stack.append(_Node(depth, unit))
            keep = shared_units(last, path)
            while len(stack) > keep + 1:
                node = stack.pop()
                close(node, stack[-1])
            for at in range(keep * UNIT, len(path), UNIT):
                stack.append(_Node(stack[-1].depth + 1, path[at:at + UNIT]))
            stack[-1].take(n, least)
            stack[-1].ends = ends
            last = path
            if len(out) > FLUSH_ROWS:
                yield flush()
    if stack:
        finish()
    if out:
        yield flush()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of burst heads, from (head, parent, depth, unit, n, least, shared, children, leaves, saved, ends)."""
    for batch in batches:
        out, _, flush = _sweeper(batch.schema.field("least").type)
        for head, parent, depth, unit, n, least, shared, children, leaves, saved, ends in zip(*[c.to_pylist() for c in batch.columns]):
            units = [unit, *[shared[at:at + UNIT] for at in range(0, len(shared), UNIT)]]
            for i in range(len(units) - 1, -1, -1):
                saved += (n - 1) * code_points(units[i])
                final = i == len(units) - 1
                out.append([head, parent, i == 0, depth + i, least, least if i else None, n, children if final else 1, leaves, saved,
                            (ends or NO_ENDS) if final else NO_ENDS, units[i][:DIGEST].hex()])
            if len(out) > FLUSH_ROWS:
                yield flush()
        if out:
            yield flush()


def prefix_trie(units: DataFrame, cfg: Burst = Burst()) -> DataFrame:
    """Nodes of the trie over (conv_id, units): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and turn_id of the node's last
    turn (empty at the root), by which ``turn_texts`` gives role and text."""
    kind = units.schema["conv_id"].dataType.simpleString()
    start = _paths(units).select(F.lit("").alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
                                 F.lit(b"").alias("unit"), "path", "n", "least", "ends")
    containers, chains, stops = _burst(stored(start), cfg, kind)
    dealt = containers.select("head", "parent", "depth", "unit", "path", "n", "least", "ends")
    dealt = dealt.repartition("head").sortWithinPartitions("head", "path")
    nodes = stored(dealt.mapInArrow(_sweep, NODES.format(id=kind)))
    tops = nodes.where("top")
    parts = [nodes]
    for over, stop in zip(reversed(chains), reversed(stops)):
        below = tops.groupBy(F.col("parent").alias("head")).agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"),
                                                                F.sum("saved_tokens").alias("saved"))
        full = over.join(below, "head").join(stop, "head", "left") \
                   .select("head", "parent", "depth", "unit", "n", "least", "shared", "children", "leaves", "saved", "ends")
        made = held(full.mapInArrow(_chain, NODES.format(id=kind)))
        parts.append(made)
        tops = tops.unionByName(made.where("top"))
    found = reduce(DataFrame.unionByName, parts)
    if chains:
        heads = reduce(DataFrame.unionByName, chains).select(F.col("head").alias("parent"), F.col("least").alias("above"))
        found = found.join(small_side(held(heads), 128), "parent", "left") \
                     .withColumn("parent_conv_id", F.when(F.col("top"), F.col("above")).otherwise(F.col("parent_conv_id")))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id")
