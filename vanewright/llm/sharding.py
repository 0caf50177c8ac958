"""Vector bin packing of documents into shards.

Bytes, tokens and rows are balanced jointly.  A group is all rows of equal text.  Units
of placement are large groups on their own, and the other groups in bundles by hash;
a sixteenth of the hash space makes half of the bundles, so there are fine ones to
even out what is left.  Only a group that exceeds a whole shard is divided.  Units go,
largest first, to the shard for which the dot product of the unit and the shard's
residual capacity is highest, all as shares of a shard's capacity.

A large group holds more than 1 / 4096 of some dimension, so there are at most 3 * 4096
of them, and 4096 bundles, whatever the input; only these sums reach the driver.
Slots are numbered in cells of a unit, whose counts give the offsets.

Rows have a number, fixed when they are kept, which is hashed into parts and cells, so that
rows equal in id and text are divided like others.  Which rows of a divided group go
to which part thus depends on their order in the input; nothing else does but the slots.

Defined results: null and empty texts are one group of size 1 per row; repeated rows
get slots of their own; null ids are carried; an empty input gives no rows; columns of
the input are kept only if named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vanewright.llm.tables import held, small_side

BLANKS = " \t\n\x0b\f\r"
BUNDLES = 4096
CELL_ROWS = 50_000


def _even(sizes: np.ndarray, to: np.ndarray, shards: int, close: float = 1e-4) -> None:
    """Move units from the fullest shard to the emptiest, by the first dimension, as long as
    that brings them closer."""
    load = np.bincount(to, sizes, shards)
    for _ in range(32 * shards):
        a, b = int(load.argmax()), int(load.argmin())
        gap = load[a] - load[b]
        own = np.flatnonzero((to == a) & (sizes > 0) & (sizes < gap))
        if gap <= close * load.mean() or not len(own):
            return
        i = own[np.argmin(np.abs(sizes[own] - gap / 2))]
        to[i] = b
        load[a] -= sizes[i]
        load[b] += sizes[i]


def place(sizes: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``sizes`` (units by dimensions); the first dimension is evened
    out at the end."""
    capacity = np.maximum(sizes.sum(axis=0) / shards, 1e-9)
    share = sizes / capacity
    residual = np.ones((shards, sizes.shape[1]))
    out = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        fits = (residual >= share[i]).all(axis=1)
        score = residual @ share[i]
        s = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmax(residual.min(axis=1)))
        out[i] = s
        residual[s] -= share[i]
    _even(sizes[:, 0], out, shards)
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text: str = "text", tokens: Column | None = None,
          carry: Sequence[str] = ()) -> DataFrame:
    """(id_col, size, n_tokens, text_crc32, law, shard, slot, grown_shard) per row.

    ``size`` is the bytes of the text plus 1; ``tokens`` an expression for the number of
    tokens, by default one per run-separating white-space character and one more.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    if tokens is None:
        tokens = F.length(body) - F.length(F.translate(body, BLANKS, "")) + 1
    rows = held(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("salt"), (F.octet_length(body) + 1).cast("long").alias("size"),
                            F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"), F.crc32(body).alias("text_crc32"),
                            F.xxhash64(body).alias("g1"), F.xxhash64(F.lit(1), body).alias("g2"), *carry))
    sums = [F.sum("size").alias("size"), F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n")]
    dims = ["size", "n_tokens", "n"]
    total = rows.agg(*sums).first()
    least = {d: (total[d] or 0) / BUNDLES for d in dims}
    full = {d: max((total[d] or 0) / shards, 1e-9) for d in dims}
    large = None
    for d in dims:
        over = F.col(d) > least[d]
        large = over if large is None else large | over
    parts = F.greatest(*[F.ceil(F.col(d) / F.lit(full[d])) for d in dims]).cast("long")
    groups = rows.groupBy("g1", "g2").agg(*sums).where(large).select("g1", "g2", parts.alias("parts"))
    # At most 3 * 4096 rows, since each holds more than 1 / 4096 of a dimension.
    groups = small_side(held(groups.withColumn("large", F.lit(True))), 48)
    fine = F.pmod(F.shiftright("g1", 20), F.lit(16)) == 0
    bundle = F.pmod(F.col("g2"), F.lit(BUNDLES // 2)) + F.when(fine, BUNDLES // 2).otherwise(0)
    part = F.pmod(F.xxhash64("id", "g2", "salt"), F.col("parts"))
    # A unit is (u1, u2): the group and its part, or null and the bundle.
    placed = rows.join(groups, ["g1", "g2"], "left").select(
        *[c for c in rows.columns], F.when(F.col("large"), F.xxhash64("g1", "g2")).alias("u1"),
        F.when(F.col("large"), part).otherwise(bundle).alias("u2"))
    placed = held(placed)
    units = placed.groupBy("u1", "u2").agg(*sums).orderBy("u1", "u2").toArrow()
    to = place(np.array([units.column(d).to_numpy() for d in dims], float).reshape(3, -1).T, shards)
    units = units.append_column("shard", [to.astype(np.int32)]).select(["u1", "u2", "n", "shard"])
    spark = docs.sparkSession
    units = spark.createDataFrame(units, "u1 long, u2 long, n long, shard int") \
                 .withColumn("cells", F.ceil(F.col("n") / CELL_ROWS).cast("long"))
    units = small_side(held(units), 48)
    spot = F.xxhash64("id", "g1", "g2", "salt")
    on = placed["u1"].eqNullSafe(units["u1"]) & (placed["u2"] == units["u2"])
    dealt = placed.join(units, on).select(*[placed[c] for c in placed.columns], "shard",
                                          F.pmod(spot, "cells").alias("cell"))
    unit = ["shard", "u1", "u2", "cell"]
    counts = held(dealt.groupBy(*unit).agg(F.count(F.lit(1)).alias("n")))
    before = W.partitionBy("shard").orderBy("u1", "u2", "cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("s"), F.col("u1").alias("o1"), F.col("u2").alias("o2"),
                            F.col("cell").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = small_side(held(offsets), 64)
    numbered = dealt.withColumn("at", F.row_number().over(W.partitionBy(*unit).orderBy("id", "g1", "g2", "salt")) - 1)
    on = (F.col("shard") == F.col("s")) & F.col("u1").eqNullSafe(F.col("o1")) & (F.col("u2") == F.col("o2")) & (F.col("cell") == F.col("c"))
    return numbered.join(offsets, on).select(
        F.col("id").alias(id_col), "size", "n_tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carry)


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A folder per shard, files by runs of slots, rows in the order of their slots."""
    run = F.floor(F.col("slot") / rows_per_file)
    placed.withColumn("__run", run).repartition("shard", "__run").sortWithinPartitions("shard", "__run", "slot") \
          .drop("__run").write.partitionBy("shard").parquet(path)
