"""A corpus pipeline of five stages over ``documents``, each one of the dealt operators.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns a DataFrame; all but the last return the columns of ``documents``.

1. toxicity: documents that score 0.5 or more go.  The lexicon is learned from the labelled
   documents among the stage's own input, without the held-out fifth.
2. near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8) the
   document of the smallest id stays; of rows equal in id and text one.
3. decontamination: documents that contain a benchmark item go.
4. secrets: spans of secrets are replaced by a mark; all documents stay.
5. packing: the pieces of all documents with their token ids, placed in sequences.

Rows with null ids or texts, empty inputs and repeated rows take the defined results of
the operators; rows without an id take no part in stage 2 and stay.  Columns other than
those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewright.llm import secrets, toxicity
from vanewright.llm.decontamination import without_leaks
from vanewright.llm.near_dedup import NearDup, keep_one
from vanewright.llm.packing import harmonic, token_pieces
from vanewright.llm.queries import TOKENIZER, fold_of
from vanewright.llm.tables import table
from vanewright.plans.lineage import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").where(fold_of() != 0).select("doc_id", "toxic"))
    scored = toxicity.score(docs, lexicon, carry=("text", "lang", "source", "n_chars"))
    # Without labels of both classes every score is 0.5, which rejects nothing.
    return scored.where((F.col("score") < 0.5) | F.lit(not lexicon.weights)).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs.select(*COLUMNS), NearDup(shingle=5))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)), carry=("lang", "source", "n_chars"))
    cut = F.size("spans") > 0
    return found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans"))) \
                .withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = harmonic(token_pieces(docs, TOKENIZER))
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage),
          ("secrets", secrets_stage), ("packing", packing_stage)]

#: Tokenisation, learned scores and near duplicates have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    checkpoint_dir(spark)
    home = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
