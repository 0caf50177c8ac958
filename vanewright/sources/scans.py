"""Batch sources: parquet, aligned parts, files, logs, registries, catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.functions.scalars import path_name, path_stem
from vanewright.plans.sizing import checked_broadcast
from vanewright.schemas import METRIC_LOG
from vanewright.sources import file_ranges


def read_telemetry(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_many(spark: SparkSession, paths: Sequence[str],
              schema: T.StructType | None = None) -> DataFrame:
    """Several parquet files in one scan, each row tagged with its file name."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths).withColumn("src_file", F.col("_metadata.file_name"))


def zip_row_aligned(parts: Mapping[str, DataFrame], key: str = "row_id") -> DataFrame:
    """Column groups that describe the same rows, joined on a stored row key.

    Part names prefix no column: the column groups have distinct names.  All
    joins use the same key, so each part is shuffled at most once; parts that
    are bucketed on the key are not shuffled at all.
    """
    frames = list(parts.values())
    out = frames[0]
    for frame in frames[1:]:
        clash = (set(out.columns) & set(frame.columns)) - {key}
        if clash:
            raise ValueError(f"parts share columns: {sorted(clash)}")
        out = out.join(frame, key, "inner")
    return out


def _files(spark: SparkSession, path: str, glob: str, **options: object) -> DataFrame:
    file_ranges.register(spark)
    return spark.read.format(file_ranges.FORMAT).options(path=path, glob=glob, **{k: str(x).lower() for k, x in options.items()}).load()


def _contents(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Whole files as rows, for stores that only Spark opens; files end at 2 GiB there."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(path))


def scan_files(spark: SparkSession, path: str, glob: str = "*", chunk_bytes: int = file_ranges.CHUNK_BYTES) -> DataFrame:
    """Name, size, time and SHA-256 of every file below ``path``, read chunk by chunk."""
    if file_ranges.opens(path):
        files = _files(spark, path, glob, chunk_bytes=chunk_bytes)
    else:
        files = _contents(spark, path, glob).withColumn("sha256", F.sha2("content", 256))
    return files.select("path", path_name("path").alias("file_name"), "length", "modificationTime", "sha256")


def file_heads(spark: SparkSession, path: str, glob: str = "*", nbytes: int = 8) -> DataFrame:
    """The first bytes of every file, without reading on."""
    if file_ranges.opens(path):
        files = _files(spark, path, glob, head_bytes=nbytes, digest=False)
    else:
        files = _contents(spark, path, glob).withColumn("head", F.substring("content", 1, nbytes))
    return files.select("path", "length", "head")


def split_valid_files(files: DataFrame, magic: bytes, head: str = "head"
                      ) -> tuple[DataFrame, DataFrame]:
    """(valid, corrupt) by the first bytes of the content."""
    ok = F.coalesce(F.substring(head, 1, len(magic)) == F.lit(magic), F.lit(False))
    return files.where(ok), files.where(~ok)


def discover_datasets(files: DataFrame, path: str = "path", suffix: str | None = None) -> DataFrame:
    """Distinct file stems, sorted."""
    source = files if suffix is None else files.where(F.lower(path).endswith(suffix.lower()))
    return source.select(path_stem(path).alias("dataset")).distinct().orderBy("dataset")


def read_metric_logs(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Long metric logs of several files, merged, ordered by tag and step."""
    reader = spark.read.schema(METRIC_LOG).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return merge_metric_logs([reader.load(list(paths))])


def merge_metric_logs(logs: Sequence[DataFrame]) -> DataFrame:
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out.orderBy("tag", "step")


def catalog_report(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a table or view; one row with ``exists = false`` if absent."""
    schema = "table_name string, exists boolean, position int, column_name string, data_type string"
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([(name, False, None, None, None)], schema)
    rows = [(name, True, i, c.name, c.dataType)
            for i, c in enumerate(spark.catalog.listColumns(name))]
    return spark.createDataFrame(rows, schema)


def lookup_registry(df: DataFrame, registry: DataFrame, slug: str = "slug") -> DataFrame:
    """Registry columns by case-insensitive slug; null when it is unknown."""
    side = registry.withColumn("__slug", F.upper(slug)).drop(slug)
    out = df.withColumn("__slug", F.upper(slug))
    return out.join(checked_broadcast(side), "__slug", "left").drop("__slug")
