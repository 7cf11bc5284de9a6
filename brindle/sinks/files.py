"""File writers."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.skew import rows_in_bytes
from brindle.plans import scoped_conf

TARGET_FILE_BYTES = 128 * 1024 * 1024


def write_text(df: DataFrame, path: str, compression: str = "none", file_bytes: int | None = None) -> None:
    """Write the single string column of ``df``, one line per row.

    The target must not exist.  ``file_bytes`` bounds the files, for readers that take
    a file whole: the measured mean length of a line gives the lines of a file.
    """
    writer = df.write.mode("errorifexists").option("lineSep", "\n").option("compression", compression)
    if file_bytes:
        writer = writer.option("maxRecordsPerFile", rows_in_bytes(df, file_bytes))
    writer.text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_sequence_file(df: DataFrame, path: str) -> None:
    """Write a two-column frame as a Hadoop SequenceFile.

    The format has no DataFrame writer, so this is the one place that goes through
    an RDD.
    """
    if len(df.columns) != 2:
        raise ValueError("a SequenceFile holds (key, value) pairs")
    df.rdd.map(tuple).saveAsSequenceFile(path)


def read_sequence_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], rows_per_file: int | None = None) -> None:
    """Replace just the partitions that occur in ``df``; the others stay.

    Rows are clustered by partition with a rebalance: adaptive execution splits a hot
    partition over several tasks and merges small ones, so a small partition is one
    file.  ``rows_per_file`` bounds the files besides.  It is one write: no row can fall
    between two predicates.
    """
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*partition_by).parquet(path)


def data_bytes(spark: SparkSession, path: str) -> int:
    """Size of the Parquet files below a folder, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).agg(F.sum("length").alias("bytes")).first()["bytes"] or 0


def _fingerprint(df: DataFrame) -> tuple:
    """Row count and order-free sum of row hashes."""
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first())


def compact_files(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Re-write a Parquet folder as fewer files in a new folder; return the new data.

    Unpartitioned data needs no shuffle: whole input splits are merged.
    Partitioned data is rebalanced by its partition columns.  These are read and
    written as text, so that values like ``007`` stay what they are.  Source and target
    are compared as bags of rows before the new data is returned.
    """
    with scoped_conf(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
        df = spark.read.parquet(source)
        if partition_by:
            overwrite_partitions(df, target, partition_by)
        else:
            df.coalesce(max(1, ceil(data_bytes(spark, source) / target_bytes))).write.parquet(target)
        compacted = spark.read.schema(df.schema).parquet(target)
        if _fingerprint(df) != _fingerprint(compacted):
            raise RuntimeError(f"{target} does not hold the rows of {source}")
    return compacted
