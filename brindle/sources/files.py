"""Text and JSON readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_text(spark: SparkSession, path: str | list[str], min_partitions: int | None = None) -> DataFrame:
    """One row per line (``value``) of a file, folder, glob or list of these.

    Spark splits large files and packs small ones by size.  ``min_partitions``
    redistributes the lines when a few unsplittable files leave tasks idle.
    """
    df = spark.read.option("lineSep", "\n").text(path)
    return df.repartition(min_partitions) if min_partitions else df


def read_whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``path`` and the whole content as ``value``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines.  With a schema nothing is inferred and unreadable lines land in
    ``_corrupt_record``; without one Spark infers it in an extra pass.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is None:
        return reader.json(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).json(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a ``read_json`` result.

    Rejected rows keep all columns: Spark refuses to parse a JSON source for the
    corrupt-record column alone.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())
