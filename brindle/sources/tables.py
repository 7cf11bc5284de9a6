"""Catalog tables, local collections and generated rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import bucket_of


def from_rows(
    spark: SparkSession,
    rows: Sequence[Any],
    schema: T.StructType | str,
    partitions: int | None = None,
    view: str | None = None,
) -> DataFrame:
    """A frame from a small local collection, optionally registered as a view."""
    df = spark.createDataFrame(rows, schema)
    if partitions:
        df = df.repartition(partitions)
    if view:
        df.createOrReplaceTempView(view)
    return df


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def read_table(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df


def people(ids: DataFrame, prefix: str, seed: int, with_age: bool = True) -> DataFrame:
    """Generated rows for each ``id``: a name, an age and a partition number.

    The "random" columns are hashes of the id, so that a task that runs again
    makes the same rows and no Python function takes part.  For a plain range pass
    ``spark.range(n)``.
    """
    age = [bucket_of(F.col("id"), 100, seed, integral=True).cast("int").alias("age")] if with_age else []
    return ids.select(
        "id",
        F.concat(F.lit(prefix), F.col("id").cast("string")).alias("name"),
        *age,
        bucket_of(F.col("id"), 100, seed + 1, integral=True).cast("int").alias("partition"),
    )
