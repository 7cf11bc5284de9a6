"""Bag and set operations on single-column or whole-row frames."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept, columns matched by name."""
    return left.unionByName(right)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both sides, once each; NULLs compare equal.

    One aggregate over both sides instead of a join: duplicates collapse before
    the shuffle, so a value held by most rows costs one row per task.
    """
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(2)))
    return (
        both.groupBy(*left.columns)
        .agg(F.bit_or("_side").alias("_sides"))
        .filter(F.col("_sides") == 3)
        .drop("_sides")
    )


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without an equal row in ``right``; left duplicates stay.

    Not EXCEPT (which drops duplicates) nor EXCEPT ALL (which takes away one copy
    per match).  The right side is made distinct before the shuffle.
    """
    columns = left.columns
    known = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    return left.join(known, same, "left_anti")


def distinct_rows(df: DataFrame, *columns: str, files: int | None = None) -> DataFrame:
    """Distinct rows, in ``files`` partitions if given.

    The narrowing is a shuffle of the distinct rows: ``coalesce`` would run the
    duplicate removal itself in that few tasks.
    """
    out = (df.select(*columns) if columns else df).distinct()
    return out.repartition(files) if files else out
