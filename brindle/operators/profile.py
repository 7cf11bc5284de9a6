"""Column statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.plans import scoped_conf


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, nulls, distinct values, min, max, mean and longest length of the text.

    For each type of the columns one scan gives (column, value) pairs, which are counted
    first: map-side, narrow keys, and all statistics follow from the distinct values and
    their counts.  A frequent value is one counter in each task.
    """
    types = {name: kind for name, kind in df.dtypes}
    parts = []
    for kind in dict.fromkeys(types[c] for c in columns):
        own = [c for c in columns if types[c] == kind]
        pairs = F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).alias("value")) for i, c in enumerate(own)])
        counted = df.select(F.inline(pairs)).groupBy("place", "value").agg(F.count(F.lit(1)).alias("n"))
        # So that a column of an empty table has its row too.
        nothing = df.sparkSession.range(len(own)).select(F.col("id").cast("int").alias("place"), F.lit(None).cast(kind).alias("value"), F.lit(0).alias("n"))
        counted = counted.union(nothing)
        length = F.length(F.col("value").cast("string")).cast("bigint")
        filled = F.when(F.col("value").isNotNull(), F.col("n"))
        named = F.element_at(F.array(*[F.lit(c) for c in own]), F.col("place") + 1).alias("column_name")
        parts.append(
            counted.groupBy("place")
            .agg(
                F.sum("n").alias("row_count"),
                (F.sum("n") - F.coalesce(F.sum(filled), F.lit(0))).alias("null_count"),
                F.min("value").cast("string").alias("min_value"),
                F.max("value").cast("string").alias("max_value"),
                (F.sum(length * F.col("n")).cast("double") / F.sum(filled)).alias("avg_length"),
                F.max(length).alias("max_length"),
                F.count("value").alias("distinct_count"),
            )
            .select(named, "row_count", "null_count", "min_value", "max_value", "avg_length", "max_length", "distinct_count")
        )
    return reduce(DataFrame.unionByName, parts)


def analyze(spark: SparkSession, table: str, columns: Sequence[str], histogram_bins: int = 0) -> None:
    """Put table and column statistics into the catalog for the optimizer.

    With ``histogram_bins`` (2 or more) columns of numbers and times get equi-height
    histograms, which tell how many rows a range holds however uneven the values are.
    """
    settings = {"spark__sql__statistics__histogram__enabled": str(histogram_bins > 0).lower()}
    if histogram_bins:
        settings["spark__sql__statistics__histogram__numBins"] = str(histogram_bins)
    with scoped_conf(spark, **settings):
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


@contextmanager
def cost_based(spark: SparkSession, enabled: bool = True) -> Iterator[SparkSession]:
    """Plans made inside use the catalog's statistics: estimated rows of filters and joins, and the order of joins."""
    wanted = str(enabled).lower()
    with scoped_conf(
        spark,
        spark__sql__cbo__enabled=wanted,
        spark__sql__cbo__planStats__enabled=wanted,
        spark__sql__cbo__joinReorder__enabled=wanted,
        spark__sql__statistics__histogram__enabled=wanted,
    ):
        yield spark


def catalog_statistics(spark: SparkSession, table: str, columns: Sequence[str]) -> list[dict[str, str | None]]:
    """What the catalog holds about each column: a handful of rows of metadata."""
    out = []
    for column in columns:
        info = {row["info_name"]: row["info_value"] for row in spark.sql(f"DESC FORMATTED {table} {column}").collect()}
        out.append({key: (None if value == "NULL" else value) for key, value in info.items()})
    return out
