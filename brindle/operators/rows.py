"""Row-wise work and explicit buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import HASH_BITS, bucket_of, integer_hash, row_salt, seeded_hash, tokens

if TYPE_CHECKING:
    import pyarrow as pa


def flatten_lists(df: DataFrame, column: str, name: str = "item") -> DataFrame:
    """One row per element of an array column; the other columns repeat."""
    return df.select(*[c for c in df.columns if c != column], F.explode(column).alias(name))


def flatten_mixed(df: DataFrame, items: str, single: str, name: str = "item") -> DataFrame:
    """One row per element where a row holds either a list or a single value."""
    others = [c for c in df.columns if c not in (items, single)]
    one = F.when(F.col(single).isNotNull(), F.array(F.col(single)))
    return df.select(*others, F.explode(F.coalesce(F.col(items), one)).alias(name))


def words(lines: DataFrame, column: str = "value", separator: str = " ") -> DataFrame:
    """One row per token of each line."""
    return lines.select(F.explode(tokens(F.col(column), separator)).alias("word"))


def map_partitions(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """Partition-wise Python over Arrow batches, for what expressions cannot say."""
    return df.mapInArrow(fn, schema)


def _is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def tag_bucket(df: DataFrame, key: str, buckets: int, name: str = "bucket") -> DataFrame:
    """Add an explicit bucket number, by a hash of the key.

    Physical partition numbers change with every plan; results that depend on "the
    partition" use this column instead.
    """
    return df.withColumn(name, bucket_of(F.col(key), buckets, integral=_is_integral(df, key)))


def only_bucket(df: DataFrame, key: str, buckets: int, wanted: int) -> DataFrame:
    return df.filter(bucket_of(F.col(key), buckets, integral=_is_integral(df, key)) == wanted)


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int = 1) -> DataFrame:
    """Reproducible sample without replacement: rows whose key hash is low.

    Any fraction is exact to the hash range, and samples of two seeds are independent.
    Independent of partitioning and of task retries.  ``DataFrame.sample`` is the
    cheaper choice when that does not matter.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("the fraction must be between 0 and 1")
    hashed = integer_hash(F.col(key), seed) if _is_integral(df, key) else seeded_hash(F.col(key), seed)
    return df.filter(hashed < F.lit(fraction * 2.0**HASH_BITS))


def route_rows(df: DataFrame, route: Column, routes: int, spread: Column, fan_out: int | None = None) -> DataFrame:
    """Send each row to a partition its ``route`` (0 .. routes-1) owns.

    Route r owns the partitions r*fan_out .. r*fan_out + fan_out - 1, filled by
    ``spread``, so a route that takes most rows is not one task.  By default the
    routes share the session's shuffle partitions; with ``fan_out=1`` the partition
    number is the route.  ``fan_out_of`` tells the number in use.
    """
    width = fan_out_of(df, routes, fan_out)
    return df.repartitionById(routes * width, route.cast("int") * width + row_salt(spread, width))


def partition_by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows of a key in one partition; ``partitions`` defaults to the session's shuffle partitions.

    For work that needs this very layout: a hot key makes a large partition.
    """
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def fan_out_of(df: DataFrame, routes: int, fan_out: int | None = None) -> int:
    if fan_out is not None:
        return fan_out
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // routes)
