"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from brindle.operators.ordering import with_position
from brindle.plans import materialize


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def group_values(df: DataFrame, key: str, value: str, page_entries: int = 1_000) -> DataFrame:
    """All values of each key as sorted arrays of (value, copies), in pages.

    Copies are counted first.  A key's distinct values, in order, fill pages of
    ``page_entries``; every page but the last is full.  The rule is the same for all
    keys, so the rows do not depend on how large a group is, and no array and no task
    holds an unbounded group.  Places come from range partitions, not from a window
    over a key.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("copies"))
    placed = materialize(with_position(counted, key, value, name="_place"), "places")
    first = placed.groupBy(F.col(key).alias("_key")).agg(F.min("_place").alias("_first"))
    page = ((F.col("_place") - F.col("_first")) / page_entries).cast("int")
    return (
        placed.join(first, F.col(key).eqNullSafe(F.col("_key")))
        .select(key, page.alias("page"), value, "copies")
        # Said outright: a partitioning by key alone would satisfy the grouping too
        # and bring all pages of a hot key into one task.
        .repartition(key, "page")
        .groupBy(key, "page")
        .agg(
            F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), "copies"))).alias("entries"),
            F.sum("copies").alias("cnt"),
        )
    )


def entries_text(entries: Column) -> Column:
    """``value x copies`` pairs of a ``group_values`` array as one text."""
    pair = lambda e: F.concat(e["value"].cast("string"), F.lit("x"), e["copies"].cast("string"))
    return F.array_join(F.transform(entries, pair), ",")


def bucket_maxima(df: DataFrame, bucket: str, value: str) -> DataFrame:
    return df.groupBy(bucket).agg(F.max(value).alias("max_value"))


def zero_value_sum(df: DataFrame, value: str, zero: int, buckets: int, name: str = "total") -> DataFrame:
    """Sum in which each of ``buckets`` parts and the final merge start from ``zero``.

    Empty parts start from it as well, so it counts ``buckets + 1`` times.
    """
    return df.agg((F.coalesce(F.sum(value), F.lit(0)) + F.lit(zero * (buckets + 1))).alias(name))


def cogroup_counts(key: str, **sides: DataFrame) -> DataFrame:
    """Rows per key in each named input; a key an input lacks counts 0.

    One tagged union and one aggregate: a single shuffle however many inputs.
    """
    tagged = [df.select(key, F.lit(side).alias("_side")) for side, df in sides.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(key)
        .agg(*[F.count_if(F.col("_side") == side).alias(side) for side in sides])
    )


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Metrics collected on the side while the frame is used by its first action.

    Unlike an accumulator they do not grow when the plan runs again.  Read them
    (``observation.get`` waits for them) before a further action on the frame.
    """
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame for several actions, and let it go afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
