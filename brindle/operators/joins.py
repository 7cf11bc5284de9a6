"""Joins.

Inner joins and joins whose preserved side holds the hot key are left to Spark:
adaptive execution splits that side.  It cannot split the other side of an outer
join, and ``left_join_hot_right`` is for that case.  ``filtered_join`` keeps large rows
that cannot match out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from math import ceil, log
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.skew import HotKeys, salted_left_join, split_hot
from brindle.plans import broadcast_if_small, materialize, measured_bytes, scoped_conf, shuffled_if_large
from brindle.plans.sizing import BROADCAST_LIMIT


def lookup(fact: DataFrame, dim: DataFrame, key: str, value: str, default: object) -> DataFrame:
    """Add ``value`` from a dimension with one row per key, or ``default``.

    Broadcast when the dimension measures small, else a shuffled left join.
    """
    found = fact.join(broadcast_if_small(dim.select(key, value)), key, "left")
    return found.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def left_join_hot_right(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_condition: Column | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a right side that may be skewed.

    Matches come from an inner join, which can be split on either side; left rows
    without a match come from an anti join against the distinct right keys, where
    no key is hot any more.  ``left_condition`` is a predicate on the left columns
    that belongs to the ON clause: rows failing it stay, unmatched.  ``right_keys``
    may name a cheaper frame with the same keys as ``right``.  No side is broadcast by
    its estimate where it measures large; the distinct keys are shuffled as it is.
    """
    keys = list(keys)
    eligible = left if left_condition is None else left.filter(left_condition)
    matched = shuffled_if_large(eligible).join(right, keys, "inner")
    source = right if right_keys is None else right_keys
    known = source.select(*[F.col(key).alias(f"_r_{key}") for key in keys]).distinct().hint("merge")
    same = reduce(and_, [F.col(key) == F.col(f"_r_{key}") for key in keys])
    if left_condition is not None:
        same = same & left_condition
    types = {field.name: field.dataType for field in right.schema.fields}
    missing = [F.lit(None).cast(types[c]).alias(c) for c in right.columns if c not in keys]
    unmatched = left.join(known, same, "left_anti").select("*", *missing)
    return matched.unionByName(unmatched)


def bucketed_left_join(common: DataFrame, apart: DataFrame, dim: DataFrame, hot: HotKeys, spread: Column) -> DataFrame:
    """Left join of a table written by ``save_bucketed_apart`` with one bucketed alike.

    The common rows join bucket by bucket, with no shuffle of either table.  A bucket is
    one task and cannot be split, so no bucket holds a hot key: those rows stand in a
    table of their own and are joined over salts.
    """
    joined = common.join(dim, list(hot.keys), "left")
    if not hot:
        return joined
    _, wanted = split_hot(dim, hot)
    return joined.unionByName(salted_left_join(apart, wanted, hot, spread))


def key_join_sql(left: DataFrame, right: DataFrame, keys: Mapping[str, str], hint: str | None = None) -> DataFrame:
    """All columns of two frames joined by one statement; ``keys`` maps a key of the left to that of the right.

    ``hint`` is a strategy for the left side (``BROADCAST``, ``MERGE`` and so on).  Without one,
    or with one that would broadcast, the join is shuffled when that side measures large.
    """
    if (not hint or hint.upper() in BROADCAST_HINTS) and measured_bytes(left) > BROADCAST_LIMIT:
        hint = "MERGE"
    marked = f"/*+ {hint}(first_side) */ " if hint else ""
    condition = " AND ".join(f"first_side.`{one}` = second_side.`{other}`" for one, other in keys.items())
    statement = f"SELECT {marked}* FROM {{left}} AS first_side INNER JOIN {{right}} AS second_side ON {condition}"
    return left.sparkSession.sql(statement, left=left, right=right)


BROADCAST_HINTS = frozenset(("BROADCAST", "BROADCASTJOIN", "MAPJOIN"))
FILTER_KEYS = 32_000_000  # keys of a filter, at most: 38 MB at one false hit in a hundred
FALSE_HITS = 0.01


def filter_bits(keys: int, false_hits: float = FALSE_HITS) -> int:
    """Bits of a Bloom filter that lets ``false_hits`` of the other keys through."""
    return max(64, ceil(-keys * log(false_hits) / log(2) ** 2))


@contextmanager
def runtime_filters(spark: SparkSession, keys: int, scan_bytes: int = 0) -> Iterator[SparkSession]:
    """Plans made inside filter the scan of a shuffled join's large side by a Bloom filter of the other side's keys.

    The other side must have a predicate that may be selective.  ``keys`` sizes the filter;
    sides scanning less than ``scan_bytes`` are left alone.
    """
    bits = filter_bits(keys)
    with scoped_conf(
        spark,
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold=str(scan_bytes),
        # The keys were counted, so the estimated size of their source says nothing more.
        spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold=str(1 << 60),
        spark__sql__optimizer__runtime__bloomFilter__expectedNumItems=str(keys),
        spark__sql__optimizer__runtime__bloomFilter__maxNumItems=str(max(keys, 4_000_000)),
        spark__sql__optimizer__runtime__bloomFilter__numBits=str(bits),
        spark__sql__optimizer__runtime__bloomFilter__maxNumBits=str(max(bits, 1 << 26)),
        spark__sql__autoBroadcastJoinThreshold="-1",
    ):
        yield spark


def filtered_join(
    large: DataFrame, selective: DataFrame, keys: Sequence[str], broadcast_limit: int = BROADCAST_LIMIT, most_keys: int = FILTER_KEYS
) -> DataFrame:
    """``large JOIN selective USING (keys)`` where few rows of ``large`` have a partner.

    A small selective side is broadcast.  One too large for that gives a Bloom filter of its
    first key, if it has at most ``most_keys`` of them: rows of ``large`` it rules out leave
    the plan at the scan and never reach the shuffle.  Beyond that the join is a plain
    one.  The filtered join is written out, as its plan must be made under these settings.
    """
    keys = list(keys)
    if measured_bytes(selective) <= broadcast_limit:
        return large.join(F.broadcast(selective), keys)
    known = selective.agg(F.approx_count_distinct(keys[0], 0.02)).first()[0]
    if known > most_keys:
        return large.join(selective, keys)
    with runtime_filters(large.sparkSession, max(1, ceil(known * 1.1))):
        return materialize(large.join(selective, keys), "filtered-join")


def dealt_together(keys: Sequence[str], *sides: DataFrame, partitions: int | None = None) -> list[DataFrame]:
    """Each side dealt out once by a hash of the keys, into the same number of partitions.

    Joins, sums and windows on these keys then need no further exchange, on one side or
    between them.  Rows of a key share a task: keys too frequent for that are found by
    ``find_hot_keys`` and set apart by ``split_hot`` beforehand.
    """
    count = partitions or int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [side.repartition(count, *keys) for side in sides]


@contextmanager
def coalesced_buckets(spark: SparkSession, most: int = 4) -> Iterator[SparkSession]:
    """Plans made inside join tables of unequal bucket counts without an exchange.

    The larger number of buckets must be the smaller one's multiple, by at most ``most``: that
    many buckets are read by one task.
    """
    with scoped_conf(
        spark,
        spark__sql__bucketing__coalesceBucketsInJoin__enabled="true",
        spark__sql__bucketing__coalesceBucketsInJoin__maxBucketRatio=str(most),
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__sources__bucketing__autoBucketedScan__enabled="false",
    ):
        yield spark
