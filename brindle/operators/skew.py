"""Finding hot keys, and joins and sums that hold up when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions import row_salt
from brindle.operators.rows import sample_rows
from brindle.plans import broadcast_if_small, materialize, measured_bytes, shuffled_if_large

TASK_BYTES = 64 * 1024 * 1024

_SALT, _SALTS = "_salt", "_salts"


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def top_keys(df: DataFrame, key: str, n: int = 10, fraction: float | None = None, spread: Column | None = None, seed: int = 1) -> DataFrame:
    """The ``n`` most frequent keys with their counts (``key, cnt``), or what a sample tells of them.

    With ``fraction`` the rows whose hash of ``spread`` is low are counted (``drawn``); the
    result also has the ``estimate`` for the whole table and its standard ``error``, in rows.
    The hash, not the scan, decides what is drawn: a repeated run gives the same keys, and
    rows equal in ``spread`` are drawn together.
    """
    if fraction is None:
        return key_counts(df.select(key), key).orderBy(F.desc("cnt"), F.asc(key)).limit(n)
    if spread is None:
        raise ValueError("a sample needs columns to draw its rows by")
    drawn = sample_rows(df.withColumn("_spread", spread), "_spread", fraction, seed)
    counted = key_counts(drawn.select(key), key).withColumnRenamed("cnt", "drawn")
    return counted.orderBy(F.desc("drawn"), F.asc(key)).limit(n).select(
        key,
        "drawn",
        F.floor(F.col("drawn") / F.lit(fraction)).alias("estimate"),
        F.ceil(F.sqrt(F.col("drawn") * F.lit(1 - fraction)) / F.lit(fraction)).alias("error"),
    )


def top_keys_of_columns(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """``key_column, key, cnt``: the most frequent keys of each of several columns of one type, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key_column"), F.col(c).alias("key")) for c in columns])
    counted = key_counts(df.select(F.explode(pairs).alias("p")).select("p.*"), "key_column", "key")
    # Each task keeps only its own first n of a column before the rows meet.
    place = F.row_number().over(Window.partitionBy("key_column").orderBy(F.desc("cnt"), F.asc("key")))
    return counted.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


@dataclass(frozen=True)
class HotKeys:
    """Keys too frequent for one task, each with the number of salts it needs.

    ``frame`` (the keys and ``_salts``) is a written table; only the largest number of
    salts and whether a key holds a NULL come to the driver.
    """

    keys: tuple[str, ...]
    frame: DataFrame
    most: int
    null_is_hot: bool

    @property
    def matchable(self) -> DataFrame:
        return self.frame.where(reduce(and_, [F.col(key).isNotNull() for key in self.keys]))

    def __bool__(self) -> bool:
        return self.most > 0


def rows_in_bytes(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many of the frame's rows make ``task_bytes``, by their measured width."""
    rows = df.count()
    return max(1, ceil(rows * task_bytes / max(1, measured_bytes(df))))


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    rows_per_task: int | None = None,
    at_least: int = 0,
    min_salts: int = 2,
    fraction: float | None = None,
    seed: int = 1,
) -> HotKeys:
    """Keys that hold ``rows_per_task`` rows or more, and always the top ``at_least``.

    By default a task's share is ``TASK_BYTES`` of rows, whatever the session's
    settings.  All keys over the share are found and stay in the engine.
    ``fraction`` counts a sample: a missed key costs speed, never rows.
    """
    selected = df.select(*keys)
    if rows_per_task is None:
        rows_per_task = rows_in_bytes(df)
    if fraction is not None:
        selected = selected.sample(withReplacement=False, fraction=fraction, seed=seed)
    scale = 1.0 if fraction is None else 1 / fraction
    counted = key_counts(selected, *keys)
    hot = counted.where(F.col("cnt") * scale >= rows_per_task)
    if at_least:
        hot = hot.union(counted.orderBy(F.desc("cnt"), *[F.asc(key) for key in keys]).limit(at_least)).distinct()
    salts = F.greatest(F.lit(min_salts), F.ceil(F.col("cnt") * scale / rows_per_task)).cast("int")
    frame = materialize(hot.select(*keys, salts.alias(_SALTS)), "hot-keys")
    no_match = reduce(or_, [F.col(key).isNull() for key in keys])
    most, null_is_hot = frame.agg(F.coalesce(F.max(_SALTS), F.lit(0)), F.coalesce(F.bool_or(no_match), F.lit(False))).first()
    return HotKeys(tuple(keys), frame, most, null_is_hot)


def salted_left_join(fact: DataFrame, dim: DataFrame, hot: HotKeys, spread: Column) -> DataFrame:
    """``fact LEFT JOIN dim USING (keys)`` with the hot keys spread over salts.

    A hot fact row draws a salt from ``spread``; the dimension rows of hot keys, and
    only those, are repeated once per salt.  All other rows carry salt 0, so one
    join serves both kinds.  The key of the result is the fact's.  Rows whose key
    has a NULL match nothing and are spread too.
    """
    keys = list(hot.keys)
    if not hot:
        return fact.join(shuffled_if_large(dim), keys, "left")
    hot_keys = broadcast_if_small(hot.matchable)
    no_match = reduce(or_, [F.col(key).isNull() for key in keys])
    salts = F.coalesce(F.col(_SALTS), F.when(no_match, F.lit(hot.most)))
    salted_fact = (
        fact.join(hot_keys, keys, "left")
        .withColumn(_SALT, F.when(salts.isNotNull(), row_salt(spread, salts)).otherwise(0))
        .drop(_SALTS)
    )
    repeated_dim = (
        dim.join(hot_keys, keys, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    return salted_fact.join(shuffled_if_large(repeated_dim), [*keys, _SALT], "left").drop(_SALT)


def split_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and the rows of hot keys."""
    listed = broadcast_if_small(hot.frame.select(*[F.col(key).alias(f"_h_{key}") for key in hot.keys]))
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_h_{key}")) for key in hot.keys])
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def salted_sum(df: DataFrame, key: str, value: str, name: str, spread: Column, salts: int = 6) -> DataFrame:
    """Two-phase sum per key: by (key, salt), then by key.

    Equals the plain sum; the key keeps its type.  Rows without a key are left out.
    """
    amount = F.sum(value).cast("decimal(38,2)")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, row_salt(spread, salts).alias(_SALT))
        .agg(amount.alias("_part"))
        .groupBy(key)
        .agg(F.sum("_part").cast("decimal(38,2)").alias(name))
    )
