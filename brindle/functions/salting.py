"""Salts for spreading a hot key over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def row_salt(spread: Column, salts: int | Column) -> Column:
    """Salt in ``0 .. salts-1`` drawn from ``spread``.

    ``spread`` must differ between rows of one key and must come out the same
    when a lost task is run again, so it is a hash of row content or of the row's
    place in its file, never a bare ``rand()``.
    """
    width = F.lit(salts) if isinstance(salts, int) else salts
    return F.pmod(F.xxhash64(spread), width.cast("bigint")).cast("int")


def register_salt_functions(spark: SparkSession) -> None:
    """Register ``brindle_salt_key(key, spread, salts)`` and ``brindle_unsalt_key(salted)`` for SQL.

    They are SQL functions, so Catalyst inlines them: no Python worker takes part.
    The salt is a struct next to the key rather than a text prefix, so the key
    keeps its type.
    """
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION brindle_salt_key(key BIGINT, spread BIGINT, salts INT)
        RETURNS STRUCT<key: BIGINT, salt: INT>
        RETURN named_struct('key', key, 'salt', CAST(pmod(spread, salts) AS INT))
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION brindle_unsalt_key(salted STRUCT<key: BIGINT, salt: INT>)
        RETURNS BIGINT
        RETURN salted.key
        """
    )
