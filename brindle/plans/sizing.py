"""Size checks that stand before every broadcast.

Left to itself, Spark takes the size of a frame from its compressed files and knows
nothing of the rows an explode makes, so it may broadcast a frame many times as large as
it thinks, all of it through the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 16


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        as_json = F.to_json(F.struct(column))
        return F.coalesce(F.octet_length(as_json), F.lit(0)).cast("bigint")
    return F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take, from one aggregate over the data itself.

    Only the one-row sum reaches the driver.
    """
    widths = reduce(add, (_width(field) for field in df.schema.fields), F.lit(ROW_OVERHEAD).cast("bigint"))
    return df.agg(F.sum(widths).alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within ``limit``.

    Beyond it the frame is marked for a shuffled join, which adaptive execution may
    split where it is skewed.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df.hint("merge")


def shuffled_if_large(df: DataFrame, limit: int = BROADCAST_LIMIT, joined: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for a shuffled join when its measured size is beyond ``limit``; within it Spark chooses.

    ``joined`` are the rows of ``df`` that a predicate in the same statement lets into the join.
    """
    return df if measured_bytes(df if joined is None else joined) <= limit else df.hint("merge")
