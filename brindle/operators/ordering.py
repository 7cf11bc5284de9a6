"""Sorts, top-k, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.plans import materialize

_TIE, _AT, _PART = "_tie", "_at", "_part"
_PLACE_BITS = 33  # monotonically_increasing_id: partition above, row number below


def sort_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Total order: range-partitioned, so the concatenated output is sorted."""
    return df.orderBy(*order)


def smallest(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps only its own first n."""
    return df.orderBy(*order).limit(n)


def _placed(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows range-partitioned, sorted and marked with partition and place, written once.

    Sizes and rows must come from the same placement, hence the write.  Equal rows
    are told apart by their place in the input, so that copies of one row spread
    over several ranges.
    """
    return materialize(
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*order, _TIE)
        .sortWithinPartitions(*order, _TIE)
        .drop(_TIE)
        .withColumn(_AT, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_AT, _PLACE_BITS)),
        "placed",
    )


def _numbered(placed: DataFrame, name: str) -> DataFrame:
    """Position = place inside the partition + sizes of the partitions before it."""
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: its number is the session's shuffle partitions,
    # so this window and the broadcast stay small however many rows there are.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.col(_AT).bitwiseAND((1 << _PLACE_BITS) - 1)
    kept = [c for c in placed.columns if c not in (_AT, _PART)]
    return placed.join(F.broadcast(starts), _PART).select(
        *kept, (F.col("_start") + inside + 1).cast("bigint").alias(name)
    )


def with_position(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Number the rows 1, 2, 3 ... in a total order, without a single-task window.

    ``df`` should be a scan, or ``materialize``d: rows that are equal in the order are
    told apart by their place in it, which must not change when a task runs again.
    """
    return _numbered(_placed(df, *order), name)


def zip_rows(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """Pair the i-th row of one input with the i-th of the other.

    Both must have the same number of rows, as positional pairing has no meaning
    otherwise.
    """
    placed_left, placed_right = _placed(left, *left_order), _placed(right, *right_order)
    rows_left, rows_right = placed_left.count(), placed_right.count()
    if rows_left != rows_right:
        raise ValueError(f"inputs differ in length: {rows_left} and {rows_right} rows")
    return _numbered(placed_left, "position").join(_numbered(placed_right, "position"), "position")
