"""Frequent items by a mergeable summary of bounded memory.

The summary is that of Misra and Gries in the mergeable form: at most ``counters`` items
with a lower bound of their count.  When more items meet, the count of the first one too
many is taken off all, and what is left above zero stays.  All that was taken off at one
place adds to ``missed``: an item's true count lies between its counter and its counter
plus ``missed``, and ``missed`` is at most ``rows / (counters + 1)``.  Two summaries merge
by adding their counters and cutting again, so summaries of tasks, days or files can be
kept and merged later; the bound holds for the rows of all of them.

One task makes one summary, whatever the number of its rows, and only summaries are
shuffled: ``counters`` rows a task, and none of the table's keys besides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.plans import broadcast_if_small, materialize

COUNTERS = 1000
SUMMARY = ("item", "counter", "missed", "rows")


def _cut(items: pa.Array, counts: pa.Array, counters: int) -> tuple[pa.Array, pa.Array, int]:
    """Sum the counts of equal items, and keep at most ``counters`` of them; also what was taken off."""
    summed = pa.table({"item": items, "n": counts}).group_by("item", use_threads=False).aggregate([("n", "sum")])
    if summed.num_rows <= counters:
        return summed["item"].combine_chunks(), summed["n_sum"].combine_chunks(), 0
    order = pc.select_k_unstable(summed["n_sum"].combine_chunks(), counters + 1, [("", "descending")])
    off = summed["n_sum"][order[counters].as_py()].as_py()
    kept = summed.filter(pc.greater(summed["n_sum"], off))
    return kept["item"].combine_chunks(), pc.subtract(kept["n_sum"].combine_chunks(), off), off


def _summarize(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """One summary of ``item, counter, missed, rows`` rows; the row without a counter carries the totals."""
    items = counts = None
    missed = rows = 0
    for batch in batches:
        item, counter, own_missed, own_rows = (batch.column(i) for i in range(4))
        totals = pc.is_null(counter)
        missed += pc.sum(pc.filter(own_missed, totals)).as_py() or 0
        rows += pc.sum(pc.filter(own_rows, totals)).as_py() or 0
        listed = pc.invert(totals)
        item, counter = pc.filter(item, listed), pc.filter(counter, listed)
        if items is not None:
            item, counter = pa.concat_arrays([items, item]), pa.concat_arrays([counts, counter])
        items, counts, off = _cut(item, counter, counters)
        missed += off
    if items is None:
        return
    none = pa.nulls(1, items.type)
    size = len(items)
    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([items, none]), pa.concat_arrays([counts.cast(pa.int64()), pa.nulls(1, pa.int64())]),
            pa.array([None] * size + [missed], pa.int64()), pa.array([None] * size + [rows], pa.int64()),
        ],
        names=list(SUMMARY),
    )


def summary_of(df: DataFrame, item: str | Column, counters: int = COUNTERS) -> DataFrame:
    """A summary for each task: ``item, counter, missed, rows``; NULL is an item like others.

    The row without a counter holds what the summary missed and how many rows it is of.
    Summaries of different inputs can be united and kept.
    """
    rows = df.select((F.col(item) if isinstance(item, str) else item).alias("item"))
    schema = T.StructType([T.StructField("item", rows.schema["item"].dataType), *(T.StructField(name, T.LongType()) for name in SUMMARY[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = pc.value_counts(batch.column(0))
                values, counts = found.field(0), found.field(1)
                total = pa.nulls(1, values.type)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([values, total]), pa.concat_arrays([counts, pa.nulls(1, pa.int64())]),
                        pa.array([None] * len(values) + [0], pa.int64()), pa.array([None] * len(values) + [batch.num_rows], pa.int64()),
                    ],
                    names=list(SUMMARY),
                )

        return _summarize(counted(), counters)

    return rows.mapInArrow(run, schema)


def merged(summaries: DataFrame, counters: int = COUNTERS, fan_in: int = 64) -> DataFrame:
    """One summary of many, in rounds that merge ``fan_in`` of them in a task."""
    schema, now = summaries.schema, materialize(summaries, "summaries")
    while True:
        many = now.agg(F.count_if(F.col("counter").isNull())).first()[0]
        if many <= 1:
            return now
        # A whole summary is one partition of what was written, or several; it never matters which rows meet first.
        parts = max(1, -(-many // fan_in))
        now = materialize(now.repartition(parts).mapInArrow(lambda batches: _summarize(batches, counters), schema), "summaries")


def bounds(summary: DataFrame, one_in: int | None = None) -> DataFrame:
    """``item, lower, upper, rows`` from one summary; with ``one_in`` the items that may hold more than one row in so many."""
    totals = summary.where(F.col("counter").isNull()).select(F.col("missed").alias("off"), F.col("rows").alias("total"))
    listed = summary.where(F.col("counter").isNotNull()).join(F.broadcast(totals))  # one row
    found = listed.select(
        "item", F.col("counter").alias("lower"), (F.col("counter") + F.col("off")).alias("upper"), F.col("total").alias("rows")
    )
    return found if one_in is None else found.where(F.col("upper") * one_in > F.col("rows"))


def frequent_items(df: DataFrame, item: str, one_in: int, counters: int | None = None, exact: bool = True) -> DataFrame:
    """All values of ``item`` that more than one row in ``one_in`` holds.

    The summary finds every one of them, with bounds ``lower`` and ``upper``, in one pass
    that shuffles no keys.  ``exact`` counts the few candidates in a second pass (``cnt``) and
    leaves out those that are less frequent.
    """
    counters = counters or max(COUNTERS, 2 * one_in)
    if counters < one_in:
        raise ValueError(f"a summary of {counters} counters may miss items of one row in {one_in}")
    candidates = bounds(merged(summary_of(df, item, counters), counters), one_in)
    if not exact:
        return candidates
    candidates = materialize(candidates, "candidates")
    listed = broadcast_if_small(candidates.select(F.col("item").alias("_candidate")))
    keys = df.select(F.col(item).alias("_counted"))
    counted = keys.join(listed, F.col("_counted").eqNullSafe(F.col("_candidate")), "left_semi").groupBy("_counted").agg(F.count(F.lit(1)).alias("cnt"))
    return (
        candidates.join(counted, F.col("item").eqNullSafe(F.col("_counted")))
        .where(F.col("cnt") * one_in > F.col("rows"))
        .select("item", "lower", "upper", "cnt", "rows")
    )
