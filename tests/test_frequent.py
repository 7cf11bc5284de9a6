"""The frequent-items summary against exact counts."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brindle import datasets
from brindle.operators import frequent as Q


def skewed(draw, rows, keys):
    return [draw.choice([None, "hot", draw.randrange(keys), draw.randrange(keys), draw.randrange(10)]) for _ in range(rows)]


def summary_rows(batches, counters):
    """The summary of plain lists of items, each a batch."""
    def made():
        for items in batches:
            n = Counter(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*n, None], pa.string()), pa.array([*n.values(), None], pa.int64()), pa.array([None] * len(n) + [0], pa.int64()), pa.array([None] * len(n) + [len(items)], pa.int64())],
                names=list(Q.SUMMARY),
            )

    return [row for batch in Q._summarize(made(), counters) for row in zip(*(c.to_pylist() for c in batch.columns))]


@pytest.mark.parametrize("seed", range(20))
def test_bounds_of_the_plain_summary(seed):
    draw = random.Random(seed)
    counters = draw.choice([1, 2, 5, 20])
    batches = [[None if x is None else str(x) for x in skewed(draw, draw.randrange(1, 300), 60)] for _ in range(draw.randrange(1, 8))]
    rows = summary_rows(batches, counters)
    exact = Counter(item for items in batches for item in items)
    total = sum(exact.values())
    ((_, _, missed, counted),) = [row for row in rows if row[1] is None]
    found = {item: n for item, n, _, _ in rows if n is not None}
    assert counted == total and len(found) <= counters and missed * (counters + 1) <= total
    for item, n in exact.items():
        assert found.get(item, 0) <= n <= found.get(item, 0) + missed
        assert n * (counters + 1) <= total or item in found


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_merged_summaries_keep_the_bounds(spark, parts):
    draw = random.Random(parts)
    items = [str(x) if x is not None else None for x in skewed(draw, 4_000, 500)]
    df = spark.createDataFrame([(x,) for x in items], "k string").repartition(parts)
    exact, counters = Counter(items), 30
    rows = {r["item"]: (r["lower"], r["upper"], r["rows"]) for r in Q.bounds(Q.merged(Q.summary_of(df, "k", counters), counters, fan_in=3)).collect()}
    assert len(rows) <= counters and all(total == len(items) for _, _, total in rows.values())
    assert all(low <= exact[item] <= high for item, (low, high, _) in rows.items())
    assert all(item in rows for item, n in exact.items() if n * (counters + 1) > len(items))


def test_frequent_items_against_counts(spark, sf_dir):
    cart = datasets.cart(spark, sf_dir)
    one_in = 150
    exact = {r["courseid"]: r["count"] for r in cart.groupBy("courseid").count().collect()}
    total = sum(exact.values())
    rows = Q.frequent_items(cart, "courseid", one_in, counters=160).collect()
    assert {r["item"]: r["cnt"] for r in rows} == {k: n for k, n in exact.items() if n * one_in > total}
    assert rows and all(r["lower"] <= r["cnt"] <= r["upper"] and r["rows"] == total for r in rows)
    candidates = Q.frequent_items(cart, "courseid", one_in, counters=160, exact=False)
    assert {r["item"] for r in rows} <= {r["item"] for r in candidates.collect()}


def test_summaries_of_days_merge(spark, sf_dir):
    """Summaries kept apart, united later, tell the same hot keys."""
    cart = datasets.cart(spark, sf_dir)
    kept = [Q.merged(Q.summary_of(cart.where(F.col("dt") == day), "courseid", 400), 400) for day in ("d0", "d1", "d2", "d3")]
    united = kept[0]
    for one in kept[1:]:
        united = united.union(one)
    rows = {r["item"]: r for r in Q.bounds(Q.merged(united, 400)).collect()}
    exact = {r["courseid"]: r["count"] for r in cart.groupBy("courseid").count().collect()}
    assert all(row["lower"] <= exact[item] <= row["upper"] for item, row in rows.items())


def test_null_is_an_item(spark):
    df = spark.createDataFrame([(None,)] * 30 + [(1,)] * 5 + [(i,) for i in range(2, 12)], "k bigint")
    rows = Q.frequent_items(df, "k", 3).collect()
    assert [(r["item"], r["cnt"]) for r in rows] == [(None, 30)]


def test_empty(spark):
    df = spark.createDataFrame([], "k bigint")
    assert Q.frequent_items(df, "k", 3).count() == 0


def test_too_few_counters(spark):
    with pytest.raises(ValueError):
        Q.frequent_items(spark.range(3), "id", 100, counters=50)


def test_only_summaries_are_shuffled(spark, sf_dir):
    """The first pass has no exchange of the table's keys."""
    plan = Q.summary_of(datasets.cart(spark, sf_dir), "courseid")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
