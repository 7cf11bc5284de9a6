"""Aggregates kept as states against the aggregate of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog import logs
from brindle.operators import visits as jobs
from brindle.operators.states import States
from brindle.plans import table_name

SCHEMA = "k string, day string, n bigint, low bigint, high bigint"


def value(states):
    return sorted((tuple(r) for r in states.value().collect()), key=str)


def whole(rows):
    made = {}
    for k, _, n, low, high in rows:
        a, b, c = made.get(k, (0, low, high))
        made[k] = (a + n, min(b, low), max(c, high))
    return sorted(((k, *v) for k, v in made.items()), key=str)


def new_states(spark):
    return States(spark, table_name("states"), ("k",), "day", {"n": "sum", "low": "min", "high": "max"})


def rows_of(draw, days, n):
    return [(draw.choice(["a", "b", None]), draw.choice(days), draw.randrange(9), draw.randrange(99), draw.randrange(99)) for _ in range(n)]


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def test_late_and_repeated_days(spark, frame):
    draw = random.Random(3)
    first, second, late = rows_of(draw, ["d1", "d2"], 40), rows_of(draw, ["d3"], 20), rows_of(draw, ["d1", "d4"], 15)
    states = new_states(spark).create(frame(first))
    assert value(states) == whole(first)
    states.replace(frame(second[:7]))
    assert value(states) == whole(first + second[:7])
    states.merge(frame(late))
    assert value(states) == whole(first + second[:7] + late)
    states.replace(frame(second))  # sent again, whole
    states.replace(frame(second))  # and once more
    assert value(states) == whole(first + second + late)
    by_day = states.value(F.col("day") == "d1").collect()
    assert sorted((tuple(r) for r in by_day), key=str) == whole([row for row in first + late if row[1] == "d1"])


def test_a_merge_reads_the_touched_days_only(spark, frame):
    states = new_states(spark).create(frame([("a", f"d{i}", 1, 1, 1) for i in range(6)]))
    before = {r["day"]: r["file"] for r in states.frame.select("day", F.input_file_name().alias("file")).collect()}
    states.merge(frame([("a", "d2", 1, 0, 2)]))
    after = {r["day"]: r["file"] for r in states.frame.select("day", F.input_file_name().alias("file")).collect()}
    assert {day for day in before if before[day] != after[day]} == {"d2"}
    assert tuple(states.value().first()) == ("a", 7, 0, 2)


def test_packets_in_any_order(spark, frame):
    draw = random.Random(8)
    packets = [rows_of(draw, ["d1", "d2", "d3"], 12) for _ in range(3)]
    results = []
    for order in ((0, 1, 2), (2, 0, 1)):
        states = new_states(spark).create(frame(packets[order[0]]))
        for i in order[1:]:
            states.merge(frame(packets[i]))
        results.append(value(states))
    assert results[0] == results[1] == whole(sum(packets, []))


def test_rows_without_a_part_are_refused(spark, frame):
    with pytest.raises(Exception, match="without day"):
        new_states(spark).of(frame([("a", None, 1, 1, 1)])).collect()


def test_hot_categories_from_states(spark, sf_dir):
    visits = datasets.visits(spark, sf_dir)
    states = logs.delivered_states(spark, visits)
    want = {tuple(r) for r in jobs.category_counts(jobs.category_actions(visits)).collect()}
    assert {tuple(r) for r in states.value().collect()} == want
    assert "events" not in states.value()._jdf.queryExecution().executedPlan().toString()
