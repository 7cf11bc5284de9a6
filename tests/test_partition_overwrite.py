"""Overwriting partitions of a catalog table."""

import os

import pytest

from brindle.plans import scoped_conf, shared_dir, table_name
from brindle.sinks import (
    overwrite_table_partitions,
    overwrite_table_partitions_sql,
    partition_columns,
    replace_table,
    save_partitioned,
    table_partitions,
)

SCHEMA = "v bigint, dt string, dn string"


def rows_of(df):
    return sorted(tuple(r) for r in df.select("v", "dt", "dn").collect())


@pytest.fixture
def table(spark):
    name, path = table_name("parts"), shared_dir(spark, "parts")
    rows = [(i, f"d{i % 3}", f"n{i % 2}") for i in range(12)]
    save_partitioned(spark.createDataFrame(rows, SCHEMA), name, ["dt", "dn"], path)
    return name, path.removeprefix("file:"), rows


def files(path):
    return {os.path.join(folder, f): os.path.getmtime(os.path.join(folder, f)) for folder, _, names in os.walk(path) for f in names if f.startswith("part-")}


def folders(path):
    return {os.path.relpath(os.path.dirname(f), path) for f in files(path)}


def listed(spark, name):
    return {r["partition"] for r in table_partitions(spark, name).collect()}


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC"])
@pytest.mark.parametrize("by_sql", [False, True])
def test_only_named_partitions_change(spark, table, mode, by_sql):
    """Whatever the session says, and the setting is the session's own afterwards."""
    name, path, rows = table
    new = spark.createDataFrame([("n0", 100, "d1"), ("n1", 101, "d7")], "dn string, v bigint, dt string")
    before = files(path)
    with scoped_conf(spark, spark__sql__sources__partitionOverwriteMode=mode):
        (overwrite_table_partitions_sql if by_sql else overwrite_table_partitions)(new, name)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    want = [row for row in rows if row[1:] != ("d1", "n0")] + [(100, "d1", "n0"), (101, "d7", "n1")]
    assert rows_of(spark.table(name)) == sorted(want)
    assert listed(spark, name) == folders(path) == {f"dt={d}/dn={n}" for _, d, n in want}
    untouched = {file: time for file, time in before.items() if "dt=d1/dn=n0" not in file}
    assert untouched.items() <= files(path).items(), "files of other partitions are the same files"


def test_a_plain_insert_under_static_replaces_everything(spark, table):
    """What the scope is for."""
    name, _, _ = table
    with scoped_conf(spark, spark__sql__sources__partitionOverwriteMode="STATIC"):
        spark.createDataFrame([(1, "d1", "n0")], SCHEMA).write.insertInto(name, overwrite=True)
    assert rows_of(spark.table(name)) == [(1, "d1", "n0")]


def test_given_day(spark, table):
    name, _, rows = table
    new = spark.createDataFrame([("n0", 100), ("n5", 101)], "dn string, v bigint")
    overwrite_table_partitions_sql(new, name, {"dt": "d2"})
    want = [row for row in rows if row[1:] != ("d2", "n0")] + [(100, "d2", "n0"), (101, "d2", "n5")]
    assert rows_of(spark.table(name)) == sorted(want)


def test_given_day_and_site(spark, table):
    name, _, rows = table
    overwrite_table_partitions_sql(spark.createDataFrame([(100,)], "v bigint"), name, {"dt": "it's", "dn": "n0"})
    assert rows_of(spark.table(name)) == sorted([*rows, (100, "it's", "n0")])


def test_a_repeated_write_counts_once(spark, table):
    name, _, rows = table
    new = spark.createDataFrame([(100, "d1", "n0"), (100, "d1", "n0")], SCHEMA)
    for _ in range(2):
        overwrite_table_partitions(new, name)
    assert rows_of(spark.table(name)).count((100, "d1", "n0")) == 2


def test_no_rows_change_nothing(spark, table):
    name, _, rows = table
    overwrite_table_partitions(spark.createDataFrame([], SCHEMA), name)
    assert rows_of(spark.table(name)) == sorted(rows)


def test_rows_of_a_partition_may_come_from_the_table(spark, table):
    """The new rows are written apart before they replace what they were read from."""
    from brindle.plans import materialize

    name, _, rows = table
    raised = materialize(spark.table(name).where("dt = 'd1'").selectExpr("v + 1000 AS v", "dt", "dn"))
    overwrite_table_partitions(raised, name)
    assert rows_of(spark.table(name)) == sorted((v + 1000 if dt == "d1" else v, dt, dn) for v, dt, dn in rows)


def test_files_of_bounded_size(spark, table):
    name, path, _ = table
    overwrite_table_partitions(spark.range(50).selectExpr("id AS v", "'d1' AS dt", "'n0' AS dn").coalesce(1), name, rows_per_file=20)
    assert len([f for f in files(path) if "dt=d1/dn=n0" in f]) >= 3


def test_wrong_columns_and_tables_are_refused(spark, table):
    name, _, _ = table
    with pytest.raises(ValueError):
        overwrite_table_partitions(spark.createDataFrame([(1, "d")], "v bigint, dt string"), name)
    with pytest.raises(ValueError):
        overwrite_table_partitions_sql(spark.createDataFrame([(1, "d")], "v bigint, dt string"), name, {"dn": "n0"})
    plain = table_name("plain")
    replace_table(spark.range(3), plain, shared_dir(spark, "plain"))
    with pytest.raises(ValueError):
        overwrite_table_partitions(spark.range(3), plain)
    assert partition_columns(spark, name) == ["dt", "dn"] and partition_columns(spark, plain) == []
