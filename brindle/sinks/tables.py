"""Catalog tables: create, replace, append, insert, bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from brindle.operators.skew import HotKeys, split_hot
from brindle.plans import scoped_conf


def save_partitioned(
    df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Save as a Parquet table partitioned by columns, clustered by them first.

    The clustering is a rebalance: adaptive execution splits a hot partition and
    merges small ones.  The result is read through the catalog, which keeps the
    types of the partition columns.
    """
    writer = df.hint("rebalance", *partition_by).write.mode(mode).format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(
    df: DataFrame, name: str, buckets: int, key: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Save as a Parquet table bucketed and sorted by ``key``, partitioned as well if wanted.

    The rebalance uses as many partitions as buckets and the same hash, so a task
    holds one bucket and writes one file per table partition; a large bucket is split
    over several tasks.
    """
    writer = df.hint("rebalance", buckets, key).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed_apart(
    df: DataFrame, name: str, buckets: int, hot: HotKeys, path: str | None = None, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``save_bucketed`` without the rows of hot keys, which go to the plain table ``<name>_hot``."""
    common, apart = split_hot(df, hot)
    saved = save_bucketed(common, name, buckets, *hot.keys, path=path, partition_by=partition_by)
    return saved, replace_table(apart, f"{name}_hot", f"{path}-hot" if path else None)


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Append rows; the table is created by the first call."""
    if partition_by:
        return save_partitioned(df, name, partition_by, path, mode="append")
    writer = df.write.mode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Make ``name`` hold the rows of ``df``, whatever it held before."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def insert_by_name(df: DataFrame, name: str, overwrite: bool = True) -> DataFrame:
    """``insertInto`` matches columns by position; line them up by name first."""
    table = df.sparkSession.table(name)
    df.select(*table.columns).write.insertInto(name, overwrite=overwrite)
    return df.sparkSession.table(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns a catalog table is partitioned by, in order."""
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The partitions the catalog knows, one row (``partition``) each."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def _by_name(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the table's columns, in the table's order."""
    wanted = df.sparkSession.table(name).columns
    if sorted(wanted) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {wanted}, the rows have {df.columns}")
    return df.select(*wanted)


@contextmanager
def _dynamic_overwrite(spark: SparkSession, rows_per_file: int | None) -> Iterator[None]:
    """Only partitions that get rows are replaced, whatever the session says; for the writes inside."""
    settings = {"spark__sql__sources__partitionOverwriteMode": "dynamic"}
    if rows_per_file:
        settings["spark__sql__files__maxRecordsPerFile"] = str(rows_per_file)
    with scoped_conf(spark, **settings):
        yield


def _checked_keys(spark: SparkSession, name: str) -> list[str]:
    keys = partition_columns(spark, name)
    if not keys:
        raise ValueError(f"{name} is not partitioned: a dynamic overwrite would replace all of it")
    return keys


def overwrite_table_partitions(df: DataFrame, name: str, rows_per_file: int | None = None) -> DataFrame:
    """Replace in a catalog table just the partitions that occur in ``df``; new ones are registered.

    Columns are matched by name.  The rows are rebalanced by partition, so a hot partition
    gets several tasks and a small one a single file.  A row written again replaces its
    partition again: the write may be repeated after a failure.
    """
    spark = df.sparkSession
    keys = _checked_keys(spark, name)
    with _dynamic_overwrite(spark, rows_per_file):
        _by_name(df, name).hint("rebalance", *keys).write.insertInto(name, overwrite=True)
    return spark.table(name)


def overwrite_table_partitions_sql(df: DataFrame, name: str, fixed: dict[str, str] | None = None, rows_per_file: int | None = None) -> DataFrame:
    """The same as one ``INSERT OVERWRITE ... PARTITION (...)`` statement.

    ``fixed`` gives the values of leading partition columns, which ``df`` then lacks: all
    their partitions that get rows are replaced, and the others found from the rows.
    """
    spark = df.sparkSession
    fixed = fixed or {}
    keys = _checked_keys(spark, name)
    if list(fixed) != keys[: len(fixed)]:
        raise ValueError(f"{name} is partitioned by {keys}: values can be given to the first of these only")
    columns = [c for c in spark.table(name).columns if c not in fixed]
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} needs the columns {columns}, the rows have {df.columns}")
    literal = {key: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for key, value in fixed.items()}
    spec = ", ".join(f"`{key}` = {literal[key]}" if key in fixed else f"`{key}`" for key in keys)
    open_keys = [f"`{key}`" for key in keys if key not in fixed]
    hint = f"/*+ REBALANCE({', '.join(open_keys)}) */ " if open_keys else "/*+ REBALANCE */ "
    shown = ", ".join(f"`{c}`" for c in columns)
    with _dynamic_overwrite(spark, rows_per_file):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {hint}{shown} FROM {{rows}}", rows=df)
    return spark.table(name)


def for_each_partition(
    df: DataFrame,
    opened: Callable[[], Any],
    write: Callable[[Any, Row], None],
    close: Callable[[Any], None],
) -> None:
    """Hand each partition to an external sink: open once, write rows, close.

    A task may run more than once, so ``write`` must be idempotent.
    """

    def deliver(rows: Iterable[Row]) -> None:
        connection = opened()
        try:
            for row in rows:
                write(connection, row)
        finally:
            close(connection)

    df.foreachPartition(deliver)


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; the files of one saved under a path stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
