"""Projections, filters, aggregations, sorts and set operations."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.registry import query, sql_bucket, sql_integer_hash
from brindle.functions import HASH_BITS
from brindle.operators import aggregates, ordering, rows, sets
from brindle.plans import shared_dir

BUCKETS = 16
PAGE = 500  # distinct values in a row of a grouped array
ZERO = 10


@query(
    "map_project",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity * 2 AS DOUBLE) AS doubled FROM lineitem",
)
def map_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 2).alias("doubled"))


@query("partition_map", "SELECT l_orderkey, CAST(l_quantity * 2 AS DOUBLE) AS doubled FROM lineitem")
def partition_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same doubling partition by partition in Python, on Arrow batches."""

    def double(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            doubled = pc.multiply(batch.column("l_quantity"), 2.0)
            yield pa.RecordBatch.from_arrays([batch.column("l_orderkey"), doubled], names=["l_orderkey", "doubled"])

    lineitem = datasets.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return rows.map_partitions(lineitem, double, "l_orderkey bigint, doubled double")


@query(
    "filter_odd",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber % 2 <> 0",
)
def filter_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lineitem.filter(F.col("l_linenumber") % 2 != 0)


# ---- buckets ---------------------------------------------------------------


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return rows.tag_bucket(
        lineitem.select("l_orderkey", F.col("l_partkey").alias("value")), "l_orderkey", BUCKETS
    )


_BUCKETED = f"(SELECT l_orderkey, l_partkey AS value, {sql_bucket('l_orderkey', BUCKETS)} AS bucket FROM lineitem)"


@query("bucket_tag", f"SELECT l_orderkey, value, bucket FROM {_BUCKETED}")
def bucket_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucketed(spark, sf_dir)


@query(
    "bucket_only",
    f"SELECT l_orderkey, l_partkey FROM lineitem WHERE {sql_bucket('l_orderkey', BUCKETS)} = 1",
)
def bucket_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return rows.only_bucket(lineitem, "l_orderkey", BUCKETS, 1)


@query("bucket_max", f"SELECT bucket, max(value) AS max_value FROM {_BUCKETED} GROUP BY bucket")
def bucket_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.bucket_maxima(_bucketed(spark, sf_dir), "bucket", "value")


@query(
    "bucket_max_sum",
    f"""
    SELECT CAST(sum(max_value) AS BIGINT) AS sum_of_maxima
    FROM (SELECT max(value) AS max_value FROM {_BUCKETED} GROUP BY bucket)
    """,
)
def bucket_max_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    maxima = aggregates.bucket_maxima(_bucketed(spark, sf_dir), "bucket", "value")
    return maxima.agg(F.sum("max_value").alias("sum_of_maxima"))


def _group_oracle(source: str) -> str:
    """Pages of the groups of ``source`` (columns key, value)."""
    return f"""
    WITH counted AS (SELECT key, value, count(*) AS copies FROM ({source}) GROUP BY key, value),
    placed AS (
        SELECT *, (row_number() OVER (PARTITION BY key ORDER BY value NULLS FIRST) - 1) // {PAGE} AS page FROM counted
    )
    SELECT key, CAST(page AS INTEGER) AS page,
           string_agg(CAST(value AS VARCHAR) || 'x' || CAST(copies AS VARCHAR), ',' ORDER BY value) AS entries,
           CAST(sum(copies) AS BIGINT) AS cnt
    FROM placed GROUP BY key, page
    """


def _grouped(pairs: DataFrame) -> DataFrame:
    out = aggregates.group_values(pairs, "key", "value", PAGE)
    return out.withColumn("entries", aggregates.entries_text(F.col("entries")))


@query("bucket_values", _group_oracle(f"SELECT bucket AS key, value FROM {_BUCKETED}"))
def bucket_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of each bucket as arrays."""
    return _grouped(_bucketed(spark, sf_dir).select(F.col("bucket").alias("key"), "value"))


# ---- aggregations ----------------------------------------------------------


@query(
    "reduce_by_key",
    "SELECT l_suppkey AS key, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1",
)
def reduce_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return lineitem.groupBy(F.col("l_suppkey").alias("key")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total"))


@query("group_values", _group_oracle("SELECT l_suppkey AS key, CAST(l_quantity AS BIGINT) AS value FROM lineitem"))
def group_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return _grouped(lineitem.select(F.col("l_suppkey").alias("key"), F.col("l_quantity").cast("bigint").alias("value")))


@query("group_by_expression", _group_oracle("SELECT l_linenumber % 2 AS key, l_partkey AS value FROM lineitem"))
def group_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two groups that each hold half of all rows."""
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return _grouped(lineitem.select((F.col("l_linenumber") % 2).alias("key"), F.col("l_partkey").alias("value")))


@query("count_by_key", "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS cnt FROM lineitem GROUP BY 1")
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_by(datasets.table(spark, sf_dir, "lineitem"), "l_suppkey")


@query(
    "count_by_value",
    "SELECT l_suppkey, l_quantity, CAST(count(*) AS BIGINT) AS cnt FROM lineitem GROUP BY 1, 2",
)
def count_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_by(datasets.table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")


@query(
    "global_stats",
    "SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS row_count FROM lineitem",
)
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = datasets.table(spark, sf_dir, "lineitem")
    return lineitem.agg(F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.count(F.lit(1)).alias("row_count"))


@query(
    "zero_value_fold",
    f"""
    SELECT CAST(sum(part) + {ZERO} + {ZERO} * ({BUCKETS} - count(*)) AS BIGINT) AS total
    FROM (SELECT sum(value) + {ZERO} AS part FROM {_BUCKETED} GROUP BY bucket)
    """,
)
def zero_value_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.zero_value_sum(_bucketed(spark, sf_dir), "value", ZERO, BUCKETS)


@query("distinct_values", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.distinct_rows(datasets.table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


# ---- sorts and top-k -------------------------------------------------------


@query(
    "sort_strings",
    "SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderkey FROM orders ORDER BY key, o_orderkey",
)
def sort_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text order ("11" before "2"); the unique second column splits a hot key."""
    orders = datasets.table(spark, sf_dir, "orders")
    return ordering.sort_rows(orders.select(F.col("o_custkey").cast("string").alias("key"), "o_orderkey"), "key", "o_orderkey")


_TAKEN = "SELECT o_totalprice, o_orderkey FROM orders ORDER BY"


@query(
    "take_ordered",
    f"""
    SELECT 'smallest' AS what, * FROM ({_TAKEN} o_totalprice, o_orderkey LIMIT 3)
    UNION ALL SELECT 'largest', * FROM ({_TAKEN} o_totalprice DESC, o_orderkey LIMIT 3)
    UNION ALL SELECT 'first', * FROM ({_TAKEN} o_orderkey LIMIT 1)
    UNION ALL SELECT 'take', * FROM ({_TAKEN} o_orderkey LIMIT 2)
    """,
)
def take_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = datasets.table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    parts = {
        "smallest": ordering.smallest(orders, 3, price.asc(), key.asc()),
        "largest": ordering.smallest(orders, 3, price.desc(), key.asc()),
        "first": ordering.smallest(orders, 1, key.asc()),
        "take": ordering.smallest(orders, 2, key.asc()),
    }
    out = None
    for what, part in parts.items():
        part = part.select(F.lit(what).alias("what"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "zip_rows",
    """
    SELECT position, by_price, by_date
    FROM (SELECT o_orderkey AS by_price, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders)
    JOIN (SELECT o_orderkey AS by_date, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS position FROM orders)
    USING (position)
    """,
)
def zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by price next to orders by date."""
    orders = datasets.table(spark, sf_dir, "orders")
    by_price = orders.select(F.col("o_orderkey").alias("by_price"), "o_totalprice")
    by_date = orders.select(F.col("o_orderkey").alias("by_date"), "o_orderdate")
    paired = ordering.zip_rows(by_price, by_date, ["o_totalprice", "by_price"], [F.desc("o_orderdate"), "by_date"])
    return paired.select("position", "by_price", "by_date")


# ---- sets ------------------------------------------------------------------

# Both operands have duplicates or NULLs: users are known for views only, suppliers
# count only while in credit.
_LEFT = "(SELECT CASE WHEN event_type = 'view' THEN user_id END AS id FROM events)"
_RIGHT = "(SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey END AS id FROM supplier)"


def _operands(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events, supplier = datasets.table(spark, sf_dir, "events"), datasets.table(spark, sf_dir, "supplier")
    left = events.select(F.when(F.col("event_type") == "view", F.col("user_id")).alias("id"))
    return left, supplier.select(F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("id"))


@query("set_union", f"SELECT id FROM {_LEFT} UNION ALL SELECT id FROM {_RIGHT}")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.union_all(*_operands(spark, sf_dir))


@query("set_intersect", f"SELECT id FROM {_LEFT} INTERSECT SELECT id FROM {_RIGHT}")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.intersection(*_operands(spark, sf_dir))


@query(
    "set_subtract",
    f"SELECT l.id FROM {_LEFT} l WHERE NOT EXISTS (SELECT 1 FROM {_RIGHT} r WHERE l.id IS NOT DISTINCT FROM r.id)",
)
def set_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.subtract(*_operands(spark, sf_dir))


# ---- samples ---------------------------------------------------------------

FRACTION, SEED = 0.4, 1


@query(
    "sample_rows",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE {sql_integer_hash('o_orderkey', SEED)} < {FRACTION} * 2.0::DOUBLE ** {HASH_BITS}",
)
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = datasets.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return rows.sample_rows(orders, "o_orderkey", FRACTION, SEED)


# ---- binary round trips ----------------------------------------------------


@query("parquet_round_trip", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows to binary files and back."""
    path = shared_dir(spark, "typed")
    orders = datasets.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    orders.write.parquet(path)
    return spark.read.schema(orders.schema).parquet(path)


@query("sequence_file_round_trip", "SELECT o_orderkey AS key, o_orderpriority AS value FROM orders")
def sequence_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brindle.sinks import read_sequence_file, write_sequence_file

    path = shared_dir(spark, "sequence")
    write_sequence_file(datasets.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), path)
    return read_sequence_file(spark, path, "key bigint, value string")
