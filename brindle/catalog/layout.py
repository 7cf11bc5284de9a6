"""Queries that write tables or files and read them back."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.joins import BUCKET_JOIN_SQL
from brindle.catalog.registry import query, sql_bucket, with_ctes
from brindle.operators import sales
from brindle.operators.joins import coalesced_buckets
from brindle.operators.rows import fan_out_of, route_rows
from brindle.operators.skew import HotKeys, find_hot_keys
from brindle.plans import broadcast_if_small, materialize, shared_dir, table_name
from brindle.sinks import (
    append_table,
    compact_files,
    deliver,
    insert_by_name,
    overwrite_partitions,
    overwrite_table_partitions,
    overwrite_table_partitions_sql,
    read_delivered,
    replace_table,
    save_bucketed,
    save_bucketed_apart,
    save_partitioned,
    table_partitions,
    write_text,
)
from brindle.sources import infer_json, people, read_json, split_corrupt

PARTITIONS = ("dt", "dn")
ROWS_PER_FILE = 4_000_000
PAY_SCHEMA = "orderid bigint, pay_discount string, paymoney decimal(18,2), pay_createtime string, dt string, dn string"

_PAY = "orderid, pay_discount, paymoney, pay_createtime, dt, dn"
_CART = "courseid, orderid, coursename, cart_discount, sellmoney, cart_createtime, dt, dn"


# ---- JSON ------------------------------------------------------------------


def _pay_json(spark: SparkSession, sf_dir: str) -> str:
    """Payments as JSON lines; pending orders come as lines cut short."""
    good = datasets.pay(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    cut = (
        datasets.table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.concat(F.lit('{"orderid": '), F.col("o_orderkey").cast("string"), F.lit(', "paymoney"')).alias("value"))
    )
    path = shared_dir(spark, "json")
    write_text(good.unionByName(cut), path)
    return path


@query("json_ingest", with_ctes("pay", f"SELECT {_PAY} FROM pay"))
def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines to a Parquet table partitioned by day and site."""
    good, _ = split_corrupt(read_json(spark, _pay_json(spark, sf_dir), PAY_SCHEMA))
    return save_partitioned(good, table_name("pay"), PARTITIONS, shared_dir(spark, "pay"))


@query(
    "json_rejects",
    """SELECT '{"orderid": ' || CAST(o_orderkey AS VARCHAR) || ', "paymoney"' AS line FROM orders WHERE o_orderstatus = 'P'""",
)
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_corrupt(read_json(spark, _pay_json(spark, sf_dir), PAY_SCHEMA))
    # The second column keeps the scan from being pruned to the corrupt record alone.
    return rejected.select(F.coalesce(F.col("_corrupt_record"), F.col("dt")).alias("line"))


def mixed_json(spark: SparkSession, sf_dir: str) -> list[str]:
    """Payments as JSON lines in two folders that do not agree.

    In the first ``pay_discount`` is a text, in the second a number; only the second has
    a ``note``, and only for urgent orders; both have lines that are no objects.
    """
    pay = datasets.pay(spark, sf_dir)
    first, second = pay.where(F.col("dn") == "webA"), pay.where(F.col("dn") == "webB")
    coded = second.withColumns(
        {
            "pay_discount": F.substring("pay_discount", 1, 1).cast("int"),
            "note": F.when(F.col("pay_discount") == "1-URGENT", F.concat(F.lit("order "), F.col("orderid").cast("string"))),
        }
    )
    paths = [shared_dir(spark, "mixed-json") for _ in range(2)]
    for frame, path, odd in ((first, paths[0], "[1, 2"), (coded, paths[1], '"text"')):
        lines = frame.select(F.to_json(F.struct("*")).alias("value"))
        odd_lines = frame.where(F.col("orderid") < 0).select(F.concat(F.lit(odd), F.lit(" ")).alias("value"))
        write_text(lines.unionByName(odd_lines), path)
    return paths


@query(
    "json_infer",
    with_ctes(
        "pay",
        """
        SELECT orderid, CASE WHEN dn = 'webA' THEN pay_discount ELSE substr(pay_discount, 1, 1) END AS pay_discount, paymoney,
               pay_createtime, CASE WHEN dn = 'webB' AND pay_discount = '1-URGENT' THEN 'order ' || CAST(orderid AS VARCHAR) END AS note, dt, dn
        FROM pay
        """,
    ),
)
def json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments, read without a schema; the width of the money follows the data, so it is made that of the table."""
    rows = infer_json(spark, mixed_json(spark, sf_dir)).rows
    return rows.withColumn("paymoney", F.col("paymoney").cast(datasets.MONEY))


@query(
    "json_infer_fields",
    with_ctes(
        "pay",
        """
        SELECT 'dn' AS field, 'STRING' AS kinds, false AS conflict, CAST(count(*) AS BIGINT) AS lines FROM pay
        UNION ALL SELECT 'dt', 'STRING', false, count(*) FROM pay
        UNION ALL SELECT 'orderid', 'BIGINT', false, count(*) FROM pay
        UNION ALL SELECT 'pay_createtime', 'STRING', false, count(*) FROM pay
        UNION ALL SELECT 'pay_discount', 'BIGINT,STRING', true, count(*) FROM pay
        UNION ALL SELECT 'paymoney', 'DECIMAL', false, count(*) FROM pay
        UNION ALL SELECT 'note', 'STRING', false, count(*) FROM pay WHERE dn = 'webB' AND pay_discount = '1-URGENT'
        """,
    ),
)
def json_infer_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fields of the same lines are, and which do not agree."""
    fields = infer_json(spark, mixed_json(spark, sf_dir)).fields
    return fields.select("field", F.array_join("kinds", ",").alias("kinds"), "conflict", "lines")


# ---- buckets ---------------------------------------------------------------

ROWS_PER_BUCKET = 1_000_000  # about 40 MB of cart rows shuffled: one task writes a bucket, and one joins it
MIN_BUCKETS = 5


def bucket_count(rows: int) -> int:
    """Buckets for a table of so many rows: their number, and with it that of the tasks of a join, grows with the table."""
    return max(MIN_BUCKETS, ceil(rows / ROWS_PER_BUCKET))


def bucket_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str, HotKeys]:
    """Cart and payments partitioned by day and site, bucketed and sorted on the order.

    The names of the tables, and the orders too frequent for a bucket, whose cart rows
    stand apart.  The number of buckets follows the size of the cart.
    """
    cart, pay = datasets.cart(spark, sf_dir), datasets.pay(spark, sf_dir)
    rows = cart.count()
    buckets = bucket_count(rows)
    hot = find_hot_keys(cart, ["orderid"], rows_per_task=max(1, ceil(rows / buckets)))
    names = table_name("cart"), table_name("pay")
    save_bucketed_apart(cart, names[0], buckets, hot, shared_dir(spark, "cart"), PARTITIONS)
    save_bucketed(pay, names[1], buckets, "orderid", shared_dir(spark, "pay"), PARTITIONS)
    return *names, hot


@query("bucket_join", BUCKET_JOIN_SQL)
def bucket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    cart, pay, hot = bucket_tables(spark, sf_dir)
    return sales.bucketed_course_sales(
        datasets.sale_course(spark, sf_dir),
        datasets.with_row_id(spark.table(cart)),
        datasets.with_row_id(spark.table(f"{cart}_hot")),
        spark.table(pay),
        hot,
        datasets.ROW_ID,
    )


def unequal_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Cart and payments bucketed on the order: the cart in four times as many buckets."""
    names = table_name("cart"), table_name("pay")
    cart, pay = datasets.cart(spark, sf_dir), datasets.pay(spark, sf_dir)
    buckets = bucket_count(pay.count())
    save_bucketed(cart, names[0], 4 * buckets, "orderid", shared_dir(spark, "cart"))
    save_bucketed(pay, names[1], buckets, "orderid", shared_dir(spark, "pay"))
    return names


def unequal_join(spark: SparkSession, cart: str, pay: str) -> DataFrame:
    paid = spark.table(pay).select("orderid", "paymoney", "pay_createtime")
    return spark.table(cart).select("courseid", "orderid", "sellmoney").join(paid, "orderid")


@query(
    "unequal_bucket_join",
    with_ctes("cart pay", "SELECT c.orderid, courseid, sellmoney, paymoney, pay_createtime FROM cart c JOIN pay p ON c.orderid = p.orderid"),
)
def unequal_bucket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of 20 and 5 buckets (more, where they are large) joined without a shuffle: four buckets are read as one."""
    names = unequal_tables(spark, sf_dir)
    with coalesced_buckets(spark):
        return materialize(unequal_join(spark, *names), "unequal")


# ---- partition pruning -----------------------------------------------------


def year_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders partitioned by year, and a table of the years with their length."""
    orders = datasets.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    fact = save_partitioned(orders, table_name("orders"), ["year"], shared_dir(spark, "orders"))
    years = fact.select("year").distinct()
    days = F.dayofyear(F.make_date("year", F.lit(12), F.lit(31)))
    dim = replace_table(years.withColumn("days", days), table_name("years"), shared_dir(spark, "years"))
    return fact, dim


@query(
    "partition_pruned_join",
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(366 AS INTEGER) AS days FROM orders
    WHERE dayofyear(make_date(year(o_orderdate), 12, 31)) = 366
    """,
)
def partition_pruned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of leap years: the filter on the year table prunes order partitions.

    The year table has one row per partition of the fact table.
    """
    fact, dim = year_tables(spark, sf_dir)
    leap = dim.filter(F.col("days") == 366)
    return fact.join(broadcast_if_small(leap), "year").select("o_orderkey", "o_totalprice", "year", "days")


# ---- partitioned writes ----------------------------------------------------

RENEWED = ("d0", "d2")


def _renewed_cart(spark: SparkSession, sf_dir: str, rows_per_file: int | None) -> DataFrame:
    """A folder of stale cart rows in all partitions, in which two days are overwritten."""
    path = shared_dir(spark, "dynamic")
    cart = datasets.cart(spark, sf_dir)
    overwrite_partitions(cart.withColumn("coursename", F.lit("stale")), path, PARTITIONS, rows_per_file)
    overwrite_partitions(cart.filter(F.col("dt").isin(*RENEWED)), path, PARTITIONS, rows_per_file)
    return spark.read.schema(cart.schema).parquet(path)


_RENEWED_SQL = with_ctes(
    "cart",
    f"""
    SELECT courseid, orderid, CASE WHEN dt IN {RENEWED} THEN coursename ELSE 'stale' END AS coursename,
           cart_discount, sellmoney, cart_createtime, dt, dn FROM cart
    """,
)


@query("dyn_partition_write", _RENEWED_SQL)
def dyn_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite some partitions in one write, with files of bounded size."""
    return _renewed_cart(spark, sf_dir, ROWS_PER_FILE)


@query("dyn_partition_rebalance", _RENEWED_SQL)
def dyn_partition_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with files as large as the tasks that write them."""
    return _renewed_cart(spark, sf_dir, None)


def _renewed_cart_table(spark: SparkSession, sf_dir: str) -> str:
    """A catalog table of stale cart rows, in which two days are overwritten and one is new.

    One day comes by a statement with the day given, the others as a frame whose columns
    stand in another order.  Day ``d9`` is a partition the table did not have.
    """
    name = table_name("cart")
    cart = datasets.cart(spark, sf_dir)
    save_partitioned(cart.withColumn("coursename", F.lit("stale")), name, PARTITIONS, shared_dir(spark, "cart"))
    first, second = RENEWED
    overwrite_table_partitions_sql(cart.filter(F.col("dt") == first).drop("dt"), name, {"dt": first}, ROWS_PER_FILE)
    late = cart.filter(F.col("dt") == second)
    added = cart.filter((F.col("dt") == "d3") & (F.col("dn") == "webA")).withColumn("dt", F.lit("d9"))
    overwrite_table_partitions(late.unionByName(added).select(*sorted(cart.columns)), name, ROWS_PER_FILE)
    return name


@query("table_partition_overwrite", with_ctes("renewed_cart", "SELECT * FROM renewed_cart"))
def table_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite some partitions of a catalog table; the others keep their rows."""
    return spark.table(_renewed_cart_table(spark, sf_dir)).select(*_CART.split(", "))


@query(
    "table_partition_list",
    with_ctes("renewed_cart", "SELECT DISTINCT 'dt=' || dt || '/dn=' || dn AS partition FROM renewed_cart"),
)
def table_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions the catalog knows after the overwrite, the new one among them."""
    return table_partitions(spark, _renewed_cart_table(spark, sf_dir))


@query(
    "compact_files",
    with_ctes("cart", f"SELECT {_CART.replace('dt, dn', '')} lpad(CAST(courseid % 9 AS VARCHAR), 3, '0') AS dt, dn FROM cart"),
)
def compacted_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned write without clustering leaves small files; compact them.

    The days are texts of digits and must stay so.
    """
    scattered, compacted = shared_dir(spark, "scattered"), shared_dir(spark, "compacted")
    cart = datasets.cart(spark, sf_dir)
    cart = cart.withColumn("dt", F.lpad((F.col("courseid") % 9).cast("string"), 3, "0"))
    cart.write.partitionBy(*PARTITIONS).parquet(scattered)
    return compact_files(spark, scattered, compacted, PARTITIONS).select(*cart.columns)


# ---- tables ----------------------------------------------------------------

_ORDER = "o_orderkey, o_custkey, o_orderstatus"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def _old_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tables hold before: every order with another status."""
    return _orders(spark, sf_dir).withColumn("o_orderstatus", F.lit("old"))


@query("table_append", f"SELECT {_ORDER} FROM orders")
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open orders, then all others."""
    name, path = table_name("appended"), shared_dir(spark, "appended")
    is_open = F.col("o_orderstatus").eqNullSafe("O")
    for wanted in (is_open, ~is_open):
        out = append_table(_orders(spark, sf_dir).filter(wanted), name, ["o_orderstatus"], path)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("table_replace", f"SELECT {_ORDER} FROM orders")
def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, path = table_name("replaced"), shared_dir(spark, "replaced")
    replace_table(_old_orders(spark, sf_dir), name, path)
    return replace_table(_orders(spark, sf_dir), name, path)


@query("table_insert_by_name", f"SELECT {_ORDER} FROM orders")
def table_insert_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a table from a frame whose columns stand in another order."""
    name = table_name("inserted")
    replace_table(_old_orders(spark, sf_dir), name, shared_dir(spark, "inserted"))
    return insert_by_name(_orders(spark, sf_dir).select("o_custkey", "o_orderstatus", "o_orderkey"), name)


@query("committed_sink", with_ctes("pay", f"SELECT {_PAY} FROM pay UNION ALL SELECT {_PAY} FROM pay WHERE dn = 'webA'"))
def committed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries to a sink that shows committed rows only, read back."""
    path, pay = shared_dir(spark, "delivery"), datasets.pay(spark, sf_dir)
    deliver(pay, path)
    deliver(pay.where(F.col("dn") == "webA"), path)
    return read_delivered(spark, path, PAY_SCHEMA)


# ---- routing and generated rows --------------------------------------------

@query(
    "custom_partition",
    """
    SELECT event_type, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS route,
           CAST(count(*) AS BIGINT) AS cnt
    FROM events GROUP BY event_type
    """,
)
def custom_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views, clicks and the rest on partitions of their own; shows who landed where."""
    events = datasets.with_row_id(datasets.table(spark, sf_dir, "events")).select("event_type", datasets.ROW_ID)
    route = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    routed = route_rows(events, route, 3, F.col(datasets.ROW_ID))
    landed = F.floor(F.spark_partition_id() / fan_out_of(events, 3)).cast("int").alias("route")
    return routed.select("event_type", landed).groupBy("event_type", "route").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "synth_students",
    f"""
    SELECT c_custkey AS id, 'name' || CAST(c_custkey AS VARCHAR) AS name,
           CAST({sql_bucket('c_custkey', 100, 1)} AS INTEGER) AS age,
           CAST({sql_bucket('c_custkey', 100, 2)} AS INTEGER) AS partition
    FROM customer
    """,
)
def synth_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated student per customer."""
    ids = datasets.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return people(ids, "name", 1)


@query(
    "synth_schools",
    f"""
    SELECT s_suppkey AS id, 'school' || CAST(s_suppkey AS VARCHAR) AS name,
           CAST({sql_bucket('s_suppkey', 100, 4)} AS INTEGER) AS partition
    FROM supplier
    """,
)
def synth_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated school per supplier."""
    ids = datasets.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return people(ids, "school", 3, with_age=False)
