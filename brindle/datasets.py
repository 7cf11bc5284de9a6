"""The job inputs, bound to the tables of a data folder.

Every binding reads its whole table.  Columns a job does not use are pruned by
the optimizer before the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import lines

MONEY = "decimal(18,2)"

ROW_ID = "_row_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_id(scan: DataFrame) -> DataFrame:
    """Add a hash of each row's place in its file.

    Exact copies of a row get different ids, and a task that runs again gets the
    same ids again.  Works on a direct file scan only.
    """
    return scan.withColumn(ROW_ID, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


# The times carry no zone, so they are shown by their text form; ``date_format``
# would take them through the session's zone.
def day_text(time: str) -> Column:
    return F.substring(F.col(time).cast("string"), 1, 10)


def second_text(time: str) -> Column:
    return F.substring(F.col(time).cast("string"), 1, 19)


def log_time_text(time: str) -> Column:
    """dd/MM/yyyy:HH:mm:ss"""
    text = F.col(time).cast("string")
    part = lambda start, length: F.substring(text, start, length)
    return F.concat(part(9, 2), F.lit("/"), part(6, 2), F.lit("/"), part(1, 4), F.lit(":"), part(12, 8))


# ---- visit and access logs -------------------------------------------------


def _category(props: Column) -> Column:
    return F.regexp_extract(props, "([0-9]+)", 1).try_cast("bigint")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User visit actions, typed: missing markers are NULL, id lists are arrays."""
    kind, k = F.col("event_type"), F.col("k")
    text = lambda column: column.cast("string")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _category(F.col("props")))
        .select(
            day_text("ts").alias("date"),
            "user_id",
            F.concat_ws("-", text(F.col("user_id")), day_text("ts")).alias("session_id"),
            (F.col("event_id") % 50).alias("page_id"),
            second_text("ts").alias("action_time"),
            F.when(kind == "error", F.concat(F.lit("word "), text(k))).alias("search_keyword"),
            F.when(kind == "view", text(k)).alias("click_category_id"),
            F.when(kind == "view", F.col("event_id") % 1000).alias("click_product_id"),
            F.when(kind == "click", F.array(text(k), text((k + 1) % 100))).alias("order_category_ids"),
            F.when(kind == "click", F.array(text(F.col("event_id") % 1000), text(k))).alias("order_product_ids"),
            F.when(kind == "purchase", F.array(text(k))).alias("pay_category_ids"),
            F.when(kind == "purchase", F.array(text(F.col("event_id") % 1000))).alias("pay_product_ids"),
            text(F.col("user_id") % 27).alias("city_id"),
        )
    )


def visit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same visits as ``_``-delimited text with in-band missing markers."""
    ids = lambda name: F.coalesce(F.concat_ws(",", name), F.lit("null"))
    listed = lambda name: F.when(F.col(name).isNull(), "null").otherwise(ids(name))
    return visits(spark, sf_dir).select(
        F.concat_ws(
            "_",
            "date",
            F.col("user_id").cast("string"),
            "session_id",
            F.col("page_id").cast("string"),
            "action_time",
            F.coalesce("search_keyword", F.lit("null")),
            F.coalesce("click_category_id", F.lit("-1")),
            F.coalesce(F.col("click_product_id").cast("string"), F.lit("-1")),
            listed("order_category_ids"),
            listed("order_product_ids"),
            listed("pay_category_ids"),
            listed("pay_product_ids"),
            "city_id",
        ).alias("value")
    )


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space-separated access log: field 0 address, 3 time, 6 URL."""
    user = F.col("user_id")
    address = F.concat_ws(
        ".",
        F.lit("10.0"),
        F.floor(user / 256).cast("bigint").cast("string"),
        (user % 256).cast("string"),
    )
    request = F.concat(
        F.lit('"GET /'), "event_type", F.lit("/"), _category(F.col("props")).cast("string"), F.lit(' HTTP/1.1"')
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws(" ", address, F.lit("-"), F.lit("-"), log_time_text("ts"), F.lit("+0000"), request).alias(
            "value"
        )
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    return table(spark, sf_dir, "documents").select(F.explode(lines(F.col("text"))).alias("value"))


# ---- course sales ----------------------------------------------------------

# The days and sites a course is offered on.  Cart rows of day d3
# have no course, so outer joins meet unmatched rows.
OFFER_DAYS = ("d0", "d1", "d2")
OFFER_SITES = ("webA", "webB")


def _day_and_site(order_key: str) -> list[Column]:
    key = F.col(order_key)
    return [
        F.concat(F.lit("d"), (key % 4).cast("string")).alias("dt"),
        F.when(key % 3 == 0, "webA").otherwise("webB").alias("dn"),
    ]


def sale_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses on offer: one row per course, day and site."""
    offers = F.array(*[F.struct(F.lit(dt).alias("dt"), F.lit(dn).alias("dn")) for dt in OFFER_DAYS for dn in OFFER_SITES])
    key = F.col("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .withColumn("offer", F.explode(offers))
        .select(
            key.alias("courseid"),
            F.col("p_name").alias("coursename"),
            F.col("p_type").alias("status"),
            F.col("p_size").cast("bigint").alias("pointlistid"),
            (key % 25).alias("majorid"),
            (key % 12).alias("chapterid"),
            F.concat(F.lit("chapter "), (key % 12).cast("string")).alias("chaptername"),
            (key % 7).alias("edusubjectid"),
            F.concat(F.lit("subject "), (key % 7).cast("string")).alias("edusubjectname"),
            (key % 100).alias("teacherid"),
            F.concat(F.lit("teacher "), (key % 100).cast("string")).alias("teachername"),
            F.col("p_brand").alias("coursemanager"),
            F.col("p_retailprice").cast(MONEY).alias("money"),
            F.col("offer.dt").alias("dt"),
            F.col("offer.dn").alias("dn"),
        )
    )


def cart(spark: SparkSession, sf_dir: str, row_id: bool = False) -> DataFrame:
    """Shopping-cart rows; a bag, no column set is unique.

    ``row_id`` adds the id that tells exact copies apart.
    """
    scan = table(spark, sf_dir, "lineitem")
    if row_id:
        scan = with_row_id(scan)
    return scan.select(
        F.col("l_partkey").alias("courseid"),
        F.col("l_orderkey").alias("orderid"),
        F.concat(F.lit("course "), F.col("l_partkey").cast("string")).alias("coursename"),
        F.col("l_discount").alias("cart_discount"),
        F.col("l_extendedprice").cast(MONEY).alias("sellmoney"),
        day_text("l_shipdate").alias("cart_createtime"),
        *_day_and_site("l_orderkey"),
        *([ROW_ID] if row_id else []),
    )


def pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments, one for each order.

    An order that is not settled goes by an id no cart row has, so outer joins meet
    cart rows without a payment and payments without a cart row.
    """
    settled = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        F.when(settled, F.col("o_orderkey")).otherwise(-1 - F.col("o_orderkey")).alias("orderid"),
        F.col("o_orderpriority").alias("pay_discount"),
        F.col("o_totalprice").cast(MONEY).alias("paymoney"),
        day_text("o_orderdate").alias("pay_createtime"),
        *_day_and_site("o_orderkey"),
    )
