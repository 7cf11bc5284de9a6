"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.registry import query, with_ctes
from brindle.operators import sales
from brindle.operators.joins import dealt_together, filtered_join, key_join_sql, left_join_hot_right, lookup
from brindle.plans import broadcast_if_small, shuffled_if_large

_DETAIL = """
    c.courseid, s.coursename, s.status, s.pointlistid, s.majorid, s.chapterid, s.chaptername, s.edusubjectid,
    s.edusubjectname, s.teacherid, s.teachername, s.coursemanager, s.money, c.orderid, c.cart_discount, c.sellmoney,
    c.cart_createtime, p.pay_discount, p.paymoney, p.pay_createtime
"""
SALE_DETAIL_SQL = with_ctes(
    "sale_course cart pay",
    f"""
    SELECT {_DETAIL}, c.dt, c.dn
    FROM cart c
    LEFT JOIN sale_course s ON c.courseid = s.courseid AND c.dt = s.dt AND c.dn = s.dn
    LEFT JOIN pay p ON c.orderid = p.orderid AND c.dt = p.dt AND c.dn = p.dn
    """,
)
BUCKET_JOIN_SQL = with_ctes(
    "sale_course cart pay",
    f"""
    SELECT {_DETAIL}, s.dt, s.dn
    FROM cart c LEFT JOIN pay p ON c.orderid = p.orderid LEFT JOIN sale_course s ON c.courseid = s.courseid
    """,
)


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return datasets.sale_course(spark, sf_dir), datasets.cart(spark, sf_dir), datasets.pay(spark, sf_dir)


@query(
    "pair_join",
    """
    SELECT l_suppkey AS key, l_quantity AS left_value, s_acctbal AS right_value
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = datasets.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("key"), F.col("l_quantity").alias("left_value")
    )
    right = datasets.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("right_value")
    )
    return left.join(right, "key")


@query(
    "broadcast_lookup",
    """
    SELECT l_suppkey AS key, l_quantity AS quantity, COALESCE(s_acctbal, 0.0) AS balance
    FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey
    """,
)
def broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of suppliers in credit, 0 for the others."""
    fact = datasets.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("key"), F.col("l_quantity").alias("quantity")
    )
    dim = (
        datasets.table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") > 0)
        .select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    )
    return lookup(fact, dim, "key", "balance", 0.0)


@query("sale_detail", SALE_DETAIL_SQL)
def sale_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sale_detail(*_star(spark, sf_dir))


@query(
    "big_table_join",
    with_ctes(
        "sale_course cart pay",
        f"""
        SELECT {_DETAIL.replace('c.courseid', 's.courseid')}, s.dt, s.dn
        FROM sale_course s
        LEFT JOIN cart c ON c.courseid = s.courseid
        LEFT JOIN pay p ON c.orderid = p.orderid
        """,
    ),
)
def big_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.course_sales(*_star(spark, sf_dir))


@query(
    "course_revenue",
    with_ctes(
        "sale_course cart",
        """
        SELECT s.courseid, s.coursename, CAST(sum(c.sellmoney) AS DECIMAL(38,2)) AS total_sell
        FROM sale_course s JOIN cart c ON s.courseid = c.courseid AND s.dt = c.dt AND s.dn = c.dn
        GROUP BY s.courseid, s.coursename
        """,
    ),
)
def course_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    course, cart, _ = _star(spark, sf_dir)
    return sales.course_revenue(course, cart)


# ---- SQL joins on one key --------------------------------------------------

_SOLD_SQL = with_ctes(
    "sale_course cart",
    "SELECT o.courseid AS offered, s.courseid AS sold FROM sale_course AS o, cart AS s WHERE o.courseid = s.courseid",
)


def _ids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    course, cart, _ = _star(spark, sf_dir)
    return course.select("courseid"), cart.select("courseid")


def _sold(spark: SparkSession, sf_dir: str, hint: str | None) -> DataFrame:
    offers, sales_of = _ids(spark, sf_dir)
    return key_join_sql(offers.toDF("offered"), sales_of.toDF("sold"), {"offered": "sold"}, hint)


@query("inner_join_sql", _SOLD_SQL)
def inner_join_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir, None)


@query("hint_join", _SOLD_SQL)
def hint_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir, "BROADCAST")


@query("hint_join_broadcastjoin", _SOLD_SQL)
def hint_join_broadcastjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir, "BROADCASTJOIN")


@query("hint_join_mapjoin", _SOLD_SQL)
def hint_join_mapjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir, "MAPJOIN")


@query(
    "hint_join_api",
    with_ctes("sale_course cart", "SELECT courseid FROM sale_course JOIN cart USING (courseid)"),
)
def hint_join_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    course, cart = _ids(spark, sf_dir)
    return broadcast_if_small(course).join(cart, "courseid").select("courseid")


# ---- where an outer join's predicate stands --------------------------------

# A predicate on the left (course) and one on the right (cart) side.
STATUS = "ECONOMY"
LEFT_PREDICATE = f"l.status = '{STATUS}'"
RIGHT_PREDICATE = "r.cart_discount < (2 + 3) / 100D"
_ORACLE_RIGHT = "r.cart_discount < CAST(0.05 AS DOUBLE)"
_ON = "l.courseid = r.courseid AND l.dt = r.dt AND l.dn = r.dn"
_SHOWN = "l.courseid, l.coursename, r.courseid AS cart_course_id, r.coursename AS cart_course_name"


def predicate_sql(kind: str, extra_on: str = "", where: str = "", left: str = "{course}", right: str = "{cart}") -> str:
    extra = f" AND {extra_on}" if extra_on else ""
    return f"SELECT {_SHOWN} FROM {left} l {kind} JOIN {right} r ON {_ON}{extra}" + (f" WHERE {where}" if where else "")


def _oracle(kind: str, extra_on: str = "", where: str = "") -> str:
    return with_ctes("sale_course cart", predicate_sql(kind, extra_on, where, "sale_course", "cart"))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    course, cart, _ = _star(spark, sf_dir)
    return (
        course.select("courseid", "coursename", "status", "dt", "dn"),
        cart.select("courseid", "coursename", "cart_discount", "dt", "dn"),
    )


def _left_join(course: DataFrame, cart: DataFrame, left_condition=None) -> DataFrame:
    """Courses with their cart rows; the cart may be skewed, so matches and
    unmatched courses are computed apart.
    """
    right = cart.select(
        *sales.COURSE_KEY, F.col("courseid").alias("cart_course_id"), F.col("coursename").alias("cart_course_name")
    )
    joined = left_join_hot_right(course, right, sales.COURSE_KEY, left_condition)
    return joined.select("courseid", "coursename", "cart_course_id", "cart_course_name")


@query("left_on_pred", _oracle("LEFT", extra_on=LEFT_PREDICATE))
def left_on_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicate on the left side in ON: all courses stay."""
    course, cart = _sides(spark, sf_dir)
    return _left_join(course, cart, F.col("status") == STATUS)


@query("left_where_pred", _oracle("LEFT", where=LEFT_PREDICATE))
def left_where_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predicate in WHERE: courses are filtered."""
    course, cart = _sides(spark, sf_dir)
    return _left_join(course.filter(F.col("status") == STATUS), cart)


@query("left_on_right_pred", _oracle("LEFT", extra_on=_ORACLE_RIGHT))
def left_on_right_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicate on the right side in ON: it only decides what matches."""
    course, cart = _sides(spark, sf_dir)
    return _left_join(course, cart.filter(F.expr(RIGHT_PREDICATE.replace("r.", ""))))


@query("left_where_right_pred", _oracle("LEFT", where=_ORACLE_RIGHT))
def left_where_right_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In WHERE it rejects the NULLs of unmatched rows: Catalyst makes the join inner."""
    course, cart = _sides(spark, sf_dir)
    return spark.sql(predicate_sql("LEFT", where=RIGHT_PREDICATE), course=shuffled_if_large(course), cart=cart)


@query("inner_pred", _oracle("INNER", extra_on=LEFT_PREDICATE))
def inner_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    course, cart = _sides(spark, sf_dir)
    course = shuffled_if_large(course, joined=course.filter(F.col("status") == STATUS))
    return spark.sql(predicate_sql("INNER", extra_on=LEFT_PREDICATE), course=course, cart=cart)


@query("inner_where_pred", _oracle("INNER", where=LEFT_PREDICATE))
def inner_where_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    course, cart = _sides(spark, sf_dir)
    course = shuffled_if_large(course, joined=course.filter(F.col("status") == STATUS))
    return spark.sql(predicate_sql("INNER", where=LEFT_PREDICATE), course=course, cart=cart)


# ---- join against a filtered side ------------------------------------------

LOW, HIGH = "9000", "9999"


@query(
    "range_right_join",
    with_ctes(
        "cart pay",
        f"""
        SELECT c.orderid, p.pay_discount, p.paymoney, p.pay_createtime, c.courseid, c.cart_discount, c.sellmoney,
               c.cart_createtime, c.dt, c.dn
        FROM (SELECT * FROM pay WHERE CAST(orderid AS VARCHAR) BETWEEN '{LOW}' AND '{HIGH}') p
        RIGHT JOIN cart c ON p.orderid = c.orderid
        """,
    ),
)
def range_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cart rows, with the payments whose order id lies in a range of text.

    No hint: adaptive execution sees how small the filtered side is and may
    broadcast it, and otherwise may split the cart, the preserved side.
    """
    _, cart, pay = _star(spark, sf_dir)
    paid = pay.filter(F.col("orderid").cast("string").between(LOW, HIGH)).drop("dt", "dn")
    return paid.join(cart.drop("coursename"), "orderid", "right")


# ---- join against a selective side -----------------------------------------

PENDING = "P"


def pending_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All line items, and the few orders still pending."""
    lines = datasets.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderid"), "l_linenumber", "l_extendedprice")
    orders = datasets.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == PENDING)
    return lines, orders.select(F.col("o_orderkey").alias("orderid"), "o_custkey", "o_totalprice")


@query(
    "bloom_filtered_join",
    f"""
    SELECT l_orderkey AS orderid, l_linenumber, l_extendedprice, o_custkey, o_totalprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = '{PENDING}'
    """,
)
def bloom_filtered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of pending orders; a Bloom filter of the orders stands at the scan of the items.

    The pending orders are taken for too many to broadcast, whatever their size.
    """
    return filtered_join(*pending_sides(spark, sf_dir), ["orderid"], broadcast_limit=-1)


# ---- one exchange for several operations -----------------------------------


@query(
    "dealt_once",
    with_ctes(
        "cart pay",
        """
        SELECT orderid, CAST(count(*) AS BIGINT) AS items, CAST(sum(sellmoney) AS DECIMAL(38,2)) AS sold,
               CAST(max(place) AS INTEGER) AS dearest_place, paymoney
        FROM (
            SELECT c.orderid, sellmoney, rank() OVER (PARTITION BY c.orderid ORDER BY sellmoney DESC) AS place, paymoney
            FROM cart c JOIN pay p ON c.orderid = p.orderid
        )
        GROUP BY orderid, paymoney
        """,
    ),
)
def dealt_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join, a window and a sum on the order, for which each table is shuffled once."""
    _, cart, pay = _star(spark, sf_dir)
    cart, pay = dealt_together(["orderid"], cart.select("orderid", "sellmoney"), pay.select("orderid", "paymoney"))
    dearest_first = Window.partitionBy("orderid").orderBy(F.desc("sellmoney"))
    ranked = cart.withColumn("place", F.rank().over(dearest_first)).join(pay, "orderid")
    return ranked.groupBy("orderid", "paymoney").agg(
        F.count(F.lit(1)).alias("items"), F.sum("sellmoney").cast("decimal(38,2)").alias("sold"), F.max("place").alias("dearest_place")
    )
