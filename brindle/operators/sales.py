"""Course-sales jobs on the (course, cart, pay) star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.joins import bucketed_left_join, left_join_hot_right
from brindle.operators.skew import HotKeys, find_hot_keys, salted_left_join
from brindle.plans import broadcast_if_small, shuffled_if_large

# The columns of the wide sale detail, in order.
DETAIL_COLUMNS = (
    "courseid",
    "coursename",
    "status",
    "pointlistid",
    "majorid",
    "chapterid",
    "chaptername",
    "edusubjectid",
    "edusubjectname",
    "teacherid",
    "teachername",
    "coursemanager",
    "money",
    "orderid",
    "cart_discount",
    "sellmoney",
    "cart_createtime",
    "pay_discount",
    "paymoney",
    "pay_createtime",
    "dt",
    "dn",
)
COURSE_KEY = ["courseid", "dt", "dn"]
ORDER_KEY = ["orderid", "dt", "dn"]


def sale_detail(course: DataFrame, cart: DataFrame, pay: DataFrame) -> DataFrame:
    """Every cart row with its course and its payment, where there is one.

    The cart is the preserved side of both joins, so adaptive execution can split
    it on a hot course or order.
    """
    return (
        cart.drop("coursename")
        .join(shuffled_if_large(course), COURSE_KEY, "left")
        .join(pay, ORDER_KEY, "left")
        .select(*DETAIL_COLUMNS)
    )


def salted_sale_detail(course: DataFrame, cart: DataFrame, pay: DataFrame, row_id: str, **detector) -> DataFrame:
    """``sale_detail`` with the frequent courses found and spread over salts."""
    fact = cart.drop("coursename")
    hot = find_hot_keys(fact, COURSE_KEY, **detector)
    return (
        salted_left_join(fact, course, hot, F.col(row_id)).join(pay, ORDER_KEY, "left").select(*DETAIL_COLUMNS)
    )


def course_sales(course: DataFrame, cart: DataFrame, pay: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Every course with its cart rows and their payments, joined by id alone.

    Courses without a cart row stay.  Day and site are the course's.  Only where a
    course has ``hot_rows`` cart rows or more (by default what fills a task, by their measured
    width), which one task of an outer join would have to take, are matched and unmatched
    courses computed apart.
    """
    paid = cart.drop("coursename", "dt", "dn").join(pay.drop("dt", "dn"), "orderid", "left")
    if find_hot_keys(cart, ["courseid"], rows_per_task=hot_rows):
        joined = left_join_hot_right(course, paid, ["courseid"], right_keys=cart)
    else:
        joined = course.join(paid, "courseid", "left")
    return joined.select(*DETAIL_COLUMNS)


def bucketed_course_sales(
    course: DataFrame, cart: DataFrame, apart: DataFrame, pay: DataFrame, hot: HotKeys, row_id: str
) -> DataFrame:
    """Cart and payment tables bucketed on the order, joined without a shuffle, then
    the course added to every cart row.  ``apart`` holds the cart rows of hot orders.
    """
    unused = ("coursename", "dt", "dn")
    paid = bucketed_left_join(cart.drop(*unused), apart.drop(*unused), pay.drop("dt", "dn"), hot, F.col(row_id))
    return paid.join(broadcast_if_small(course), "courseid", "left").select(*DETAIL_COLUMNS)


def course_revenue(course: DataFrame, cart: DataFrame) -> DataFrame:
    """Total cart money per course and name.

    Money is summed per course, day and site before the join: the join then moves
    one row per key and no key is hot.
    """
    sold = cart.groupBy(*COURSE_KEY).agg(F.sum("sellmoney").cast("decimal(38,2)").alias("sold"))
    return (
        shuffled_if_large(course.select(*COURSE_KEY, "coursename"))
        .join(sold, COURSE_KEY)
        .groupBy("courseid", "coursename")
        .agg(F.sum("sold").cast("decimal(38,2)").alias("total_sell"))
    )
