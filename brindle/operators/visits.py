"""Visit-log and access-log jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.operators.sets import distinct_rows
from brindle.operators.states import States

CLICK, ORDER, PAY = "click", "order", "pay"


def category_actions(visits: DataFrame, exclusive: bool = False) -> DataFrame:
    """One row (category_id, session_id, action) per category a visit acts on.

    By default clicks, orders and payments of a visit all count.  ``exclusive``
    takes a visit's first kind only: click, else order, else pay.
    """
    kind = lambda action, ids: F.struct(F.lit(action).alias("action"), ids.alias("ids"))
    clicked = F.array(F.col("click_category_id"))
    click = kind(CLICK, F.when(F.col("click_category_id").isNotNull(), clicked))
    order, pay = kind(ORDER, F.col("order_category_ids")), kind(PAY, F.col("pay_category_ids"))
    if exclusive:
        kinds = F.array(
            F.when(click["ids"].isNotNull(), click).when(order["ids"].isNotNull(), order).otherwise(pay)
        )
    else:
        kinds = F.array(click, order, pay)
    by_kind = visits.select("session_id", F.explode(kinds).alias("k"))
    return by_kind.select(F.explode("k.ids").alias("category_id"), "session_id", F.col("k.action").alias("action"))


def category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of each category."""
    return actions.groupBy("category_id").agg(
        F.count_if(F.col("action") == CLICK).alias("clicks"),
        F.count_if(F.col("action") == ORDER).alias("orders"),
        F.count_if(F.col("action") == PAY).alias("pays"),
    )


def hottest(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories first by clicks, then orders, payments and id."""
    return counts.orderBy(F.desc("clicks"), F.desc("orders"), F.desc("pays"), F.asc("category_id")).limit(n)


def hot_categories(visits: DataFrame, n: int = 10, exclusive: bool = False) -> DataFrame:
    """The ``n`` hottest categories of all visits."""
    return hottest(category_counts(category_actions(visits, exclusive)), n)


def category_measures(visits: DataFrame) -> DataFrame:
    """One row per category a visit acts on, with its date and 1 under the kind of action: rows for ``category_states``."""
    kinds = F.array(
        *[
            F.struct(ids.alias("ids"), *[F.lit(int(kind == name)).cast("bigint").alias(name) for name in ("clicks", "orders", "pays")])
            for kind, ids in (
                ("clicks", F.when(F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id")))),
                ("orders", F.col("order_category_ids")),
                ("pays", F.col("pay_category_ids")),
            )
        ]
    )
    by_kind = visits.select("date", F.explode(kinds).alias("k"))
    return by_kind.select("date", F.explode("k.ids").alias("category_id"), "k.clicks", "k.orders", "k.pays")


def category_states(spark: SparkSession, name: str) -> States:
    """Clicks, orders and payments of each category and day, kept in a table; ``hottest(states.value())`` reads no visit."""
    return States(spark, name, ("category_id",), "date", {"clicks": "sum", "orders": "sum", "pays": "sum"})


def top_sessions(visits: DataFrame, categories: int = 10, sessions: int = 10, exclusive: bool = False) -> DataFrame:
    """For each hot category the sessions that clicked on it most.

    The hot categories are at most ``categories`` rows, so broadcasting them is
    safe.  Each task cuts a category to ``sessions`` rows before the ranking
    shuffle (a window group limit).
    """
    hot = hot_categories(visits, categories, exclusive).select("category_id")
    clicks = (
        visits.select(F.col("click_category_id").alias("category_id"), "session_id")
        .filter(F.col("category_id").isNotNull())
        .join(F.broadcast(hot), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    best_first = Window.partitionBy("category_id").orderBy(F.desc("clicks"), F.asc("session_id"))
    return clicks.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= sessions)


def distinct_addresses(log: DataFrame, files: int | None = None) -> DataFrame:
    """Client addresses, once each; narrowed to few files only after that."""
    return distinct_rows(log, "ip", files=files)


def visits_per_hour(log: DataFrame) -> DataFrame:
    """Requests by hour of day (unpadded text); lines without a time do not count.

    They are dropped after the aggregate, as their count is 0: a filter before it
    would parse every line twice.
    """
    per_hour = log.groupBy(F.hour("ts").cast("string").alias("hour")).agg(F.count("ts").alias("visits"))
    return per_hour.filter(F.col("visits") > 0)


def urls_on_day(log_lines: DataFrame, day: str) -> DataFrame:
    """URLs requested on a day, one row per request; ``day`` is dd/MM/yyyy."""
    fields = F.split("value", " ")
    return log_lines.filter(F.get(fields, F.lit(3)).startswith(day)).select(F.get(fields, F.lit(6)).alias("url"))


def search(lines: DataFrame, query: str, column: str = "value") -> DataFrame:
    """Rows whose text contains ``query``."""
    return lines.filter(F.col(column).contains(query))
