"""Statistics, observed metrics, checkpoints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.registry import query, with_ctes
from brindle.operators import aggregates, profile
from brindle.operators.visits import category_actions
from brindle.plans import checkpointed, materialize, shared_dir, table_name
from brindle.sinks import replace_table

PROFILED = {
    "sale_course": ("courseid", "dt", "dn"),
    "cart": ("courseid", "orderid", "dt", "dn"),
    "pay": ("orderid", "dt", "dn"),
}


def _profile_oracle(source: str, column: str) -> str:
    return f"""
    SELECT '{source}' AS source, '{column}' AS column_name, CAST(count(*) AS BIGINT) AS row_count,
           CAST(count(*) - count({column}) AS BIGINT) AS null_count,
           CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value,
           CAST(sum(length(CAST({column} AS VARCHAR))) AS DOUBLE) / count({column}) AS avg_length,
           CAST(max(length(CAST({column} AS VARCHAR))) AS BIGINT) AS max_length,
           CAST(count(DISTINCT {column}) AS BIGINT) AS distinct_count
    FROM {source}
    """


@query(
    "column_profile",
    with_ctes(
        "sale_course cart pay",
        "UNION ALL".join(_profile_oracle(source, column) for source, columns in PROFILED.items() for column in columns),
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        profile.column_profile(getattr(datasets, source)(spark, sf_dir), columns).select(F.lit(source).alias("source"), "*")
        for source, columns in PROFILED.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _statistics_oracle(column: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, CAST(min({column}) AS VARCHAR) AS min_value,
           CAST(max({column}) AS VARCHAR) AS max_value, CAST(count(*) - count({column}) AS BIGINT) AS null_count
    FROM orders
    """


_ANALYZED = ("o_orderkey", "o_custkey")


@query("table_statistics", "UNION ALL".join(_statistics_oracle(column) for column in _ANALYZED))
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics as the catalog holds them after ANALYZE TABLE."""
    name = table_name("analyzed")
    orders = datasets.table(spark, sf_dir, "orders")
    replace_table(orders.select(*_ANALYZED, "o_orderstatus"), name, shared_dir(spark, "analyzed"))
    profile.analyze(spark, name, _ANALYZED)
    rows = [
        (info["col_name"], info["min"], info["max"], int(info["num_nulls"]))
        for info in profile.catalog_statistics(spark, name, _ANALYZED)
    ]
    return spark.createDataFrame(rows, "column_name string, min_value string, max_value string, null_count bigint")


SMALL_SIZE = 2


def star_tables(spark: SparkSession, sf_dir: str, histogram_bins: int = 64) -> tuple[str, str, str]:
    """Line items, orders and parts as analyzed tables.

    Columns of predicates get histograms, join keys do not: the estimate of a join takes a
    key's histogram as it is, also where a predicate has left few of its values.
    """
    wanted = {
        "lineitem": (("l_orderkey", "l_partkey"), ("l_quantity",)),
        "orders": (("o_orderkey", "o_custkey"), ()),
        "part": (("p_partkey",), ("p_size",)),
    }
    names = []
    for source, (keys, measures) in wanted.items():
        names.append(table_name(source))
        replace_table(datasets.table(spark, sf_dir, source).select(*keys, *measures), names[-1], shared_dir(spark, source))
        profile.analyze(spark, names[-1], keys)
        if measures:
            profile.analyze(spark, names[-1], measures, histogram_bins)
    return tuple(names)


def star_join(spark: SparkSession, lineitem: str, orders: str, part: str) -> DataFrame:
    """Items and orders, then the few small parts: the order written is not the best one."""
    joined = spark.table(lineitem).join(spark.table(orders), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(spark.table(part), F.col("l_partkey") == F.col("p_partkey"))
    return joined.where(F.col("p_size") <= SMALL_SIZE).select("l_orderkey", "o_custkey", "l_partkey", "l_quantity", "p_size")


@query(
    "cost_based_join",
    f"""
    SELECT l_orderkey, o_custkey, l_partkey, l_quantity, p_size
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE p_size <= {SMALL_SIZE}
    """,
)
def cost_based_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables, joined in the order their statistics suggest: first the side that a histogram shows to be small."""
    names = star_tables(spark, sf_dir)
    with profile.cost_based(spark):
        return materialize(star_join(spark, *names), "cost-based")


@query(
    "reused_counts",
    """
    SELECT 'status' AS kind, l_linestatus AS key, CAST(count(*) AS BIGINT) AS cnt FROM lineitem WHERE l_quantity >= 25 GROUP BY l_linestatus
    UNION ALL
    SELECT 'first hundred', CAST(l_partkey AS VARCHAR), CAST(count(*) AS BIGINT) FROM lineitem
    WHERE l_quantity >= 25 AND l_partkey <= 100 GROUP BY l_partkey
    """,
)
def reused_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two counts over one cached frame, which is let go before the rows are used.

    The cache is sorted by part in ranges, so the second count skips batches by their
    minimum and maximum.
    """
    items = datasets.table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 25).select("l_partkey", "l_linestatus")
    with aggregates.reused(items.repartitionByRange("l_partkey").sortWithinPartitions("l_partkey")) as kept:
        return materialize(reused_parts(kept), "counts")


def reused_parts(kept: DataFrame) -> DataFrame:
    count = F.count(F.lit(1)).alias("cnt")
    by_status = kept.groupBy(F.col("l_linestatus").alias("key")).agg(count)
    by_part = kept.where(F.col("l_partkey") <= 100).groupBy(F.col("l_partkey").cast("string").alias("key")).agg(count)
    return by_status.select(F.lit("status").alias("kind"), "*").unionByName(by_part.select(F.lit("first hundred").alias("kind"), "*"))


@query(
    "observed_metrics",
    """
    SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem
    """,
)
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and sum noted on the side while another action runs over the rows."""
    lineitem = datasets.table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("bigint").alias("quantity"))
    frame, metrics = aggregates.observed(
        lineitem, table_name("metrics"), F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("total")
    )
    frame.write.format("noop").mode("overwrite").save()
    seen = metrics.get
    return spark.createDataFrame([(seen["row_count"], seen["total"])], "row_count bigint, total bigint")


@query(
    "checkpointed_counts",
    with_ctes(
        "action",
        """
        SELECT 'category' AS kind, category_id AS key, CAST(count(*) AS BIGINT) AS cnt FROM action GROUP BY category_id
        UNION ALL
        SELECT 'action', action, CAST(count(*) AS BIGINT) FROM action GROUP BY action
        """,
    ),
)
def checkpointed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two counts over category actions whose lineage ends at a checkpoint."""
    actions = checkpointed(category_actions(datasets.visits(spark, sf_dir)).select("category_id", "action"))
    by_category = actions.groupBy(F.col("category_id").alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    by_action = actions.groupBy(F.col("action").alias("key")).agg(F.count(F.lit(1)).alias("cnt"))
    return by_category.select(F.lit("category").alias("kind"), "*").unionByName(
        by_action.select(F.lit("action").alias("kind"), "*")
    )
