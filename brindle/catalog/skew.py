"""Hot-key queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import datasets
from brindle.catalog.joins import SALE_DETAIL_SQL
from brindle.catalog.registry import query, sql_hash, with_ctes
from brindle.functions import HASH_BITS, register_salt_functions
from brindle.operators import sales
from brindle.operators.frequent import frequent_items
from brindle.operators.skew import key_counts, salted_sum, top_keys, top_keys_of_columns

JOIN_SALTS = 36
SUM_SALTS = 6

_SUM = "CAST(sum(sellmoney) AS DECIMAL(38,2)) AS total_sell"
_PLAIN = f"SELECT courseid, {_SUM} FROM cart WHERE courseid IS NOT NULL GROUP BY courseid"
_PROBES = (("cart", "courseid"), ("sale_course", "courseid"), ("pay", "orderid"), ("cart", "orderid"))


def _probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent keys of each table and key column; each table is read once."""
    columns: dict[str, list[str]] = {}
    for source, key in _PROBES:
        columns.setdefault(source, []).append(key)
    parts = [
        top_keys_of_columns(getattr(datasets, source)(spark, sf_dir), keys, 10).select(F.lit(source).alias("source"), "*")
        for source, keys in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


SAMPLED = 0.4
_SPREAD = {"cart": ("orderid", "courseid", "cart_createtime"), "sale_course": ("courseid", "dt", "dn"), "pay": ("orderid", "dt")}


def _sample_oracle(source: str, key: str) -> str:
    spread = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in _SPREAD[source])
    return f"""
    SELECT '{source}' AS source, '{key}' AS key_column, d.key, drawn,
           CAST(floor(drawn / CAST({SAMPLED} AS DOUBLE)) AS BIGINT) AS estimate,
           CAST(ceil(sqrt(drawn * CAST({1 - SAMPLED} AS DOUBLE)) / CAST({SAMPLED} AS DOUBLE)) AS BIGINT) AS error, cnt
    FROM (SELECT {key} AS key, CAST(count(*) AS BIGINT) AS drawn FROM {source}
          WHERE {sql_hash(spread, 1)} < {SAMPLED} * {2**HASH_BITS} GROUP BY {key} ORDER BY drawn DESC, key LIMIT 10) d
    JOIN (SELECT {key} AS key, CAST(count(*) AS BIGINT) AS cnt FROM {source} GROUP BY {key}) c ON d.key IS NOT DISTINCT FROM c.key
    """


@query("key_skew_sample", with_ctes("cart sale_course pay", "UNION ALL".join(_sample_oracle(*probe) for probe in _PROBES)))
def key_skew_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten keys a sample finds most frequent, with estimate and error, beside their exact counts."""
    parts = []
    for source, key in _PROBES:
        table = getattr(datasets, source)(spark, sf_dir)
        spread = F.concat_ws(":", *[F.col(c).cast("string") for c in _SPREAD[source]])
        found = top_keys(table, key, 10, SAMPLED, spread).withColumnRenamed(key, "key")
        exact = key_counts(table.select(key), key).withColumnRenamed(key, "counted")
        # Ten rows.
        held = exact.join(F.broadcast(found), F.col("key").eqNullSafe(F.col("counted"))).drop("counted")
        parts.append(held.select(F.lit(source).alias("source"), F.lit(key).alias("key_column"), "key", "drawn", "estimate", "error", "cnt"))
    return reduce(DataFrame.unionByName, parts)


ONE_IN = 2000


@query(
    "key_skew_summary",
    with_ctes(
        "cart sale_course pay",
        "UNION ALL".join(
            f"""
            SELECT '{source}' AS source, '{key}' AS key_column, key, cnt, total AS row_count
            FROM (SELECT {key} AS key, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {source} GROUP BY {key})
            WHERE cnt * {ONE_IN} > total
            """
            for source, key in _PROBES
        ),
    ),
)
def key_skew_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key that holds more than one row in 2000, found by a summary of bounded memory and counted after."""
    parts = [
        frequent_items(getattr(datasets, source)(spark, sf_dir), key, ONE_IN).select(
            F.lit(source).alias("source"), F.lit(key).alias("key_column"), F.col("item").alias("key"), "cnt", F.col("rows").alias("row_count")
        )
        for source, key in _PROBES
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "key_skew_exact",
    with_ctes(
        "cart sale_course pay",
        "\nUNION ALL\n".join(
            f"""SELECT * FROM (
                SELECT '{table}' AS source, '{key}' AS key_column, {key} AS key, CAST(count(*) AS BIGINT) AS cnt
                FROM {table} GROUP BY {key} ORDER BY cnt DESC, key LIMIT 10)"""
            for table, key in _PROBES
        ),
    ),
)
def key_skew_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _probe(spark, sf_dir)


@query("salted_agg", with_ctes("cart", _PLAIN))
def salted_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salted_sum(datasets.cart(spark, sf_dir), "courseid", "sellmoney", "total_sell", F.col("orderid"), SUM_SALTS)


@query("salted_agg_top10", with_ctes("cart", f"{_PLAIN} ORDER BY total_sell, courseid LIMIT 10"))
def salted_agg_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten courses that sell least."""
    return salted_agg(spark, sf_dir).orderBy("total_sell", "courseid").limit(10)


@query("salted_agg_sql", with_ctes("cart", _PLAIN))
def salted_agg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through registered SQL functions."""
    register_salt_functions(spark)
    return spark.sql(
        f"""
        SELECT brindle_unsalt_key(salted) AS courseid, CAST(sum(part) AS DECIMAL(38,2)) AS total_sell
        FROM (
            SELECT salted, sum(sellmoney) AS part
            FROM (SELECT brindle_salt_key(courseid, xxhash64(orderid), {SUM_SALTS}) AS salted, sellmoney
                  FROM {{cart}} WHERE courseid IS NOT NULL)
            GROUP BY salted
        )
        GROUP BY brindle_unsalt_key(salted)
        """,
        cart=datasets.cart(spark, sf_dir),
    )


@query("salted_join", SALE_DETAIL_SQL)
def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide sale detail with the most frequent courses spread over salts.

    A sample of the keys finds the hot ones; the ten most frequent are always
    salted, so the query takes this way on even data too.
    """
    return sales.salted_sale_detail(
        datasets.sale_course(spark, sf_dir),
        datasets.cart(spark, sf_dir, row_id=True),
        datasets.pay(spark, sf_dir),
        datasets.ROW_ID,
        at_least=10,
        min_salts=JOIN_SALTS,
        fraction=0.4,
    )
