"""Salting, hot keys and what adaptive execution makes of skew."""

import pytest
from pyspark.sql import functions as F

from brindle.functions import register_salt_functions
from brindle.operators import sales, skew
from brindle.operators.joins import bucketed_left_join, left_join_hot_right
from brindle.plans import executed_plan, scoped_conf, shared_dir, table_name
from brindle.sinks import save_bucketed, save_bucketed_apart

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
# Thresholds for test-sized data; a partition is split between map tasks, so those
# must not have been merged into one.
SPLIT_SMALL = {
    **NO_BROADCAST,
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def same(left, right):
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return key(left) == key(right)


@pytest.fixture
def carts(rows):
    return rows(
        [(101, "o1", 1), (101, "o2", 2), (102, "o3", 3), (103, "o4", 4), (None, "o5", 5), (103, "o4", 4), (103, "o4", 4)],
        "courseid int, orderid string, n int",
    )


@pytest.fixture
def courses(rows):
    return rows([(101, "maths"), (102, "art"), (101, "more maths")], "courseid int, name string")


def test_salted_join_keeps_unmatched_hot_and_null_keys(carts, courses):
    hot = skew.find_hot_keys(carts, ["courseid"], rows_per_task=2, min_salts=5)
    assert {row[0] for row in hot.frame.collect()} == {101, 103}
    joined = skew.salted_left_join(carts, courses, hot, F.col("orderid"))
    assert same(joined, carts.join(courses, "courseid", "left"))
    assert joined.filter("courseid = 103").count() == 3 and joined.filter("courseid is null").count() == 1
    assert dict(joined.dtypes)["courseid"] == "int"


def test_hot_null_key(rows, courses):
    fact = rows([(None, i) for i in range(50)] + [(101, 99)], "courseid int, n int")
    hot = skew.find_hot_keys(fact, ["courseid"], rows_per_task=10)
    assert hot.null_is_hot and hot.matchable.count() == 0
    assert same(skew.salted_left_join(fact, courses, hot, F.col("n")), fact.join(courses, "courseid", "left"))


def test_no_hot_key_means_a_plain_join(carts, courses):
    hot = skew.find_hot_keys(carts, ["courseid"], rows_per_task=1000)
    assert not hot
    assert same(skew.salted_left_join(carts, courses, hot, F.col("n")), carts.join(courses, "courseid", "left"))


def test_salted_join_on_several_columns(spark, rows):
    fact = spark.range(2000).select(
        F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 40).cast("int").alias("k"),
        F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("dt"),
        F.col("id").alias("n"),
    )
    dim = rows([(k, f"d{d}", f"name {k}") for k in range(0, 40, 2) for d in range(2)] + [(1, "d0", "hot")], "k int, dt string, name string")
    hot = skew.find_hot_keys(fact, ["k", "dt"], rows_per_task=100)
    assert {row[:2] for row in hot.frame.collect()} == {(1, "d0"), (1, "d1")}
    assert same(skew.salted_left_join(fact, dim, hot, F.col("n")), fact.join(dim, ["k", "dt"], "left"))


def test_salts_grow_with_the_key(spark):
    fact = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(2).alias("k"))
    hot = skew.find_hot_keys(fact, ["k"], rows_per_task=50)
    assert {row[0]: row[1] for row in hot.frame.collect()} == {1: 18, 2: 2}


def test_hot_rows_land_on_many_partitions(spark, rows):
    fact = spark.range(4000).select(F.when(F.col("id") >= 0, 1).otherwise(2).alias("k"), F.col("id").alias("n"))
    dim = rows([(1, "one"), (2, "two")], "k int, name string")
    hot = skew.find_hot_keys(fact, ["k"], rows_per_task=100)
    with scoped_conf(spark, **NO_BROADCAST, spark__sql__adaptive__enabled="false"):
        joined = skew.salted_left_join(fact, dim, hot, F.col("n"))
        used = {r[0] for r in joined.select(F.spark_partition_id()).distinct().collect()}
        plain = {r[0] for r in fact.join(dim, "k", "left").select(F.spark_partition_id()).distinct().collect()}
    assert len(plain) == 1 and len(used) >= 6


def test_copies_of_one_row_are_spread_by_row_id(spark):
    path = shared_dir(spark, "copies")
    spark.range(5000).select(F.lit(7).alias("k"), F.lit("same").alias("v")).write.parquet(path)
    from brindle.datasets import ROW_ID, with_row_id
    from brindle.functions import row_salt

    spread = with_row_id(spark.read.parquet(path)).groupBy(row_salt(F.col(ROW_ID), 10)).count().collect()
    assert len(spread) == 10 and max(r["count"] for r in spread) < 800


def test_salted_sum_equals_plain(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, 5).when(F.col("id") < 1010, None).otherwise(F.col("id") % 17).alias("k"),
        F.col("id").cast("decimal(18,2)").alias("v"),
        "id",
    )
    plain = df.filter("k is not null").groupBy("k").agg(F.sum("v").cast("decimal(38,2)").alias("total"))
    assert same(skew.salted_sum(df, "k", "v", "total", F.col("id")), plain)


def test_sql_salt_functions(spark):
    register_salt_functions(spark)
    row = spark.sql("SELECT brindle_salt_key(12L, -7L, 6) AS s, brindle_unsalt_key(brindle_salt_key(12L, -7L, 6)) AS k").first()
    assert row["s"]["key"] == 12 and 0 <= row["s"]["salt"] < 6 and row["k"] == 12


def test_top_keys_exact_and_sampled(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in skew.top_keys(df, "k", 2).collect()] == [(-1, 3334), (1, 1)]
    both = skew.top_keys_of_columns(df.withColumn("j", F.col("k") % 2), ["k", "j"], 2).collect()
    assert sorted(map(tuple, both)) == [("j", -1, 3334), ("j", 0, 3333), ("k", -1, 3334), ("k", 1, 1)]
    numbered = df.withColumn("row", F.monotonically_increasing_id())
    sampled = skew.top_keys(numbered, "k", 1, 0.4, F.col("row").cast("string")).first()
    assert sampled["k"] == -1 and 1100 < sampled["drawn"] < 1600
    assert sampled["estimate"] == int(sampled["drawn"] / 0.4) and abs(sampled["estimate"] - 3334) <= 4 * sampled["error"]
    assert sampled == skew.top_keys(numbered.repartition(7), "k", 1, 0.4, F.col("row").cast("string")).first()
    with pytest.raises(ValueError):
        skew.top_keys(df, "k", 1, fraction=0.4)


def test_sampled_detection_gives_the_same_join(spark, rows):
    fact = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    dim = spark.range(0, 6000, 2).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    hot = skew.find_hot_keys(fact, ["k"], rows_per_task=500, fraction=0.2)
    assert [row[0] for row in hot.frame.collect()] == [1]
    assert same(skew.salted_left_join(fact, dim, hot, F.col("n")), fact.join(dim, "k", "left"))


@pytest.mark.parametrize("buckets", [5, 64])
def test_bucketed_join_with_a_hot_key(spark, buckets):
    fact = spark.range(6400).select(
        F.when(F.col("id") < 1280, 3).when(F.col("id") < 2500, None).otherwise(F.col("id")).alias("orderid"),
        F.col("id").alias("n"),
        (F.col("id") % 2).cast("string").alias("dt"),
    )
    dim = spark.range(0, 6400, 3).select(F.col("id").alias("orderid"), F.lit("paid").alias("state"))
    hot = skew.find_hot_keys(fact, ["orderid"], rows_per_task=6400 // buckets)
    assert {row[0] for row in hot.frame.collect()} == ({3, None} if buckets == 64 else {3} if 1280 >= 6400 // buckets else set())
    names = table_name("fact"), table_name("dim")
    common, apart = save_bucketed_apart(fact, names[0], buckets, hot, shared_dir(spark, names[0]), ["dt"])
    paid = save_bucketed(dim, names[1], buckets, "orderid", shared_dir(spark, names[1]))
    assert common.where("orderid = 3").count() == 0 and common.count() + apart.count() == 6400
    with scoped_conf(spark, **NO_BROADCAST, spark__sql__adaptive__enabled="false"):
        assert "Exchange hashpartitioning" not in common.join(paid, "orderid", "left")._jdf.queryExecution().toString()
    assert same(bucketed_left_join(common, apart, paid, hot, F.col("n")), fact.join(dim, "orderid", "left"))


def test_all_hot_keys_are_found_whatever_the_settings(spark):
    fact = spark.range(20_000).select((F.col("id") % 100).alias("k"), F.lit("x" * 200).alias("v"))
    for partitions in ("4", "8", "200"):
        with scoped_conf(spark, spark__sql__shuffle__partitions=partitions):
            assert skew.find_hot_keys(fact, ["k"], rows_per_task=200).frame.count() == 100
            assert not skew.find_hot_keys(fact, ["k"])
            assert skew.rows_in_bytes(fact, 216_000) == pytest.approx(1000, rel=0.1)


def _skewed_star(spark):
    cart = spark.range(24000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900).alias("courseid"),
        F.col("id").alias("orderid"),
        F.lit("c").alias("coursename"),
        F.lit(0.05).alias("cart_discount"),
        F.col("id").cast("decimal(18,2)").alias("sellmoney"),
        F.sha2(F.col("id").cast("string"), 256).alias("cart_createtime"),
        F.lit("d0").alias("dt"),
        F.lit("webA").alias("dn"),
    )
    fixed = {"courseid": F.col("id"), "dt": F.lit("d0"), "dn": F.lit("webA")}
    described = [c for c in sales.DETAIL_COLUMNS[: sales.DETAIL_COLUMNS.index("orderid")] if c not in fixed]
    course = spark.range(900).select(
        *[value.alias(name) for name, value in fixed.items()],
        *[F.col("id").cast("string").alias(name) for name in described],
    )
    pay = spark.range(0, 24000, 2).select(
        F.col("id").alias("orderid"), F.lit("x").alias("pay_discount"), F.col("id").cast("decimal(18,2)").alias("paymoney"),
        F.lit("t").alias("pay_createtime"), F.lit("d0").alias("dt"), F.lit("webA").alias("dn"),
    )
    return course, cart, pay


def test_adaptive_execution_splits_the_hot_course(spark):
    course, cart, pay = _skewed_star(spark)
    with scoped_conf(spark, **SPLIT_SMALL):
        assert "skew=true" in executed_plan(sales.sale_detail(course, cart, pay))
        assert "skew=true" in executed_plan(sales.course_sales(course, cart, pay, hot_rows=1000))
        right = cart.select("courseid", "orderid", "cart_createtime")
        assert "skew=true" in executed_plan(left_join_hot_right(course, right, ["courseid"]))
        # The plain outer join cannot be split on its right side.
        assert "skew=true" not in executed_plan(course.join(right, "courseid", "left"))


def test_course_sales_equals_the_plain_joins(spark):
    course, cart, pay = _skewed_star(spark)
    course = course.unionByName(course.limit(5).withColumn("courseid", F.col("courseid") + 100_000))
    plain = (
        cart.drop("coursename", "dt", "dn")
        .join(pay.drop("dt", "dn"), "orderid", "left")
        .join(course, "courseid", "right")
        .select(*sales.DETAIL_COLUMNS)
    )
    for hot_rows in (1000, 1_000_000):  # with courses set apart, and in one join
        ours = sales.course_sales(course, cart, pay, hot_rows)
        assert same(ours, plain)
        assert ours.filter("courseid >= 100000 and orderid is null").count() == 5


def test_salted_sale_detail_equals_plain(spark):
    course, cart, pay = _skewed_star(spark)
    salted = sales.salted_sale_detail(course, cart, pay, "orderid", at_least=2, min_salts=36)
    assert same(salted, sales.sale_detail(course, cart, pay))
    plain = course.join(cart, sales.COURSE_KEY).groupBy("courseid", course["coursename"]).agg(
        F.sum("sellmoney").cast("decimal(38,2)").alias("total_sell")
    )
    assert same(sales.course_revenue(course, cart), plain)
