"""Literal inputs with known results."""

import pytest
from pyspark.sql import functions as F

from brindle.functions import bucket_of, tokens
from brindle.operators import aggregates, ordering, rows as row_ops, sets, visits
from brindle.operators.joins import left_join_hot_right, lookup
from brindle.sources import from_rows, parse_access_log, parse_visits, people, visit_rejects


def values(df, *columns):
    return sorted((tuple(row) if len(row) > 1 else row[0]) for row in df.select(*(columns or df.columns)).collect())


def test_tokens_drop_trailing_empties_only(rows):
    df = rows([("a b  ",), ("",), ("   ",), (" a",), (None,)], "value string")
    assert [r[0] for r in df.select(tokens(F.col("value"))).collect()] == [["a", "b"], [""], [], ["", "a"], None]


def test_tokens_other_separator(rows):
    df = rows([("a|b||",), ("||",), ("|a",)], "value string")
    assert [r[0] for r in df.select(tokens(F.col("value"), "|")).collect()] == [["a", "b"], [], ["", "a"]]
    with pytest.raises(ValueError):
        tokens(F.col("value"), "ab")


def test_word_count(rows):
    lines = rows([("hello scala",), ("hello python",), ("hello world",)], "value string")
    assert values(aggregates.count_by(row_ops.words(lines), "word")) == [
        ("hello", 3),
        ("python", 1),
        ("scala", 1),
        ("world", 1),
    ]


def test_set_operations(rows):
    left, right = rows([(1,), (2,), (3,), (4,)], "x int"), rows([(3,), (4,), (5,), (6,)], "x int")
    assert values(sets.intersection(left, right)) == [3, 4]
    assert values(sets.union_all(left, right)) == [1, 2, 3, 3, 4, 4, 5, 6]
    assert values(sets.subtract(left, right)) == [1, 2]
    zipped = ordering.zip_rows(left, right.withColumnRenamed("x", "y"), ["x"], ["y"])
    assert values(zipped, "x", "y") == [(1, 3), (2, 4), (3, 5), (4, 6)]


def test_subtract_keeps_left_duplicates_and_matches_nulls(rows):
    left = rows([(1,), (1,), (2,), (3,), (None,)], "x int")
    assert values(sets.subtract(left, rows([(3,), (3,)], "x int")).filter("x is not null")) == [1, 1, 2]
    assert sets.subtract(left, rows([(None,)], "x int")).filter("x is null").count() == 0
    assert sets.subtract(left, rows([(1,)], "x int")).filter("x is null").count() == 1


def test_intersection_of_nulls_and_pairs(rows):
    left = rows([(1, "a"), (1, "a"), (None, "b"), (2, None)], "x int, y string")
    right = rows([(1, "a"), (None, "b"), (2, "c")], "x int, y string")
    found = {tuple(r) for r in sets.intersection(left, right).collect()}
    assert found == {(1, "a"), (None, "b")}


def test_distinct_in_one_file(rows):
    df = rows([("a",), ("a",), ("b",)], "ip string", 3)
    narrowed = sets.distinct_rows(df, files=1)
    assert values(narrowed) == ["a", "b"] and narrowed.rdd.getNumPartitions() == 1


def test_zip_rejects_unequal_lengths(rows):
    with pytest.raises(ValueError, match="differ in length"):
        ordering.zip_rows(rows([(1,)], "x int"), rows([(1,), (2,)], "y int"), ["x"], ["y"])


def test_positions_with_copies_and_nulls(rows):
    df = rows([(5,)] * 400 + [(1,), (None,), (9,)], "x int", 6)
    numbered = ordering.with_position(df, "x").collect()
    assert sorted(r["position"] for r in numbered) == list(range(1, 404))
    by_position = [r["x"] for r in sorted(numbered, key=lambda r: r["position"])]
    assert by_position == [None, 1] + [5] * 400 + [9]


def test_zero_value_sum(rows):
    df = rows([(1,), (2,), (3,), (4,)], "x int")
    assert aggregates.zero_value_sum(df, "x", 10, 2).first()["total"] == 40
    assert aggregates.zero_value_sum(df.limit(0), "x", 10, 2).first()["total"] == 30


def test_counts_and_sums_by_key(rows):
    pairs = rows([("a", 1), ("b", 2), ("c", 5), ("a", 3)], "key string, value int")
    assert values(aggregates.count_by(pairs, "key")) == [("a", 2), ("b", 1), ("c", 1)]
    ones = rows([("a", 1), ("b", 1), ("c", 1), ("c", 1)], "key string, value int")
    assert values(ones.groupBy("key").agg(F.sum("value"))) == [("a", 1), ("b", 1), ("c", 2)]


def test_group_values_one_row_per_small_group(rows):
    pairs = rows([("a", 1), ("b", 2), ("a", 3), ("a", 1), (None, 7), ("a", None)], "key string, value int")
    found = {r["key"]: (r["page"], [tuple(e) for e in r["entries"]], r["cnt"]) for r in
             aggregates.group_values(pairs, "key", "value").collect()}
    assert found == {
        "a": (0, [(None, 1), (1, 2), (3, 1)], 4),
        "b": (0, [(2, 1)], 1),
        None: (0, [(7, 1)], 1),
    }


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_group_values_pages_are_full_and_lose_nothing(spark, kind):
    pairs = spark.range(3000).select(
        F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("key"), (F.col("id") % 1500).cast(kind).alias("value")
    )
    groups = sorted(aggregates.group_values(pairs, "key", "value", page_entries=200).collect(), key=lambda g: (g["key"], g["page"]))
    sizes = {key: [len(g["entries"]) for g in groups if g["key"] == key] for key in ("hot", "cold")}
    assert sizes == {"hot": [200] * 7 + [100], "cold": [100]}
    in_order = [e["value"] for g in groups if g["key"] == "hot" for e in g["entries"]]
    assert in_order == sorted(in_order)
    unfolded = sorted((g["key"], e["value"]) for g in groups for e in g["entries"] for _ in range(e["copies"]))
    assert unfolded == sorted((r["key"], r["value"]) for r in pairs.collect())


def test_many_copies_of_few_values_are_one_page(spark):
    pairs = spark.range(5000).select(F.lit("k").alias("key"), (F.col("id") % 5).alias("value"))
    (row,) = aggregates.group_values(pairs, "key", "value", page_entries=100).collect()
    assert row["page"] == 0 and row["cnt"] == 5000 and [e["copies"] for e in row["entries"]] == [1000] * 5


def test_bucket_maxima(rows):
    tagged = rows([(0, 1), (0, 2), (1, 3), (1, 4)], "bucket int, value int")
    maxima = aggregates.bucket_maxima(tagged, "bucket", "value")
    assert values(maxima) == [(0, 2), (1, 4)]
    assert maxima.agg(F.sum("max_value")).first()[0] == 6


def test_buckets_are_total_and_stable(rows):
    df = rows([(5,), (-5,), (None,), (2**62,)], "x bigint")
    tagged = row_ops.tag_bucket(df, "x", 4)
    assert all(0 <= r["bucket"] < 4 for r in tagged.collect())
    assert tagged.filter("x is null").first()["bucket"] == 0
    parts = [row_ops.only_bucket(df, "x", 4, b).count() for b in range(4)]
    assert sum(parts) == 4


def test_buckets_spread_evenly(spark):
    counts = [r["count"] for r in spark.range(16000).groupBy(bucket_of(F.col("id"), 16)).count().collect()]
    assert len(counts) == 16 and max(counts) < 1200 and min(counts) > 800


def test_seeds_are_independent(spark):
    people_ = people(spark.range(20_000), "p", 1)
    shared = people_.where("age = partition").count()
    assert 120 < shared < 290  # one in a hundred by chance
    assert people_.select(((F.col("age") - F.col("partition")) % 100).alias("d")).distinct().count() > 90
    df = spark.range(50_000)
    one, two = (row_ops.sample_rows(df, "id", 0.4, seed) for seed in (1, 2))
    assert 19_000 < one.count() < 21_000
    assert 7_300 < one.intersect(two).count() < 8_700  # 0.4 * 0.4


def test_any_fraction_and_regular_keys(spark):
    df = spark.range(200_000)
    assert 40 < row_ops.sample_rows(df, "id", 0.0004).count() < 125
    assert row_ops.sample_rows(df, "id", 0.0).count() == 0 and row_ops.sample_rows(df, "id", 1.0).count() == 200_000
    thousands = df.select((F.col("id") * 1000).alias("id"))
    assert 78_000 < row_ops.sample_rows(thousands, "id", 0.4).count() < 82_000


def test_partition_by_key(spark):
    placed = row_ops.partition_by_key(spark.range(1000).select((F.col("id") % 17).alias("k")), "k", partitions=5)
    found = placed.select("k", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(found) == 17 and placed.rdd.getNumPartitions() == 5


def test_take_ordered(rows):
    df = rows([(4,), (2,), (1,), (3,)], "x int")
    assert [r[0] for r in ordering.smallest(df, 3, F.asc("x")).collect()] == [1, 2, 3]
    assert [r[0] for r in ordering.smallest(df, 3, F.desc("x")).collect()] == [4, 3, 2]
    assert tuple(df.agg(F.sum("x"), F.count("x")).first()) == (10, 4)


def test_text_order(rows):
    df = rows([("2",), ("11",), ("12",)], "x string")
    assert [r[0] for r in ordering.sort_rows(df, "x").collect()] == ["11", "12", "2"]


def test_flatten(rows):
    nested = rows([([1, 2],), ([3, 4],), ([],), (None,)], "xs array<int>")
    assert values(row_ops.flatten_lists(nested, "xs")) == [1, 2, 3, 4]
    mixed = rows([([1, 2], None), (None, 3), ([3, 4], None), (None, None)], "xs array<int>, x int")
    assert values(row_ops.flatten_mixed(mixed, "xs", "x")) == [1, 2, 3, 3, 4]


def test_pair_join_and_lookup(rows):
    left = rows([("a", 1), ("b", 2), ("c", 3), ("z", 9)], "key string, v int")
    right = rows([("a", 4), ("b", 5), ("c", 6)], "key string, w int")
    assert values(left.join(right, "key")) == [("a", 1, 4), ("b", 2, 5), ("c", 3, 6)]
    assert values(lookup(left, right, "key", "w", 0)) == [("a", 1, 4), ("b", 2, 5), ("c", 3, 6), ("z", 9, 0)]


def test_on_and_where_differ(spark, rows):
    people_df = rows([(1, 101), (2, 102), (3, 103), (4, 104)], "id int, city int")
    cities = rows([(101, "a"), (102, "b"), (103, "c"), (104, "d")], "city int, name string")
    on = left_join_hot_right(people_df, cities, ["city"], F.col("city") < 103)
    where = left_join_hot_right(people_df.filter("city < 103"), cities, ["city"])
    sql = "SELECT p.city, p.id, c.name FROM {p} p LEFT JOIN {c} c ON p.city = c.city "
    key = lambda df: sorted(map(str, df.select("city", "id", "name").collect()))
    assert key(on) == key(spark.sql(sql + "AND p.city < 103", p=people_df, c=cities))
    assert key(where) == key(spark.sql(sql + "WHERE p.city < 103", p=people_df, c=cities))
    assert (on.count(), on.filter("name is null").count(), where.count()) == (4, 2, 2)


def test_left_join_hot_right_with_nulls_and_duplicates(rows):
    left = rows([(1, "d0", "x"), (1, "d0", "y"), (2, "d0", "z"), (None, "d0", "n"), (3, None, "m")], "k int, dt string, l string")
    right = rows([(1, "d0", "p"), (1, "d0", "q"), (None, "d0", "r"), (9, "d0", "s")], "k int, dt string, r string")
    ours = left_join_hot_right(left, right, ["k", "dt"])
    plain = left.join(right, ["k", "dt"], "left")
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


def test_search(rows):
    lines = rows([("hello world",), ("hello spark",), ("it_demo",), (None,)], "value string")
    assert values(visits.search(lines, "h")) == ["hello spark", "hello world"]


def test_routing(rows):
    df = rows([("nba", 1), ("nba", 2), ("cba", 3), ("wnba", 4)], "league string, n int")
    route = F.when(F.col("league") == "nba", 0).when(F.col("league") == "wnba", 1).otherwise(2)
    landed = row_ops.route_rows(df, route, 3, F.col("n"), fan_out=1).select("league", F.spark_partition_id().alias("p"))
    assert values(landed) == [("cba", 2), ("nba", 0), ("nba", 0), ("wnba", 1)]


def test_routing_fans_a_hot_route_out(spark):
    df = spark.range(1000)
    wide = row_ops.route_rows(df, F.lit(1), 3, F.col("id"), fan_out=4).select(F.spark_partition_id().alias("p"))
    assert {r["p"] for r in wide.distinct().collect()} == {4, 5, 6, 7}
    assert row_ops.fan_out_of(df, 3) == 2


LINE = "2024-01-01_7_7-a_0_2024-01-01 00:00:01_null_{click}_-1_{order}_null_{pay}_null_1"


def visit_frame(rows, *lines):
    return rows([(line,) for line in lines], "value string")


def test_a_visit_with_several_actions(rows):
    parsed = parse_visits(visit_frame(rows, LINE.format(click="5", order="5,6", pay="null")))
    all_counted = visits.category_counts(visits.category_actions(parsed))
    assert values(all_counted) == [("5", 1, 1, 0), ("6", 0, 1, 0)]
    first_kind = visits.category_counts(visits.category_actions(parsed, exclusive=True))
    assert values(first_kind) == [("5", 1, 0, 0)]


def test_exclusive_prefers_orders_to_payments(rows):
    parsed = parse_visits(
        visit_frame(rows, LINE.format(click="-1", order="6", pay="7"), LINE.format(click="-1", order="null", pay="7"))
    )
    assert values(visits.category_counts(visits.category_actions(parsed, exclusive=True))) == [("6", 0, 1, 0), ("7", 0, 0, 1)]


def test_visit_parsing(rows):
    good = LINE.format(click="-1", order="null", pay="3")
    lines = visit_frame(rows, good, "a_b_c", "", good + "_14th", good.replace("_7_7-a", "_x_7-a")).unionByName(
        rows([(None,)], "value string")
    )
    parsed, rejected = parse_visits(lines), visit_rejects(lines)
    assert parsed.count() == 2 and rejected.count() == 4
    assert parsed.count() + rejected.count() == lines.count()
    row = parsed.filter("user_id = 7").first()
    assert row["click_category_id"] is None and row["order_category_ids"] is None and row["search_keyword"] is None
    assert row["pay_category_ids"] == ["3"] and row["click_product_id"] is None
    assert parsed.filter("user_id is null").count() == 1


def test_ties_are_ranked_by_id(rows):
    lines = [LINE.format(click=c, order="null", pay="null") for c in ("9", "10", "8")]
    top = visits.hot_categories(parse_visits(visit_frame(rows, *lines)), 2)
    assert [r["category_id"] for r in top.collect()] == ["10", "8"]


def test_top_sessions_keep_ten_per_category(rows):
    lines = [
        LINE.format(click=str(c), order="null", pay="null").replace("7-a", f"s{s:02d}")
        for c in range(3)
        for s in range(15)
        for _ in range(s + 1)
    ]
    best = visits.top_sessions(parse_visits(visit_frame(rows, *lines)), categories=2)
    assert best.count() == 20
    assert best.agg(F.min("clicks")).first()[0] == 6


def test_access_log_parsing(rows):
    lines = rows(
        [
            ('1.2.3.4 - - 17/05/2015:10:05:03 +0000 "GET /a HTTP/1.1"',),
            ('1.2.3.4 - - 17/05/2015:09:05:03 +0000 "GET /b HTTP/1.1"',),
            ('5.6.7.8 - - 99/99/2015:10 +0000 "GET /c HTTP/1.1"',),
            ('5.6.7.8 - - 31/02/2015:10:00:00 +0000 "GET /c HTTP/1.1"',),
            ('5.6.7.8 - - 2015-05-17 +0000 "GET /c HTTP/1.1"',),
            ("short",),
            ("",),
        ],
        "value string",
    )
    parsed = parse_access_log(lines)
    assert parsed.count() == 7 and parsed.filter("ts is not null").count() == 2
    assert values(visits.visits_per_hour(parsed)) == [("10", 1), ("9", 1)]
    assert values(visits.urls_on_day(lines, "17/05/2015")) == ["/a", "/b"]


def test_cogroup_counts_missing_sides_as_zero(rows):
    one = rows([("a",), ("a",), ("b",)], "k string")
    assert values(aggregates.cogroup_counts("k", x=one, y=rows([("c",)], "k string"), z=one.limit(0))) == [
        ("a", 2, 0, 0),
        ("b", 1, 0, 0),
        ("c", 0, 1, 0),
    ]


def test_sample_is_stable_and_near_its_fraction(spark):
    ids = spark.range(5000)
    first = {r["id"] for r in row_ops.sample_rows(ids, "id", 0.4).collect()}
    again = {r["id"] for r in row_ops.sample_rows(ids.repartition(7), "id", 0.4).collect()}
    assert first == again and 1800 < len(first) < 2200
    assert row_ops.sample_rows(ids, "id", 0).count() == 0 and row_ops.sample_rows(ids, "id", 1).count() == 5000
    with pytest.raises(ValueError):
        row_ops.sample_rows(ids, "id", 1.5)


def test_generated_people(spark):
    students = people(spark.range(1000), "name", 1)
    assert students.columns == ["id", "name", "age", "partition"]
    assert students.filter("age between 0 and 99 and partition between 0 and 99").count() == 1000
    assert "age" not in people(spark.range(1), "school", 3, with_age=False).columns
    assert students.select("partition").distinct().count() > 90


def test_local_rows_as_a_view(spark):
    df = from_rows(spark, [(1, "a"), (2, "b")], "id int, name string", partitions=2, view="local_people")
    assert df.rdd.getNumPartitions() == 2
    assert spark.sql("select name from local_people where id = 2").first()[0] == "b"


def test_observed_metrics_do_not_double(spark):
    frame, metrics = aggregates.observed(spark.range(5), "probe", F.sum("id").alias("total"))
    frame.collect()
    assert metrics.get == {"total": 10}
    frame.collect()
    assert metrics.get == {"total": 10}


def test_reused_frame_is_released(spark):
    with aggregates.reused(spark.range(10)) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not kept.is_cached


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_do_not_depend_on_the_session_zone(spark, rows, zone):
    from brindle import datasets
    from brindle.plans import scoped_conf

    with scoped_conf(spark, spark__sql__session__timeZone=zone):
        # 02:30 on this day does not exist in the second zone.
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:05.25' AS ts")
        texts = df.select(datasets.day_text("ts"), datasets.second_text("ts"), datasets.log_time_text("ts")).first()
        assert tuple(texts) == ("2024-03-10", "2024-03-10 02:30:05", "10/03/2024:02:30:05")
        line = rows([(f"1.1.1.1 - - {texts[2]} +0000 x",)], "value string")
        assert values(visits.visits_per_hour(parse_access_log(line))) == [("2", 1)]
