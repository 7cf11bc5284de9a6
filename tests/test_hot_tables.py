"""Queries on tables in which a third of all rows are copies of one row."""

import os

import compare
import duckdb
import pytest

from brindle.catalog import all_oracles, all_queries

COPIED = {"lineitem", "events", "documents"}
NAMES = """
    hot_category_top10 top_sessions word_count whole_files visit_parse
    group_values group_by_expression bucket_values count_by_key distinct_values sort_strings zip_rows
    set_intersect set_subtract
    sale_detail big_table_join course_revenue left_on_pred left_where_pred left_on_right_pred range_right_join
    broadcast_lookup key_skew_exact salted_agg salted_agg_sql salted_join
    bucket_join dyn_partition_write compact_files custom_partition column_profile
""".split()


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory, sf_dir):
    target = str(tmp_path_factory.mktemp("hot"))
    connection = duckdb.connect()
    for table in compare.TABLES:
        source = f"read_parquet('{sf_dir}/{table}.parquet')"
        sql = f"SELECT * FROM {source}"
        if table in COPIED:
            copies = connection.execute(f"SELECT count(*) // 2 FROM {source}").fetchone()[0]
            sql += f" UNION ALL SELECT r.* FROM (SELECT * FROM {source} ORDER BY ALL LIMIT 1) r, range({copies})"
        connection.execute(f"COPY ({sql}) TO '{os.path.join(target, table)}.parquet' (FORMAT parquet)")
    connection.close()
    return target


@pytest.fixture(scope="module")
def duck(hot_dir):
    connection = compare.connect(hot_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_on_hot_tables(spark, hot_dir, duck, name):
    assert compare.differences(all_queries()[name](spark, hot_dir), duck, all_oracles()[name]) is None
