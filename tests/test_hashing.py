"""The integer hash: the same in both engines, even, and independent of the seed."""

import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.catalog.registry import sql_bucket, sql_integer_hash
from brindle.functions import HASH_BITS, bucket_of, integer_hash

EDGES = [None, 0, 1, -1, 2**31, -(2**31), 2**32, 2**32 + 1, -(2**32), 2**40 + 7, 2**63 - 1, -(2**63), -(2**63) + 5]


@pytest.mark.parametrize("seed", [0, 1, 12345])
def test_same_in_both_engines(spark, seed):
    rows = [(i, value) for i, value in enumerate(EDGES)]
    df = spark.createDataFrame(rows, "i int, v bigint")
    got = {r["i"]: (r["h"], r["b"]) for r in df.select("i", integer_hash(F.col("v"), seed).alias("h"), bucket_of(F.col("v"), 7, seed, True).alias("b")).collect()}
    connection = duckdb.connect()
    for i, value in rows:
        want = connection.execute(f"SELECT {sql_integer_hash('v', seed)}, {sql_bucket('v', 7, seed)} FROM (SELECT CAST(? AS BIGINT) AS v)", [value]).fetchone()
        assert got[i] == want and 0 <= got[i][0] < 1 << HASH_BITS


def test_even_over_buckets_and_independent_of_the_seed(spark):
    ids = spark.range(64_000)
    for step in (1, 16, 1 << 33):
        counts = [r["count"] for r in ids.groupBy(bucket_of(F.col("id") * step, 16, 3, True)).count().collect()]
        assert len(counts) == 16 and all(3_600 < n < 4_400 for n in counts)
    both = ids.where((integer_hash(F.col("id"), 1) < 1 << (HASH_BITS - 1)) & (integer_hash(F.col("id"), 2) < 1 << (HASH_BITS - 1))).count()
    assert 15_300 < both < 16_700
    assert ids.select(integer_hash(F.col("id")).alias("h")).distinct().count() == 64_000
