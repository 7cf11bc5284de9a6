import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import vantage as V


def brute(rows, queries, k=10):
    """Nearest of each query, by all distances."""
    out = {}
    for query, vector in queries:
        away = [(float(np.sqrt(((np.array(v, float) - np.array(vector, float)) ** 2).sum())), i) for i, v in rows if i != query and len(v) == len(vector)]
        out[query] = sorted(away)[:k]
    return out


def made(rows):
    out = {}
    for r in rows:
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {query: [(score, i) for _, score, i in sorted(own)] for query, own in out.items()}


def test_recall_on_the_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, [row for row in rows if row[0] % 100 == 0])
    got = made(V.op10_vantage(spark, sf_dir).collect())
    assert got.keys() == want.keys() and all(len(got[q]) == 10 for q in want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def clustered(count, width, seed=1):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(12, width)) * 4
    return centres[pick.integers(0, 12, count)] + pick.normal(size=(count, width)) * 0.3


def test_factor_one_is_exact_and_more_prunes():
    points, ids = clustered(3000, 4), np.arange(3000)
    tree = V.build(ids, points)
    queries = points[::50]
    names, scores = V.search(tree, ids[::50], queries, factor=1.0)
    for row, query in enumerate(ids[::50]):
        away = V.distances(points, points[query])
        away[query] = np.inf
        order = np.lexsort((ids, away))[:10]
        assert names[row].tolist() == order.tolist() and np.array_equal(scores[row], away[order])
    seen = []
    for factor in (1.0, 4.0):
        counted = dict(tree, points=CountingPoints(tree["points"]))
        V.search(counted, ids[::50], queries, factor=factor)
        seen.append(counted["points"].read)
    assert seen[1] < seen[0] < 60 * 3000


class CountingPoints:
    """Counts the points that queries are held against."""

    def __init__(self, points):
        self.points, self.read = points, 0

    def __getitem__(self, key):
        found = self.points[key]
        self.read += found.shape[-2]
        return found


@pytest.mark.parametrize("cells", [64, 1 << 19])
def test_shards_blocks_and_ties(spark, monkeypatch, cells):
    monkeypatch.setattr(V, "BLOCK_CELLS", 40)
    monkeypatch.setattr(V, "BLOCKS_PER_TREE", 2)
    pick = np.random.default_rng(4)
    rows = [(i, [float(x) for x in pick.integers(0, 3, 4)]) for i in range(300)] + [(1000 + i, [9.0, 9.0, 9.0, 9.0]) for i in range(200)]
    rows = [row for row in rows if any(row[1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>").repartition(5)
    queries = [row for row in rows if row[0] % 50 == 0]
    index = V.write_index(frame, cells=cells)
    got = made(V.nearest(frame.where("vec_id % 50 = 0"), index, factor=1.0).collect())
    assert got == brute(rows, queries)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.5]), (100, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1)).withColumn("shard", F.lit(2))
    kept = V.usable(frame, "vec_id", "embedding")
    assert sorted(r["vec_id"] for r in kept.collect()) == [0, 7, 8]
    got = made(V.nearest(kept.where("vec_id % 100 = 0"), V.write_index(kept)).collect())
    assert got == {0: [(1.0, 7)]}
    empty = V.usable(frame.limit(0), "vec_id", "embedding")
    assert V.nearest(empty, V.write_index(empty)).count() == 0


def test_pivots_are_far_apart():
    points = np.array([[0.0, 0.0], [0.0, 0.1], [5.0, 0.0], [0.0, 5.0], [5.0, 0.0]])
    assert len(V.farthest(points, 10)) == 4 and len(np.unique(V.farthest(points, 3), axis=0)) == 3


@pytest.mark.parametrize("factor", [1.0, V.FACTOR])
@pytest.mark.parametrize("width", [4, 8, 16])
def test_cells_are_skipped_and_recall_holds(spark, monkeypatch, factor, width):
    """Clustered vectors: most queries visit few of the cells; a factor of one is exact."""
    points = clustered(3000, width)
    rows = [(i, [float(x) for x in point]) for i, point in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>").repartition(4)
    visits = []

    def counting(asked, index, k, factor, plain=V._answers):
        visits.append(asked.count())
        return plain(asked, index, k, factor)

    monkeypatch.setattr(V, "_answers", counting)
    queries = [row for row in rows if row[0] % 50 == 0]
    index = V.write_index(frame, cells=250 * width)
    cells = index.cells.count()
    got = made(V.nearest(frame.where("vec_id % 50 = 0"), index, factor=factor).collect())
    want = brute(rows, queries)
    if factor == 1.0:
        assert got == want
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.98 * 10 * len(want) and all(len(own) == 10 for own in got.values())
    assert cells >= 10 and sum(visits) < 0.5 * cells * len(queries), (visits, cells)


def test_plan_joins_queries_with_cells_only(spark):
    """Queries meet shards by cell: no join on the length of the vectors alone."""
    points = clustered(600, 4)
    frame = spark.createDataFrame([(i, [float(x) for x in point]) for i, point in enumerate(points)], "vec_id bigint, vector array<double>")
    index = V.write_index(frame, cells=200)
    assert index.cells.count() > 5 and index.trees.groupBy("cell").count().count() == index.cells.count()
    one = frame.where("vec_id = 7")
    assert len(made(V.nearest(one, index).collect())[7]) == 10
