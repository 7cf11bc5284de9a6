"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to cells by the nearest of a few pivots, and each cell by hash to shards
of at most about ``SHARD_CELLS`` numbers.  A shard's tree halves its points again and again
by their distance to a vantage point and keeps the range of distances on either side.  A
query skips a side if the triangle inequality puts all of it beyond its k-th best so far;
the bound is multiplied by ``FACTOR``, so one gives the exact result and more skips more.

Trees are written once as an index table.  A query first visits the cell of its own nearest
pivot, and then, with the k-th best found there as its bound, the cells whose range of
distances to their pivot the same inequality does not exclude.  Queries of a cell travel in
blocks of bounded size, and a large number of blocks is spread over several copies of a
shard's tree.  Each shard answers with its k best, of which the k best overall stay.

Pivots come from a sample by hash of about ``PIVOT_SAMPLE`` vectors of a length, the farthest
from those chosen before; at most ``MOST_PIVOTS`` of a length and ``PIVOT_CELLS`` numbers in
all, so that they and the ranges of their cells can be broadcast.  Lengths beyond that
have one cell, all of whose shards are visited.  The pivots decide the work, never the rows.

Of equal vectors only the k + 1 smallest ids can ever be among k results; the rest fold
away before sharding, so a vector that repeats without bound fills no shard.

Defined results: a vector that is null, empty, zero or holds a null or non-finite
component takes no part; a query finds vectors of its own length only; ties go to the
smaller id; a row repeated with the same id and vector counts once; rows with a null id
take no part; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.llm.common import column, table, text_key
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

K = 10
EVERY = 100
FACTOR = 1.15
SHARD_CELLS = 1 << 19
LEAF = 256
BLOCK_CELLS = 1 << 16
BLOCKS_PER_TREE = 64
PIVOT_SAMPLE = 4096
MOST_PIVOTS = 256
PIVOT_CELLS = 1 << 20

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as arrays:
        return dict(arrays)


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, by differences."""
    away = points - centre
    return np.sqrt((away * away).sum(axis=-1))


def build(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A vantage-point tree as arrays.

    ``nodes`` has a row for each node: first and last point, inner and outer child (-1: a leaf).
    ``bounds`` has the least and largest distance to the vantage point, of the inner and of the outer side.
    """
    order = np.lexsort((ids,))
    nodes: list[list[int]] = [[0, len(ids), -1, -1]]
    bounds: list[list[float]] = [[0.0] * 4]
    vantage: list[np.ndarray] = [points[0]]
    pending = [0]
    while pending:
        node = pending.pop()
        low, high = nodes[node][:2]
        if high - low <= leaf:
            continue
        own = points[order[low:high]]
        centre = own[distances(own, own.mean(axis=0)).argmax()]
        away = distances(own, centre)
        if away.max() == 0.0:
            continue  # equal points: no bound can part them
        rank = np.argsort(away, kind="stable")
        order[low:high], away = order[low:high][rank], away[rank]
        half = (high - low) // 2
        vantage[node] = centre
        bounds[node] = [away[0], away[half - 1], away[half], away[-1]]
        nodes[node][2:] = [len(nodes), len(nodes) + 1]
        for start, end in ((low, low + half), (low + half, high)):
            pending.append(len(nodes))
            nodes.append([start, end, -1, -1])
            bounds.append([0.0] * 4)
            vantage.append(points[0])
    return {
        "ids": ids[order], "points": points[order], "nodes": np.array(nodes), "bounds": np.array(bounds), "vantage": np.array(vantage),
    }


def search(
    tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int = K, factor: float = FACTOR, bounds_known: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``k`` nearest points of each query but itself, nearest first; distance infinity where there are fewer.

    With ``bounds_known`` points farther than that from their query are not wanted.
    """
    nodes, bounds = tree["nodes"], tree["bounds"]
    best = np.full((len(queries), k), np.inf)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)
    limit = np.full(len(queries), np.inf) if bounds_known is None else bounds_known.astype(np.float64)
    squares = (queries * queries).sum(axis=1)

    def look(active: np.ndarray, low: int, high: int) -> None:
        points, ids = tree["points"][low:high], tree["ids"][low:high]
        asked = queries[active]
        own = (points * points).sum(axis=1)
        # A product of matrices tells roughly which pairs may be near; these are measured exactly.
        around = squares[active][:, None] + own
        rough = around - 2.0 * (asked @ points.T)
        row, slot = np.nonzero(rough <= np.square(limit[active])[:, None] + 1e-9 * around)
        kept = ids[slot] != query_ids[active][row]
        row, slot = row[kept], slot[kept]
        if not row.size:
            return
        hit, place = np.unique(row, return_inverse=True)
        held = active[hit]
        first = np.searchsorted(row, hit)
        width = np.diff(np.append(first, row.size)).max()
        away, named = np.full((hit.size, width), np.inf), np.full((hit.size, width), np.iinfo(np.int64).max)
        away[place, np.arange(row.size) - first[place]] = distances(points[slot], asked[row])
        named[place, np.arange(row.size) - first[place]] = ids[slot]
        all_away, all_ids = np.concatenate([best[held], away], axis=1), np.concatenate([names[held], named], axis=1)
        rank = np.lexsort((all_ids, all_away), axis=1)[:, :k]
        best[held] = np.take_along_axis(all_away, rank, axis=1)
        names[held] = np.take_along_axis(all_ids, rank, axis=1)
        limit[held] = np.minimum(limit[held], best[held, -1])

    def visit(node: int, active: np.ndarray) -> None:
        low, high, inner, outer = nodes[node]
        if inner < 0:
            step = max(1, (1 << 21) // max(1, (high - low) * queries.shape[1]))
            for start in range(0, active.size, step):
                look(active[start : start + step], low, high)
            return
        away = distances(queries[active], tree["vantage"][node])
        least, most = bounds[node][[0, 2]], bounds[node][[1, 3]]
        gap = np.maximum(0.0, np.maximum(least - away[:, None], away[:, None] - most)) * (1 - 1e-12)
        first_inner = gap[:, 0] <= gap[:, 1]
        middle = (most[0] + least[1]) / 2
        first_inner = np.where(gap[:, 0] == gap[:, 1], away <= middle, first_inner)
        for turn, sides in ((first_inner, ((0, inner), (1, outer))), (~first_inner, ((1, outer), (0, inner)))):
            for side, child in sides:
                wanted = turn & (gap[:, side] * factor <= limit[active])
                if wanted.any():
                    visit(child, active[wanted])

    if len(tree["ids"]):
        visit(0, np.arange(len(queries)))
    return names, best


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, each once."""
    rows = vectors.select(column(id).cast("bigint").alias("vec_id"), column(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    return rows.where("vec_id is not null and vector is not null").where(finite & nonzero).dropDuplicates(["vec_id", "vector"])


def farthest(points: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` different points, each the farthest from those before; the first is the farthest from the mean."""
    away = distances(points, points.mean(axis=0))
    chosen = [int(away.argmax())]
    nearest_of = distances(points, points[chosen[0]])
    while len(chosen) < count and nearest_of.max() > 0:
        chosen.append(int(nearest_of.argmax()))
        nearest_of = np.minimum(nearest_of, distances(points, points[chosen[-1]]))
    return points[chosen]


def pivots_of(rows: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """The pivots of each length that needs more than one shard, as far as ``PIVOT_CELLS`` go; the largest lengths first."""
    shards = F.ceil(F.col("n") * F.col("length") / cells)
    sizes = rows.groupBy("length").agg(F.count("*").alias("n")).where(shards > 1)
    wanted = {r["length"]: r for r in sizes.orderBy(F.desc("n"), "length").limit(PIVOT_CELLS // 2).collect()}
    chosen, left = {}, PIVOT_CELLS
    for length, row in wanted.items():
        count = min(MOST_PIVOTS, -(-row["n"] * length // cells), left // length)
        if count > 1:
            chosen[length] = (count, min(1.0, PIVOT_SAMPLE / row["n"]))
            left -= count * length
    if not chosen:
        return {}
    share = rows.sparkSession.createDataFrame([(length, *own) for length, own in chosen.items()], "length int, pivots int, share double")
    drawn = F.pmod(F.xxhash64(F.lit(3), "vector"), F.lit(1 << 30)) < F.col("share") * (1 << 30)

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        found = farthest(np.stack(part["vector"].to_numpy()).astype(np.float64), int(part["pivots"].iloc[0]))
        return pd.DataFrame({"length": int(part["length"].iloc[0]), "pivot": list(found)})

    sample = rows.join(F.broadcast(share), "length").where(drawn).select("length", "pivots", "vector").dropDuplicates(["vector"])
    found: dict[int, list] = {}
    for row in sample.groupBy("length").applyInPandas(choose, "length int, pivot array<double>").collect():
        found.setdefault(row["length"], []).append(row["pivot"])
    return {length: np.array(own) for length, own in found.items()}


INDEX = "length int, cell int, shard int, tree binary"
CELLS = "length int, cell int, shards int, least double, most double"


class Index:
    """Trees by length, cell and shard (a written table), the ranges of the cells (likewise), and the pivots."""

    def __init__(self, trees: DataFrame, cells: DataFrame, pivots: dict[int, np.ndarray]):
        self.trees, self.cells, self.pivots = trees, cells, pivots


def _by_pivot(rows: DataFrame, pivots: dict[int, np.ndarray], keep: str, columns: list[str]) -> DataFrame:
    """``rows`` with the ``cell`` of the nearest pivot and the distance to it (``away``); cell 0 where there are no pivots."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)
    place = columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            vectors = batch.column(place)
            sizes = np.array([len(one) for one in vectors], np.int64)
            for length in np.unique(sizes).tolist():
                if length in sent.value:
                    own = np.flatnonzero(sizes == length)
                    points = np.array([vectors[i].as_py() for i in own.tolist()])
                    cell[own], away[own] = nearest_pivot(points, sent.value[length])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])

    return rows.select(*columns).mapInArrow(run, f"{keep}, cell int, away double")


def nearest_pivot(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best, away = np.zeros(len(points), np.int32), np.full(len(points), np.inf)
    for place, pivot in enumerate(pivots):
        now = distances(points, pivot)
        closer = now < away
        best[closer], away[closer] = place, now[closer]
    return best, away


def write_index(rows: DataFrame, k: int = K, cells: int = SHARD_CELLS) -> Index:
    """The index of ``rows`` (``vec_id, vector``), which should be a written table: they are read more than once."""
    sized = rows.select("vec_id", "vector", F.size("vector").alias("length"))
    pivots = pivots_of(sized, cells)
    equal = Window.partitionBy("vector").orderBy("vec_id")
    few = sized.withColumn("place", F.row_number().over(equal)).where(F.col("place") <= k + 1)
    dealt = materialize(_by_pivot(few, pivots, "vec_id bigint, vector array<double>, length int", ["vec_id", "vector", "length"]), "dealt")
    shards = F.ceil(F.count("*") * F.col("length") / cells).cast("int")
    ranges = dealt.groupBy("length", "cell").agg(shards.alias("shards"), F.min("away").alias("least"), F.max("away").alias("most"))
    ranges = materialize(ranges.select("length", "cell", "shards", "least", "most"), "cells")
    placed = dealt.drop("away").join(broadcast_if_small(ranges.select("length", "cell", "shards")), ["length", "cell"])
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))

    def plant(part: pd.DataFrame) -> pd.DataFrame:
        tree = build(part["vec_id"].to_numpy(np.int64), np.stack(part["vector"].to_numpy()).astype(np.float64))
        return part.iloc[:1][["length", "cell", "shard"]].assign(tree=[_packed(**tree)])

    trees = placed.groupBy("length", "cell", "shard").applyInPandas(plant, INDEX)
    return Index(materialize(trees, "trees"), ranges, pivots)


_ASKED = "vec_id bigint, key bigint, length int, vector array<double>, bound double, cell int"


def _other_cells(asked: DataFrame, index: Index, factor: float) -> DataFrame:
    """A row for each query (with its own ``home`` cell and ``bound``) and other cell that may hold something nearer."""
    # Lengths without pivots have no other cells; those with them have MOST_PIVOTS rows at most.
    ranges: dict[int, dict[int, tuple[float, float]]] = {}
    if index.pivots:
        for row in index.cells.where(F.col("length").isin(list(index.pivots))).collect():
            ranges.setdefault(row["length"], {})[row["cell"]] = (row["least"], row["most"])
    sent = asked.sparkSession.sparkContext.broadcast((index.pivots, ranges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, known = sent.value
        for batch in batches:
            rows, cells = [], []
            for row, (length, vector, bound, home) in enumerate(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))):
                if length not in pivots:
                    continue
                away = distances(pivots[length], np.array(vector))
                for cell, (least, most) in known[length].items():
                    gap = max(0.0, least - away[cell], away[cell] - most) * (1 - 1e-12)
                    if cell != home and gap * factor <= bound:
                        rows.append(row)
                        cells.append(cell)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns[:5], pa.array(cells, pa.int32())], batch.schema.names)

    return asked.mapInArrow(run, _ASKED)


def _answers(asked: DataFrame, index: Index, k: int, factor: float) -> DataFrame:
    """What the shards of each query's ``cell`` find: ``query_id, query_key, vec_id, score``."""
    counts = asked.groupBy("length", "cell").agg(F.count("*").alias("n"))
    blocks = counts.select("length", "cell", F.ceil(F.col("n") * F.col("length") / BLOCK_CELLS).cast("int").alias("blocks"))
    dealt = asked.join(broadcast_if_small(materialize(blocks, "counts")), ["length", "cell"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).cast("int")).drop("blocks")

    def bundle(part: pd.DataFrame) -> pd.DataFrame:
        data = _packed(
            ids=part["vec_id"].to_numpy(np.int64), keys=part["key"].to_numpy(np.int64), bounds=part["bound"].to_numpy(np.float64),
            points=np.stack(part["vector"].to_numpy()).astype(np.float64),
        )
        return part.iloc[:1][["length", "cell", "block"]].assign(data=[data])

    bundled = materialize(dealt.groupBy("length", "cell", "block").applyInPandas(bundle, "length int, cell int, block int, data binary"), "blocks")
    # A block visits the shards of its cell; a copy of a tree serves up to BLOCKS_PER_TREE blocks.
    copy_of = (F.col("block") / BLOCKS_PER_TREE).cast("int")
    sent = bundled.join(broadcast_if_small(index.trees.select("length", "cell", "shard")), ["length", "cell"])
    sent = sent.select("length", "cell", "shard", copy_of.alias("copy"), F.lit(1).alias("kind"), "data")
    copies = bundled.groupBy("length", "cell").agg(F.max(copy_of).alias("copies"))
    trees = index.trees.join(broadcast_if_small(copies), ["length", "cell"]).withColumn("copy", F.explode(F.sequence(F.lit(0), "copies")))
    trees = trees.select("length", "cell", "shard", "copy", F.lit(0).alias("kind"), F.col("tree").alias("data"))
    place = ["length", "cell", "shard", "copy"]
    stream = trees.unionByName(sent).repartition(*place).sortWithinPartitions(*place, "kind").select("kind", "data")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: dict[str, np.ndarray] = {}
        for batch in batches:
            for kind, data in zip(batch.column(0), batch.column(1)):
                arrays = _unpacked(data.as_py())
                if kind.as_py() == 0:
                    tree = arrays
                    continue
                names, scores = search(tree, arrays["ids"], arrays["points"], k, factor, arrays["bounds"])
                row, slot = np.nonzero(np.isfinite(scores))
                columns = (arrays["ids"][row], arrays["keys"][row], names[row, slot], scores[row, slot])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "query_key", "vec_id", "score"])

    return materialize(stream.mapInArrow(answer, FOUND), "found")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, index: Index, k: int = K, factor: float = FACTOR) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest of each query (``vec_id, vector``) in the index."""
    sized = queries.select("vec_id", text_key(F.col("vector").cast("string")).alias("key"), F.size("vector").alias("length"), "vector")
    homes = _by_pivot(sized, index.pivots, "vec_id bigint, key bigint, length int, vector array<double>", ["vec_id", "key", "length", "vector"])
    homes = materialize(homes.select("vec_id", "key", "length", "vector", F.lit(float("inf")).alias("bound"), "cell"), "homes")
    first = _answers(homes, index, k, factor)
    if not index.pivots:
        return _best(first, k).select("query_id", "rank", "vec_id", "score")
    reached = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"), F.col("score").alias("reached"))
    bounded = homes.join(reached, ["vec_id", "key"], "left").select(
        "vec_id", "key", "length", "vector", F.coalesce("reached", "bound").alias("bound"), "cell"
    )
    second = _answers(materialize(_other_cells(bounded, index, factor), "asked"), index, k, factor)
    return _best(first.union(second), k).select("query_id", "rank", "vec_id", "score")


def op10_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return nearest(rows.where(F.col("vec_id") % EVERY == 0), write_index(rows))
