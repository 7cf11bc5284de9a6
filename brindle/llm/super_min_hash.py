"""Near-duplicates by SuperMinHash, banding, verification and union-find grouping.

A text's set holds its distinct shingles.  SuperMinHash gives a set ``REGISTERS`` numbers:
every element draws, rank after rank, a random fraction and the next place of a random
permutation of the registers, and offers rank plus fraction to the register at that place.
The least offer stays.  As one element serves each register at a different rank, the
registers of small sets vary less than independent minima; and as no later rank can beat a
lower one, a set is finished at the first rank after which all registers hold less.  Here a
rank is drawn for all elements of many sets at once, and finished sets leave the arrays.

Registers are banded: sets that agree on all ``ROWS`` registers of one of ``BANDS`` bands
share a key, which two sets of similarity ``s`` miss with chance ``(1 - s ** ROWS) ** BANDS``:
6 in 100,000 at 0.8, less above.  That chance is the only loss; each candidate is verified on
the whole sets, in joins.

Equal sets fold first.  In a key all sets meet one of them, its hub: the set that shares
most keys with others, which is where edited copies of one text meet their original.  Links
are contracted to classes, the hub leaves the key, and the next round takes keys that still
hold several classes.  Each round is linear in the sets left.  After ``ROUNDS`` of them sets of
different classes that still share a key are compared inside one join, which gives links
only, no candidates.

Defined results: words are ASCII-blank separated and A-Z are lower-cased; a text of fewer
words than a shingle is one shingle, and one without words has an empty set that links with
nothing; a null id is the smallest only of a class without others, and is kept then; repeated
rows keep one output row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, slices, table, text_key
from brindle.llm.simhash import components
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

SHINGLE = 2
PERCENT = 80  # of the union that two linked sets share, at least
BANDS = 32
ROWS = 6
REGISTERS = BANDS * ROWS
ROUNDS = 2  # of hubs, at most; what is left after that is compared directly
_AT_ONCE = 1 << 14  # elements whose permutations are held at a time

_U = np.uint64
_STEP, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)  # fixed values of the SplitMix64 mixer
_LOW = _U(0xFFFFFFFF)


def mixed(values: np.ndarray) -> np.ndarray:
    """The values under a fixed permutation of all 64-bit numbers that looks random."""
    values = (values ^ (values >> _U(30))) * _M1
    values = (values ^ (values >> _U(27))) * _M2
    return values ^ (values >> _U(31))


def shingle_set(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a UTF-8 text as sorted 64-bit hashes."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    made = np.full(len(words) - width + 1, width, np.uint64)
    for place in range(width):
        made = mixed(made * _STEP + hashed[place : place + made.size])
    return np.unique(made)


def signatures(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """One row of registers for each set; those of an empty set are all ones."""
    found = np.full((len(sets), registers), ~_U(0), np.uint64)
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for owner, elements in enumerate(sets):
        for low in range(0, elements.size, _AT_ONCE):
            part = elements[low : low + _AT_ONCE]
            if size + part.size > _AT_ONCE:
                _offer(found, held)
                held, size = [], 0
            held.append((owner, part))
            size += part.size
    if held:
        _offer(found, held)
    return found


def _offer(found: np.ndarray, held: list[tuple[int, np.ndarray]]) -> None:
    """Lower ``found`` by the offers of the elements, rank after rank."""
    registers, flat = found.shape[1], found.reshape(-1)
    sets = np.unique([owner for owner, _ in held])
    owners = np.repeat([owner for owner, _ in held], [part.size for _, part in held])
    elements = np.concatenate([part for _, part in held])
    order = None
    with np.errstate(over="ignore"):
        for rank in range(registers):
            drawn = mixed(elements + _U(rank + 1) * _STEP)
            place = rank + ((drawn & _LOW) * _U(registers - rank) >> _U(32)).astype(np.int64)
            register = place
            if order is not None:  # the elements' permutations; the first rank needs none yet
                rows = np.arange(elements.size)
                register = order[rows, place].astype(np.int64)
                order[rows, place] = order[:, rank]
            np.minimum.at(flat, owners * registers + register, _U(rank << 32) | (drawn >> _U(32)))
            sets = sets[found[sets].max(axis=1) >= _U((rank + 1) << 32)]
            if not sets.size:
                return
            unfinished = np.zeros(len(found), bool)
            unfinished[sets] = True
            live = unfinished[owners]
            if not live.all():
                owners, elements, place = owners[live], elements[live], place[live]
                order = None if order is None else order[live]
            if order is None:
                order = np.tile(np.arange(registers, dtype=np.uint16 if registers > 256 else np.uint8), (elements.size, 1))
                order[np.arange(elements.size), place] = 0


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key for each band of each row of registers."""
    bands = found.reshape(len(found), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for place in range(ROWS):
        keys = mixed(keys * _STEP + bands[:, :, place])
    return keys.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(part.size for part in parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _named(elements: np.ndarray) -> tuple[int, int]:
    name = xxhash.xxh3_128_digest(elements.tobytes())
    return int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True)


def signed(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, first, second`` (128 bits of the text), ``x, y`` (128 bits of the set), ``size`` and band ``keys`` of each row."""
    kept = docs.schema.names.index("text")
    schema = "doc_id bigint, first bigint, second bigint, x bigint, y bigint, size bigint, keys array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, kept):
            sets = [shingle_set(value.as_py(), width) for value in batch.column(kept)]
            keys = band_keys(signatures(sets))
            names = [_named(one) for one in sets]
            made = [keys[i] if one.size else keys[i, :0] for i, one in enumerate(sets)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:kept], pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()),
                    pa.array([one.size for one in sets], pa.int64()), _lists(made),
                ],
                names=["doc_id", "first", "second", "x", "y", "size", "keys"],
            )

    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``node, found`` of rows of ``node, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 1 << 19):
            sets = [shingle_set(value.as_py(), width) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["node", "found"])

    return docs.mapInArrow(run, "node bigint, found array<bigint>")


def _sizes_allow(first: Column, second: Column) -> Column:
    return F.least(first, second) * 100 >= F.greatest(first, second) * PERCENT


def _alike(found_a: Column, found_b: Column) -> Column:
    shared = F.size(F.array_intersect(found_a, found_b)).cast("bigint")
    return shared * 100 >= (F.size(found_a) + F.size(found_b) - shared) * PERCENT


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar."""
    sides = [sets.select(F.col("node").alias(side), F.col("found").alias(f"found_{side}")) for side in "ab"]
    return pairs.join(sides[1], "b").join(sides[0], "a").where(_alike(F.col("found_a"), F.col("found_b"))).select("a", "b")


def _pair(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def direct(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between sets of different classes in the keys of ``left``: no pair leaves the join but a link.

    A pair is compared in the first of the keys it shares, so the whole sets travel with
    the keys.
    """
    own = left.groupBy("node").agg(F.collect_set("key").alias("keys")).join(sets, "node")
    rows = materialize(left.select("key", "node", "size", "root").join(own, "node"), "hard")
    a, b = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "root", "keys", "found")]) for side in "ab")
    same = (a["key"] == b["key"]) & (F.col("root_a") < F.col("root_b")) & _sizes_allow(F.col("size_a"), F.col("size_b"))
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == a["key"]
    links = a.join(b, same & first & _alike(F.col("found_a"), F.col("found_b")))
    return links.select(*_pair("node_a", "node_b"))


def links(buckets: DataFrame, sets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Links ``a, b`` that connect the similar sets of ``buckets`` (``key, node, size, central``)."""
    left, near, done = buckets.withColumn("root", F.col("node")), None, 0
    while True:
        hub = F.max_by(F.struct("node", "size", "root"), F.struct("central", -F.col("node")))
        hubs = left.groupBy("key").agg(hub.alias("hub")).select("key", "hub.*").toDF("key", "hub", "hub_size", "hub_root")
        met = materialize(left.join(broadcast_if_small(materialize(hubs, "hubs")), "key").where("node <> hub"), "met")
        pairs = met.where((F.col("root") != F.col("hub_root")) & _sizes_allow(F.col("size"), F.col("hub_size")))
        found = verified(pairs.select(*_pair("node", "hub")).distinct(), sets)
        near = materialize(found if near is None else near.union(found), "near")
        done += 1
        rooted = met.select("key", "node", "size", "central").join(components(near), "node", "left")
        rooted = materialize(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
        # Keys that still hold several classes.
        mixed_keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
        mixed_keys = materialize(mixed_keys, "mixed-keys")
        if mixed_keys.isEmpty():
            return near
        left = rooted.join(broadcast_if_small(mixed_keys), "key", "left_semi")
        if done >= rounds:
            return near.union(direct(left, sets))
        left = materialize(left, "left")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    plain = docs.select(
        column(id).alias("doc_id"), text_key(column(text)).alias("first"), text_key(column(text), 1).alias("second"),
        column(text).cast("binary").alias("text"),
    )
    rows = materialize(signed(plain, width), "signed")
    alike = rows.where("size > 0").groupBy("x", "y", "size")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "first", "second")  # a null id comes last
    folded = alike.agg(F.min(least).alias("row"), F.first("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id())
    folded = materialize(folded.select("node", "x", "y", "size", "keys", F.col("row.doc_id").alias("least"), "row"), "folded")

    entries = folded.select("node", "size", F.explode("keys").alias("key"))
    shared = materialize(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    buckets = materialize(entries.join(broadcast_if_small(shared), "key"), "buckets")
    central = materialize(buckets.groupBy("node").agg(F.sum("n").alias("central")), "central")
    buckets = materialize(buckets.drop("n").join(broadcast_if_small(central), "node"), "ranked")
    wanted = folded.join(central.select("node"), "node", "left_semi").select("node", "row.first", "row.second", F.col("least").alias("id"))
    listed = broadcast_if_small(materialize(wanted, "wanted"))
    texts = plain.join(listed, (plain["first"] == listed["first"]) & (plain["second"] == listed["second"]) & F.col("doc_id").eqNullSafe(F.col("id")))
    texts = texts.select("node", "text")
    sets = materialize(_sets(texts.dropDuplicates(["node"]), width), "sets")

    linked = components(links(buckets, sets))
    best = linked.join(folded, "node").groupBy("root").agg(F.min("least").alias("best"))
    known = linked.join(best, "root").select("node", "best")
    classes = folded.join(known, "node", "left").select("x", "y", F.coalesce("best", "least").alias("component_id"))
    # Written, so that a join with a hot class reads plain shuffles, which adaptive execution can split.
    found = rows.select("doc_id", "x", "y", "size").join(materialize(classes, "classes"), ["x", "y"], "left")
    component = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op12_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
