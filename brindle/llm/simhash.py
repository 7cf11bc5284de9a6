"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits over the word shingles of a text.  To find all pairs that
differ in at most ``radius`` bits, the fingerprint is cut into segments.  Two such
fingerprints differ by at most ``radius // segments`` bits in one segment (pigeonhole),
so each fingerprint looks up a small Hamming ball around each of its segments in the
table of segments, and the complete distance is verified inside the join.

Copies fold first: the search runs over distinct fingerprints, so a group of copies is
one row in it, however large.  The join gives verified links only, each once; what
leaves it is bounded by the true neighbours of a fingerprint.

Defined results: a null, empty or blank text has fingerprint zero and links like any
other; a null id is never the smallest unless all are null; repeated rows keep one
output row each; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, fresh, table, text_key
from brindle.plans.workspace import materialize

SEED = 42
SHINGLE = 3
RADIUS = 3
SEGMENTS = 2
_BLOCK = 1 << 16  # words hashed at a time, to bound memory on very long texts


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text, as a signed 64-bit integer."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    width = min(width, len(words))
    total = len(words) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _BLOCK):
        own = words[start : start + _BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(own[i:] for i in range(width))))
        hashes = np.array([xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns of every row, and its ``fingerprint`` (bigint)."""
    source = docs.select(*[column(name) for name in keep], column(text).cast("binary").alias(fresh(keep, "text")[0]))
    (name,) = fresh(keep, "fingerprint")
    schema = docs.select(*[column(k) for k in keep]).schema.add(name, "long")
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(value.as_py(), width) for value in batch.column(kept)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(made, pa.int64())], [*batch.schema.names[:kept], name]
            )

    return source.mapInArrow(run, schema)


def _ball(bits: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of the lowest ``bits`` bits, the empty one first."""
    return [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def close_pairs(prints: DataFrame, name: str = "fingerprint", radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``a, b`` of the distinct values in ``prints`` that differ in 1 to ``radius`` bits, each pair once."""
    width = -(-64 // segments)
    near = radius // segments
    sides = []
    for segment in range(segments):
        bits = min(width, 64 - segment * width)
        low = F.lit((1 << bits) - 1 if bits < 64 else -1).cast("bigint")
        part = F.shiftrightunsigned(F.col(name), segment * width).bitwiseAND(low)
        sides.append((part, bits, segment << width if width < 62 else 0))
    stored = F.explode(F.array(*[part.bitwiseOR(F.lit(tag)) for part, _, tag in sides]))
    table_side = prints.select(stored.alias("key"), F.col(name).alias("stored"))

    def probes(part: Column, bits: int, tag: int) -> Column:
        masks = F.array(*[F.lit(mask).cast("bigint") for mask in _ball(bits, near)])
        if near == 1:  # of two segments one bit apart, the one with the 0 asks
            masks = F.filter(masks, lambda mask: part.bitwiseAND(mask) == 0)
        return F.transform(masks, lambda mask: part.bitwiseXOR(mask).bitwiseOR(F.lit(tag)))

    asked = prints.select(F.explode(F.concat(*[probes(*side) for side in sides])).alias("key"), F.col(name).alias("asking"))

    differing = F.bit_count(F.col("asking").bitwiseXOR(F.col("stored")))
    found = asked.join(table_side, "key").where(differing.between(1, radius))
    return found.select(
        F.least("asking", "stored").alias("a"), F.greatest("asking", "stored").alias("b")
    ).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected ``links`` (``a, b``); the root is the smallest node reachable.

    Large-star and small-star rounds, each written to the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("root"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("root").alias("v"))
        edges = materialize(small.where("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def duplicate_classes(signed: DataFrame, member: str, name: str = "fingerprint", radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Every distinct fingerprint with the least ``member`` its near-duplicates reach: ``fingerprint, least``.

    ``signed`` should be a written table: it is read more than once.
    """
    folded = materialize(signed.groupBy(name).agg(F.min(member).alias("least")), "prints")
    linked = components(close_pairs(folded.select(name), name, radius, segments))
    # Only fingerprints with links meet by component; most have none.
    best = linked.join(folded, linked["node"] == folded[name]).groupBy("root").agg(F.min("least").alias("best"))
    known = linked.join(best, "root").select("node", "best")
    classes = folded.join(known, folded[name] == known["node"], "left").select(name, F.coalesce("best", "least").alias("least"))
    # Written, so that a join with a hot class reads plain shuffles, which adaptive execution can split.
    return materialize(classes, "classes")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``."""
    signed = materialize(fingerprints(docs.select(column(id).alias("doc_id"), column(text).alias("text")), ["doc_id"], "text", width), "signed")
    classes = duplicate_classes(signed, "doc_id", radius=radius)
    return signed.join(classes, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def keep_least(docs: DataFrame, classes: Callable[[DataFrame, str], DataFrame], id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are ``least`` in what ``classes`` makes of the rows and the name of their key column.

    A null id counts as the largest.  Rows equal in id and text count as one.
    """
    who, first, second, k_id, k_x, k_y = fresh(docs.columns, "llm_who", "llm_first", "llm_second", "kept_id", "kept_x", "kept_y")
    # The text itself is not carried: id and 128 bits of the text name a row.
    named = docs.withColumns({first: text_key(column(text)), second: text_key(column(text), 1)})
    named = named.withColumn(
        who, F.struct(column(id).isNull().alias("none"), column(id).alias("id"), column(first).alias("x"), column(second).alias("y")),
    )
    kept = classes(named, who).select(F.col("least.id").alias(k_id), F.col("least.x").alias(k_x), F.col("least.y").alias(k_y))
    match = column(id).eqNullSafe(F.col(k_id)) & (column(first) == F.col(k_x)) & (column(second) == F.col(k_y))
    return named.drop(who).join(kept, match, "left_semi").dropDuplicates([id, first, second]).select(*[column(c) for c in docs.columns])


def one_per_class(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: that of the smallest id."""

    def classes(named: DataFrame, who: str) -> DataFrame:
        signed = materialize(fingerprints(named, [who], text, width), "signed")
        return duplicate_classes(signed, who, radius=radius)

    return keep_least(docs, classes, id, text)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
