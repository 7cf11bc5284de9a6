"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is reduced to its lower-case letters with one space for anything else.  All
n-grams of 1 to ``ORDERS`` characters are hashed into a table whose columns are the
languages; the log-probability matrix is broadcast and each text is scored in numpy by
the sum of the rows its n-grams hit.

Learning counts n-grams on a sample of ``PER_LANGUAGE`` labelled rows for each language
(the documented bound; the sample is by hash of the id, so any row may be drawn), on the
executors; only the matrix of counts, at most ``MAX_CELLS`` cells, reaches the driver.

Defined results: a text that is null or has no letter, or any text if nothing was
learned, is ``und`` with score 0; of equal languages the alphabetically first wins; a
row with a null id is never used for learning and not held out; repeated rows are judged
alike; other columns are ignored by the query and pass through the filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, keep_rows, slices, table

ORDERS = 3
PER_LANGUAGE = 3_000
MAX_CELLS = 1 << 24
MOST_LANGUAGES = 1 << 14  # with the least number of bits this makes a quarter of MAX_CELLS: the broadcast stays bounded
MAX_BITS = 16
SMOOTHING = 0.5
MIN_SCORE = 0.5
UNKNOWN = "und"
_BLOCK = 1 << 18  # characters scored at a time


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: str) -> np.ndarray:
    """Code points of the lower-case letters, one space for each run of anything else, spaces at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if codes.size == 0:
        return codes
    values, places = np.unique(codes, return_inverse=True) if codes.max() > 0xFFFF else (None, None)
    if values is None:
        top = int(codes.max()) + 1
        present = np.flatnonzero(np.bincount(codes, minlength=top))
        is_letter = np.zeros(top, dtype=bool)
        is_letter[[value for value in present.tolist() if chr(value).isalpha()]] = True
        mask = is_letter[codes]
    else:
        mask = np.array([chr(value).isalpha() for value in values.tolist()])[places]
    if not mask.any():
        return codes[:0]
    codes = np.concatenate(([32], np.where(mask, codes, 32), [32])).astype(np.uint32)
    gap = codes == 32
    return codes[~(gap & np.concatenate(([False], gap[:-1])))]


def buckets(codes: np.ndarray, bits: int) -> np.ndarray:
    """The hash bucket of every n-gram of the code points."""
    rolling, out = np.zeros(codes.size, dtype=np.uint32), []
    for order in range(1, ORDERS + 1):
        if codes.size < order:
            break
        rolling = rolling[: codes.size - order + 1] * np.uint32(0x01000193) + codes[order - 1 :] + np.uint32(order)
        mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        out.append(mixed >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def blocks(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of a long text that together have each of its n-grams; those at a seam of shorter orders twice."""
    step = _BLOCK
    for start in range(0, max(1, codes.size - ORDERS + 1), step):
        yield codes[start : start + step + ORDERS - 1]


class Model:
    """Languages, hash width and the matrix of log-probabilities (buckets by languages)."""

    def __init__(self, languages: list[str], bits: int, weights: np.ndarray):
        self.languages, self.bits, self.weights = languages, bits, weights


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the rows with a language that are not held out."""
    spark = docs.sparkSession
    known = docs.select(column(id).alias("id"), column(text).alias("text"), column(lang).alias("lang")).where(
        "lang is not null and text is not null and id is not null"
    )
    known = known.where(~held_out(F.col("id")))
    sizes = {row["lang"]: row["count"] for row in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values: {lang} does not tell languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], 1, np.zeros((2, 0), dtype=np.float32))
    bits = MAX_BITS
    while bits > 8 and len(languages) << bits > MAX_CELLS:
        bits -= 1
    shares = spark.createDataFrame(
        [(name, place, min(1.0, per_language / sizes[name])) for place, name in enumerate(languages)], "lang string, place int, share double"
    )
    drawn = F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    sample = known.join(F.broadcast(shares), "lang").where(drawn).select("place", "text")
    count = len(languages)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((count, 1 << bits), dtype=np.int64)
        for batch in slices(batches, 1):
            for place, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in blocks(letters(value)):
                    totals[place] += np.bincount(buckets(part, bits), minlength=1 << bits)
        places, slots = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places.astype(np.int32)), pa.array(slots.astype(np.int32)), pa.array(totals[places, slots])], ["place", "slot", "n"]
        )

    summed = sample.mapInArrow(gather, "place int, slot int, n bigint").groupBy("place", "slot").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros((1 << bits, count))
    totals[summed["slot"].to_numpy(), summed["place"].to_numpy()] = summed["n"].to_numpy()
    totals += SMOOTHING
    return Model(languages, bits, np.log(totals / totals.sum(axis=0)).astype(np.float32))


def counted(texts: list[str | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sparse counts of a batch in parts of bounded size: ``row, slot, n`` of every n-gram bucket that occurs, by row."""
    held: list[np.ndarray] = []
    size = 0
    for row, text in enumerate(texts):
        for part in blocks(letters(text or "")):
            slots = buckets(part, bits)
            held.append(slots.astype(np.uint64) | np.uint64(row << bits))
            size += slots.size
            if size >= ORDERS * _BLOCK:
                yield _summed(held, bits)
                held, size = [], 0
    if size:
        yield _summed(held, bits)


def _summed(held: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells = np.concatenate(held)
    if not int(cells.max()) >> 32:
        cells = cells.astype(np.uint32)  # sorts faster
    cells, n = np.unique(cells, return_counts=True)
    cells = cells.astype(np.int64)
    return cells >> bits, cells & (1 << bits) - 1, n


def scorer(languages: list[str], bits: int, weights: np.ndarray) -> Callable[[list[str | None]], list[tuple[str, float]]]:
    """A function from a batch of texts to the language of each and the posterior probability of it.

    The batch is a sparse matrix of counts; its product with the matrix of log-probabilities
    gives all scores.
    """
    step = max(1, (1 << 22) // max(1, len(languages)))

    def judge(texts: list[str | None]) -> list[tuple[str, float]]:
        total = np.zeros((len(texts), len(languages)))
        seen = np.zeros(len(texts), dtype=bool)
        if languages:
            for row, slot, n in counted(texts, bits):
                seen[row] = True
                for low in range(0, row.size, step):
                    own = row[low : low + step]
                    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                    cells = weights[slot[low : low + step]].astype(np.float64) * n[low : low + step, None]
                    total[own[first]] += np.add.reduceat(cells, first, axis=0)
        if not seen.any():
            return [(UNKNOWN, 0.0)] * len(texts)
        total /= ORDERS  # the orders overlap: one of them counts
        best = total.argmax(axis=1)
        score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [(languages[b], float(p)) if known else (UNKNOWN, 0.0) for b, p, known in zip(best, score, seen)]

    return judge


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.bits, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = scorer(*sent.value)
        for batch in slices(batches, 2):
            made = judge(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    source = docs.select(column(id).cast("bigint").alias("doc_id"), held_out(column(id)).alias("held_out"), column(text).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def known_language_only(docs: DataFrame, model: Model, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text has a language with at least ``min_score``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.bits, model.weights))

    def wanted(texts: list) -> list[bool]:
        judge = scorer(*sent.value)
        return [found != UNKNOWN and score >= min_score for found, score in judge(texts)]

    return keep_rows(docs, text, wanted)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
