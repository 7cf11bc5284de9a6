"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by a path that only Spark has to read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like the ``wanted`` ones that no column in ``taken`` has (case aside)."""
    used, names = {name.lower() for name in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column, salt: int = 0) -> Column:
    """64 of the 128 bits that stand for a text; take it with two salts."""
    return F.xxhash64(F.lit(salt), text)


class _Places(dict):
    """Gives an unknown word the next place, and notes it."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class Words:
    """Ids of words, one after the other in an array, and where each word's ids lie."""

    def __init__(self, kind: type = np.int32) -> None:
        self.places = _Places()
        self.flat, self.starts, self.used = np.zeros(1 << 16, kind), np.zeros((1 << 16) + 1, np.int64), 0
        self.filled = 0

    def places_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def take_new(self) -> list[str]:
        """The words met since the last call; their ids are to be added in this order."""
        new, self.places.new = self.places.new, []
        return new

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """``ids`` of the next words; ``ends`` tells where each word ends in it."""
        count, size = self.filled + len(ends), self.used + ids.size
        while self.flat.size < size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.starts.size <= count:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used : size] = ids
        self.starts[self.filled + 1 : count + 1] = self.used + ends
        self.filled, self.used = count, size

    def ids_at(self, places: np.ndarray) -> np.ndarray:
        starts = self.starts[places]
        sizes = self.starts[places + 1] - starts
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if ends.size else 0)]


def slices(batches: Iterator[pa.RecordBatch], place: int, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut where column ``place`` passes about ``limit`` bytes, so that Python holds few texts at a time."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high


def keep_rows(df: DataFrame, text: str, wanted: Callable[[list], list[bool]]) -> DataFrame:
    """The rows whose text ``wanted`` keeps, with all columns and any schema."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            yield batch.filter(pa.array(wanted(batch.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)
