"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are dealt by ranges of ``doc_id``, sorted and encoded, and each range becomes
one ORC file (a shard), so shards in order hold the corpus in ascending ``doc_id``.
ORC stores the ids by run-length encoding.  A file's stripes can be read in parallel; its
statistics, row index and Bloom filter let a reader skip the stripes and row groups
without a wanted document.  Each row also stores where it starts in its shard, so a
document's place in the whole corpus is that plus the sizes of earlier shards: a sum over
one number per shard, with no corpus-wide window.

The tokenizer drops white space, and none of its tokens or normalisations spans it, so
the ids of a text are those of its words.  In texts of Latin letters, digits and ASCII
marks the words are plain to see; the library encodes each distinct one once per Python
worker, and its ids are remembered.  Other texts are encoded whole, as are all with
``by_word=False``, which other tokenizers need.

Defined results: a null text counts as empty and has the end id only; a null id comes
first; rows with the same id are ordered by a hash of the text; repeated rows are all
written; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm.common import Words, column, slices, table
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import shared_dir

MODEL = "word_bpe_49k.json"
END = 1
_REMEMBERED = 400_000  # words a Python worker keeps; beyond it the memory starts anew
FILE_SCHEMA = "doc_id bigint, shard int, shard_start bigint, n_tokens bigint, ids array<int>"
ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

# Texts of blanks, letters of Latin-1, digits and ASCII marks, but no apostrophe: there the
# tokenizer's words are runs of letters, single digits and runs of marks.
_OTHER = re.compile("[^\t-\r A-Za-zÀ-ÖØ-öø-ÿ!-&(-~]|<\\|")
_APART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class Encoder:
    """Ids of texts, by way of remembered words; ``memory`` outlives the task if the caller keeps it."""

    def __init__(self, tokenizer: str, by_word: bool = True, memory: dict | None = None):
        self.memory = {} if memory is None else memory
        self.by_word = by_word
        if not self.memory:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            self.memory["whole"] = made = Tokenizer.from_str(tokenizer)
            self.memory["words"] = Words()
            if by_word:
                plan = json.loads(tokenizer)
                # For words parted and lowered beforehand: what is left of the plan is the last step.
                last = plan["pre_tokenizer"]["pretokenizers"][-1]
                plan.update(normalizer=None, pre_tokenizer={"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, last]})
                self.memory["parted"] = Tokenizer.from_str(json.dumps(plan))
                suffix = made.model.end_of_word_suffix
                vocabulary = sorted(made.get_vocab().items(), key=lambda pair: pair[1])
                self.memory["ends"] = np.array([word.endswith(suffix) for word, _ in vocabulary])

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(made.ids, np.int32) for made in self.memory["whole"].encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, known: Words) -> None:
        """Encode the new words in a few texts, and part their ids at the word ends."""
        if new := known.take_new():
            texts = [" ".join(new[low : low + 4096]) for low in range(0, len(new), 4096)]
            made = self.memory["parted"].encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(one.ids, np.int32) for one in made])
            ends = np.flatnonzero(self.memory["ends"][ids]) + 1
            if ends.size != len(new):
                raise ValueError("the tokenizer's words do not end in its end-of-word mark; encode by_word=False")
            known.add(ids, ends)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_word:
            return self.whole(texts)
        if len(self.memory["words"].places) > _REMEMBERED:
            self.memory["words"] = Words()
        known = self.memory["words"]
        plain = [not _OTHER.search(text) for text in texts]
        places = [known.places_of(_APART.findall(text.lower())) if easy else None for text, easy in zip(texts, plain)]
        self.learn(known)
        others = iter(self.whole([text for text, easy in zip(texts, plain) if not easy]))
        return [known.ids_at(own) if easy else next(others) for own, easy in zip(places, plain)]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, id: str = "doc_id", text: str = "text",
    by_word: bool = True, shards: int | None = None,
) -> None:
    """Encode every text and write the ids below ``path``; ``shards`` defaults to the session's shuffle partitions."""
    with open(tokenizer or public_tokenizers.path(MODEL), encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast({"json": file.read(), "memory": {}})
    rows = docs.select(column(id).cast("bigint").alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    # The text's hash and the row's place split a range that one id fills.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = rows.repartitionByRange(shards, *order) if shards else rows.repartitionByRange(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value["json"], by_word, sent.value["memory"])
        shard, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches, 1):
            made = encoder.encode_all(batch.column(1).to_pylist())
            sizes = np.array([ids.size + 1 for ids in made], np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            values = np.full(offsets[-1], end, np.int32)
            for ids, at in zip(made, offsets):
                values[at : at + ids.size] = ids
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
            numbers = [pa.array(np.full(len(made), shard, np.int32)), pa.array(before + offsets[:-1]), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, lists], ["doc_id", "shard", "shard_start", "n_tokens", "ids"])
            before += int(offsets[-1])

    encoded = dealt.sortWithinPartitions(*order[:2]).mapInArrow(encode, FILE_SCHEMA)
    encoded.write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files, with ``start``: the ids of all documents before."""
    files = spark.read.schema(FILE_SCHEMA).orc(path)
    sizes = files.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("size"))
    # One row per file.
    before = F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("offset"))
    return files.join(broadcast_if_small(offsets), "shard").select(
        "doc_id", (F.col("offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes and row groups without them are skipped by statistics and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows with ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            sizes = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return checksums(read_token_files(spark, path))
