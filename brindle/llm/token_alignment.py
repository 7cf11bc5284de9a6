"""Alignment of the tokens of two tokenizers by lockstep merging.

A text is encoded by a byte-level tokenizer (A) and by a SentencePiece model (B).  Where a
token of each ends at the same byte, the text is cut; the tokens between two cuts are a
group, and every A token of a group is linked with every B token of it.

All texts of a batch are merged at once: one state vector holds, for each, the places in its
two lists of token ends.  A step compares all pairs of ends, emits the groups that close,
advances the side (or both) whose token ends first, and leaves out what is finished.  Long
texts enter as several entries, parted at cuts, so that a batch ends together.

Neither tokenizer has a token over a blank and what stands before it, so in texts of single
blanks and line breaks, Latin letters and usual marks every word ends in a cut.  Such texts
enter as their words: a word new to the Python worker is encoded and merged with all other
new ones of the batch, and its groups and links are remembered.  Other texts are encoded
and merged whole, as are all if the vocabulary has tokens over blanks.

The number of documents that hold an id pair linked is a count over the distinct pairs of
each document, combined before its shuffle.  It meets the documents by a broadcast where
its size allows, and by a join otherwise.

Defined results: a null or empty text, or one whose tokens do not spell it, has no tokens,
zeros and an empty digest column; a null id is kept; repeated rows each count as a document
and keep one output row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm.common import Words, column, slices, table
from brindle.plans.sizing import broadcast_if_small
from brindle.plans.workspace import materialize

MODEL_A = "byte_bpe_50k.json"
MODEL_B = "piece_bpe_32k.model"
ENTRY = 512  # A tokens of an entry of the state vector, about
_PROBE = 64  # A tokens looked through for a cut to part a text at
_WIDE = 1 << 12  # links of a group from which its ids are folded before they are paired
_REMEMBERED = 150_000  # words a Python worker keeps; beyond it the memory starts anew

# Texts that are not blanks and words alone: other letters and marks, two blanks together or
# one at the end, and words of great length, which are not worth remembering.
_OTHER = re.compile("[^\n -~À-ÖØ-öø-ÿ‐-‧]|[ \n](?:[ \n]|\\Z)|[^ \n]{100}")
_WORD = re.compile("[ \n][^ \n]*")
_OVER_BLANK = re.compile(rb"(?:[!-~]|\xc3[\x80-\xbf]|\xe2\x80[\x90-\xa7])[ \n]")  # a blank after a letter or mark of such texts

ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
    " pairs array<bigint>, times array<bigint>"
)


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable bytes are themselves, others follow from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


class Tokens:
    """Two tokenizers with the bytes of their tokens."""

    def __init__(self, tokenizer: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(tokenizer)
        self.a.encode_special_tokens = True  # their strings in a text are then ordinary text
        alphabet = byte_alphabet()
        added = {token["id"]: token["content"] for token in json.loads(tokenizer)["added_tokens"]}
        entries = sorted(self.a.get_vocab().items(), key=lambda entry: entry[1])
        self.bytes_a = [
            added[i].encode() if i in added else bytes(alphabet[letter] for letter in entry) for entry, i in entries
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([len(one) for one in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # What an id looks like in the digest: followed by another of its side, or last of it in its group.
        ids = [b"%d" % i for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.shown = [one + mark for mark in (b",", b"|", b";") for one in ids]
        self.stride = len(ids)
        self.by_word = not any(_OVER_BLANK.search(one) for one in (*self.bytes_a, *self.bytes_b))
        self.words = WordLinks(self)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _spelt(self, first: list[int], second: list[int], text: str) -> bool:
        want = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, first)) == want == b"".join(map(self.bytes_b.__getitem__, second))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each text by both; none where the tokens do not spell a blank and the text."""
        first = [made.ids for made in self.a.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)]
        second = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            if not text or not self._spelt(first[i], second[i], " " + text):
                first[i], second[i] = [], []
        return first, second

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of words, each with the blank or line break before it."""
        first = [made.ids for made in self.a.encode_batch_fast(words, add_special_tokens=False)]
        # The model puts a blank before what it reads: it stands for the one there, and goes before a line break.
        second = self.b.encode([word.removeprefix(" ") for word in words], num_threads=1)
        return first, [ids if word[0] == " " else ids[1:] for word, ids in zip(words, second)]


@dataclass
class Side:
    """The tokens of one tokenizer for all texts of a batch, one text after the other."""

    ids: np.ndarray
    ends: np.ndarray  # of each token, in the bytes of its text
    first: np.ndarray  # where the texts begin, and the number of all tokens

    @classmethod
    def of(cls, texts: list[list[int]], sizes: np.ndarray) -> Side:
        first = np.cumsum([0, *map(len, texts)])
        ids = np.fromiter(chain.from_iterable(texts), np.int64, first[-1])
        ends = np.cumsum(sizes[ids])
        counts = np.diff(first)
        begins = np.concatenate([[0], ends])[first[:-1]]
        return cls(ids, ends - np.repeat(begins, counts), first)


def entries(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the entries of the state vector begin on both sides, and where they end on side A."""
    low_a, high_a, low_b = a.first[:-1], a.first[1:], b.first[:-1]
    parts = [(low_a[low_a < high_a], low_b[low_a < high_a])]
    for text in np.flatnonzero(high_a - low_a > ENTRY + _PROBE):
        ends_b = b.ends[low_b[text] : b.first[text + 1]]
        for probe in range(low_a[text] + ENTRY, high_a[text] - _PROBE, ENTRY):
            looked = a.ends[probe : probe + _PROBE]
            place = np.searchsorted(ends_b, looked)
            shared = np.flatnonzero(ends_b[place] == looked)[:1]
            parts.append((probe + shared + 1, low_b[text] + place[shared] + 1))
    begin_a, begin_b = (np.sort(np.concatenate(side)) for side in zip(*parts))
    return begin_a, begin_b, np.concatenate([begin_a[1:], a.first[-1:]])[: begin_a.size]


def groups(a: Side, b: Side) -> np.ndarray:
    """The groups of all texts in order: one row each, with the places where its tokens begin and end on side A and side B."""
    at_a, at_b, stop = entries(a, b)
    from_a, from_b = at_a.copy(), at_b.copy()
    closed: list[np.ndarray] = []
    while at_a.size:
        end_a, end_b = a.ends[at_a], b.ends[at_b]
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        cut = np.flatnonzero(end_a == end_b)
        if cut.size:
            closed.append(np.stack([from_a[cut], at_a[cut], from_b[cut], at_b[cut]], axis=1))
            from_a[cut], from_b[cut] = at_a[cut], at_b[cut]
            going = at_a < stop
            if not going.all():
                at_a, at_b, from_a, from_b, stop = at_a[going], at_b[going], from_a[going], from_b[going], stop[going]
    if not closed:
        return np.zeros((0, 4), np.int64)
    found = np.concatenate(closed)
    return found[np.argsort(found[:, 0])]


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of ``sizes``: the range each member belongs to, and its place in it."""
    owner = np.repeat(np.arange(sizes.size), sizes)
    return owner, np.arange(owner.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def linked(found: np.ndarray, a: Side, b: Side, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``text``, ``pair`` (A id times ``size_b`` plus B id) and how often it is linked, by text."""
    span = size_a * size_b
    key_of = (np.searchsorted(a.first, found[:, 0], side="right") - 1) * span
    sizes_a, sizes_b = found[:, 1] - found[:, 0], found[:, 3] - found[:, 2]
    wide = sizes_a * sizes_b > _WIDE
    usual, across = found[~wide], sizes_b[~wide]
    owner, place = _spread((sizes_a * sizes_b)[~wide])
    row, col = np.divmod(place, across[owner])
    links = key_of[~wide][owner] + a.ids[usual[owner, 0] + row] * size_b + b.ids[usual[owner, 2] + col]
    keys, times = np.unique(links, return_counts=True)
    if wide.any():
        keys, times = [keys], [times]
        for group in np.flatnonzero(wide):
            low_a, high_a, low_b, high_b = found[group]
            own_a, often_a = np.unique(a.ids[low_a:high_a], return_counts=True)
            own_b, often_b = np.unique(b.ids[low_b:high_b], return_counts=True)
            keys.append((key_of[group] + own_a[:, None] * size_b + own_b).reshape(-1))
            times.append((often_a[:, None] * often_b).reshape(-1))
        keys, place = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(place, np.concatenate(times)).astype(np.int64)
    text, pair = np.divmod(keys, span)
    return text, pair, times


def shown_groups(found: np.ndarray, a: Side, b: Side, tokens: Tokens) -> list[bytes]:
    """The groups of each text as in its digest, each followed by ``;``."""
    (begin_a, end_a, begin_b, end_b), stride = found.T, tokens.stride
    marked_a, marked_b = a.ids.copy(), b.ids.copy()
    marked_a[end_a - 1] += stride
    marked_b[end_b - 1] += 2 * stride
    owner_a, owner_b = np.repeat(np.arange(len(found)), end_a - begin_a), np.repeat(np.arange(len(found)), end_b - begin_b)
    # A token of A stands behind the B tokens of earlier groups, one of B behind the A tokens of its own group too.
    order = np.empty(a.ids.size + b.ids.size, np.int64)
    order[np.arange(a.ids.size) + begin_b[owner_a]] = marked_a
    order[np.arange(b.ids.size) + end_a[owner_b]] = marked_b
    limits = (a.first + b.first).tolist()
    shown, codes = tokens.shown, order.tolist()
    return [b"".join(map(shown.__getitem__, codes[low:high])) for low, high in zip(limits, limits[1:])]


@dataclass
class Aligned:
    """What a batch of texts gives: a row of counts (A tokens, B tokens, groups) and a digest for each, and the links of all."""

    counts: np.ndarray
    digests: list[str]
    keys: np.ndarray  # text times the number of possible pairs, plus the pair, sorted
    times: np.ndarray


class WordLinks:
    """Groups and links of words met before, by the place of the word."""

    def __init__(self, tokens: Tokens) -> None:
        self.tokens, self.known = tokens, Words(np.int64)
        self.counts = np.zeros((1 << 16, 3), np.int64)
        self.shown: list[bytes] = []

    def learn(self) -> None:
        new = self.known.take_new()
        if not new:
            return
        tokens = self.tokens
        ids_a, ids_b = tokens.encode_words(new)
        a, b = Side.of(ids_a, tokens.sizes_a), Side.of(ids_b, tokens.sizes_b)
        ends = np.cumsum([len(word.encode()) for word in new])
        for side, known in ((a, tokens.bytes_a), (b, tokens.bytes_b)):
            spelt = b"".join(map(known.__getitem__, side.ids.tolist()))
            if spelt != "".join(new).encode() or (np.cumsum(side.ends[side.first[1:] - 1]) != ends).any():
                raise ValueError("the tokens do not spell the words; align by_word=False")
        found = groups(a, b)
        text_of, pair, times = linked(found, a, b, len(tokens.bytes_a), len(tokens.bytes_b))
        low = len(self.shown)
        while len(self.counts) < low + len(new):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[low : low + len(new)] = _counts(found, a, b)
        self.shown += shown_groups(found, a, b, tokens)
        self.known.add(np.repeat(pair, times), np.searchsorted(np.repeat(text_of, times), np.arange(len(new)), side="right"))

    def align(self, texts: list[str]) -> Aligned:
        """The same as of whole texts, for texts that part at blanks."""
        if len(self.known.places) > _REMEMBERED:
            self.__init__(self.tokens)
        places = [self.known.places_of(_WORD.findall(" " + text)) for text in texts]
        self.learn()
        ends = np.cumsum([0, *(own.size for own in places)])
        flat = np.concatenate([*places, np.zeros(0, np.int64)])
        sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(self.counts[flat], axis=0)])
        counts = np.diff(sums[ends], axis=0)
        shown = [hashlib.sha256(b"".join(map(self.shown.__getitem__, own.tolist()))[:-1]).hexdigest() for own in places]
        starts = self.known.starts
        text_of = np.repeat(np.repeat(np.arange(len(texts)), np.diff(ends)), (starts[flat + 1] - starts[flat]))
        span = len(self.tokens.bytes_a) * len(self.tokens.bytes_b)
        return Aligned(counts, shown, *np.unique(text_of * span + self.known.ids_at(flat), return_counts=True))


def _counts(found: np.ndarray, a: Side, b: Side) -> np.ndarray:
    return np.stack([np.diff(a.first), np.diff(b.first), np.diff(np.searchsorted(found[:, 0], a.first))], axis=1)


def align_whole(texts: list[str], tokens: Tokens) -> Aligned:
    ids_a, ids_b = tokens.encode(texts)
    a, b = Side.of(ids_a, tokens.sizes_a), Side.of(ids_b, tokens.sizes_b)
    found = groups(a, b)
    size_a, size_b = len(tokens.bytes_a), len(tokens.bytes_b)
    text_of, pair, times = linked(found, a, b, size_a, size_b)
    digests = [hashlib.sha256(one[:-1]).hexdigest() if one else "" for one in shown_groups(found, a, b, tokens)]
    return Aligned(_counts(found, a, b), digests, text_of * (size_a * size_b) + pair, times)


def align(texts: list[str], tokens: Tokens, by_word: bool = True) -> Aligned:
    """All texts of a batch, those that part at blanks by their words."""
    easy = [by_word and tokens.by_word and text != "" and not _OTHER.search(" " + text) for text in texts]
    sides = (tokens.words.align([text for text, one in zip(texts, easy) if one]), align_whole([text for text, one in zip(texts, easy) if not one], tokens))
    counts, digests = np.zeros((len(texts), 3), np.int64), [""] * len(texts)
    span, keys = len(tokens.bytes_a) * len(tokens.bytes_b), []
    for side, wanted in zip(sides, (True, False)):
        places = np.flatnonzero(np.array(easy, bool) == wanted)
        counts[places] = side.counts
        for place, digest in zip(places.tolist(), side.digests):
            digests[place] = digest
        text_of, pair = np.divmod(side.keys, span)
        keys.append(places[text_of] * span + pair)
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    return Aligned(counts, digests, keys[order], np.concatenate([side.times for side in sides])[order])


def aligned(
    docs: DataFrame, model_a: str | None = None, model_b: str | None = None, id: str = "doc_id", text: str = "text", by_word: bool = True
) -> DataFrame:
    """For each row a number of its own (``row``), its counts and digest, and its distinct linked id ``pairs`` with their ``times``."""
    with open(model_a or public_tokenizers.path(MODEL_A), encoding="utf-8") as first, open(model_b or public_tokenizers.path(MODEL_B), "rb") as second:
        # A broadcast value lives as long as its Python worker, so tasks share the tokenizers in ``memory``.
        sent = docs.sparkSession.sparkContext.broadcast({"a": first.read(), "b": second.read(), "memory": {}})
    source = docs.select(column(id).cast("bigint").alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = sent.value["memory"]
        if not memory:
            memory["tokens"] = Tokens(sent.value["a"], sent.value["b"])
        tokens: Tokens = memory["tokens"]
        span = len(tokens.bytes_a) * len(tokens.bytes_b)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1, 1 << 20):
            made, size = align(batch.column(1).to_pylist(), tokens, by_word), batch.num_rows
            text_of, pair = np.divmod(made.keys, span)
            offsets = np.searchsorted(text_of, np.arange(size + 1))
            links = np.diff(np.concatenate([[0], np.cumsum(made.times)])[offsets])
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64())) for values in (pair, made.times)]
            numbers = [*made.counts.T, links]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + size), pa.int64()), batch.column(0), *(pa.array(one, pa.int64()) for one in numbers),
                    pa.array(made.digests, pa.string()), *lists,
                ],
                names=[field.split()[0] for field in ALIGNED.split(",")],
            )
            row += size

    return source.mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """``pair, held`` (documents that hold it linked) and whether that is the most of its A id (``best``)."""
    held = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("held"))
    held = materialize(held.withColumn("a", F.expr(f"pair div {width}")), "pairs")
    most = held.groupBy("a").agg(F.max("held").alias("most"))  # at most a row for each id of A
    return materialize(held.join(broadcast_if_small(most), "a").select("pair", "held", (F.col("held") == F.col("most")).alias("best")), "pairs")


def alignment(docs: DataFrame, model_a: str | None = None, model_b: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of tokens, groups and links, what its links count in the corpus, and its digest."""
    width = sentencepiece.SentencePieceProcessor(model_file=model_b or public_tokenizers.path(MODEL_B)).get_piece_size()
    rows = materialize(aligned(docs, model_a, model_b, id, text), "aligned")
    counts = broadcast_if_small(pair_counts(rows, width))
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.*").withColumnRenamed("pairs", "pair")
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("held")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))
