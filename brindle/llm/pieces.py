"""SentencePiece-style encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary and its ranks come from a SentencePiece model file, whose path is a
parameter.  A piece's log score follows from its rank by a Zipf-Mandelbrot law.  The
trie holds the UTF-8 bytes of the pieces, a space in place of the white-space marker.

Text is encoded with one leading space, as SentencePiece does, and is otherwise not
normalised.  No piece has a space behind another character, so the best segmentation
is the concatenation of the best segmentations of its words (each with the spaces before
it); with a vocabulary where that does not hold, the whole text is one word.  Distinct
words of a batch are segmented together in numpy, position by position, and remembered.

A character no piece covers falls back to the byte pieces ``<0x..>``, as does the
white-space marker U+2581 itself, so ``decode(encode(text)) == text`` for every text.
Among segmentations of equal score the one whose last piece is longest wins.

Defined results: a null text has null ids; an empty text has no ids; repeated rows are
encoded alike; other columns are ignored by the query and pass through the stage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import Words, column, slices, table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
RANK_SHIFT = 2.7
FALLBACK_PENALTY = 10.0
_REMEMBERED = 400_000  # words a Python worker keeps; beyond it the memory starts anew
_WORD = re.compile(r" *[^ ]+| +$")


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log-probabilities that fall with the rank."""
    weight = 1.0 / (ranks + RANK_SHIFT)
    return np.log(weight / weight.sum())


def double_array(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value`` of a double-array trie; the value of a state is the place of the word that ends there, or -1.

    From state ``s``, byte ``c`` leads to ``base[s] + c`` if ``check`` there is ``s``.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    size = 1 << 12
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    free_from = crowded_to = 1  # no slot below the first is free; below the second few are
    pending = [(0, 0, len(order), 0)]  # state, first and last word, depth
    while pending:
        state, low, high, depth = pending.pop()
        if len(words[order[low]]) == depth:
            value[state] = order[low]
            low += 1
        children, at = [], low
        while at < high:
            byte, start = words[order[at]][depth], at
            while at < high and words[order[at]][depth] == byte:
                at += 1
            children.append((byte, start, at))
        if not children:
            base[state] = -(1 << 20)  # a leaf: no byte leads anywhere
            continue
        codes = np.array([byte for byte, _, _ in children])
        window = 64 if codes.size == 1 else 4096
        seek = free_from if codes.size == 1 else crowded_to
        while True:
            if seek + window + 512 >= size:
                base = np.concatenate([base, np.zeros(size, np.int32)])
                check = np.concatenate([check, np.full(size, -1, np.int32)])
                value = np.concatenate([value, np.full(size, -1, np.int32)])
                size *= 2
            offsets = np.flatnonzero(check[seek : seek + window] < 0) + seek - codes[0]
            offsets = offsets[offsets > 0]
            fits = (check[offsets[:, None] + codes] < 0).all(axis=1)
            if fits.any():
                offset = int(offsets[fits.argmax()])
                break
            seek += window
        if codes.size == 1:
            free_from = offset + int(codes[0])
        else:
            crowded_to = max(crowded_to, seek)
        base[state] = offset
        check[offset + codes] = state
        pending += [(offset + byte, start, end, depth + 1) for byte, start, end in children]
    return base, check, value


def load(path: str) -> dict:
    """The vocabulary of a SentencePiece file as plain arrays, ready to broadcast."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    names = [model.id_to_piece(place) for place in range(count)]
    usable = [i for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    ranks = np.array([-model.get_score(i) for i in usable], dtype=np.float64)
    words = [names[i].replace(MARK, " ").encode() for i in usable]
    base, check, value = double_array(words)
    byte_ids = np.zeros(256, np.int32)
    for i in range(count):
        if model.is_byte(i):
            byte_ids[int(names[i][3:-1], 16)] = i
    spelt = [b""] * count
    for place, word in zip(usable, words):
        spelt[place] = word
    for byte, place in enumerate(byte_ids.tolist()):
        spelt[place] = bytes([byte])
    return {
        "base": base, "check": check, "value": value, "ids": np.array(usable, np.int32), "scores": zipf_scores(ranks),
        "bytes": byte_ids, "spelt": np.frombuffer(b"".join(spelt), np.uint8), "spelt_at": np.cumsum([0, *map(len, spelt)]), "longest": max(map(len, words)), "splits": not any(b" " in word.lstrip(b" ") for word in words),
    }


def segment(vocabulary: dict, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The best piece ids of the words (UTF-8, spaces for markers), one after the other, and where each word's end.

    Viterbi over all words at once.
    """
    base, check, value = vocabulary["base"], vocabulary["check"], vocabulary["value"]
    scores, ids, byte_ids = vocabulary["scores"], vocabulary["ids"], vocabulary["bytes"]
    lengths = np.array([len(word) for word in words])
    longest, count = int(lengths.max()), len(words)
    spread = np.zeros((count, longest), np.uint8)
    spread[np.arange(longest) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    codes = np.ascontiguousarray(spread.T)  # by position, then word, as all that follows
    leads = (codes & 0xC0) != 0x80
    penalty = scores.min() - FALLBACK_PENALTY
    best = np.full((longest + 1, count), -np.inf)
    best[0] = 0.0
    back = np.zeros((longest + 1, count), np.int32)  # where the last piece begins
    last = np.full((longest + 1, count), -1, np.int32)  # which piece it is; -1: bytes
    for start in range(longest):
        rows = np.flatnonzero((start < lengths) & leads[start])
        if rows.size == 0:
            continue
        # The fallback edge: the whole character, byte by byte.
        first = codes[start].take(rows)
        span = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        so_far = best[start].take(rows)
        worth = so_far + penalty
        better = worth > best[start + span, rows]
        at, own = start + span[better], rows[better]
        best[at, own] = worth[better]
        back[at, own] = start
        last[at, own] = -1
        states, left = np.zeros(rows.size, np.int32), lengths.take(rows)
        for end in range(start, min(longest, start + vocabulary["longest"])):
            ahead = base.take(states) + codes[end].take(rows)
            alive = np.flatnonzero((check.take(ahead, mode="clip") == states) & (end < left))
            if alive.size == 0:
                break
            rows, states, so_far, left = rows.take(alive), ahead.take(alive), so_far.take(alive), left.take(alive)
            found = value.take(states)
            whole = np.flatnonzero(found >= 0)
            own, piece = rows.take(whole), found.take(whole)
            worth = so_far.take(whole) + scores.take(piece)
            better = np.flatnonzero(worth > best[end + 1].take(own))
            own = own.take(better)
            best[end + 1][own] = worth.take(better)
            back[end + 1][own] = start
            last[end + 1][own] = piece.take(better)
    # Walk all words back together; a step writes the ids of one piece of each.
    rows, at = np.arange(count), lengths.copy()
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while rows.size:
        piece, start = last[at, rows], back[at, rows]
        steps.append((rows[piece >= 0], ids.take(piece[piece >= 0])))
        for row, low, high in zip(*(x[piece < 0].tolist() for x in (rows, start, at))):
            for byte in words[row][low:high][::-1]:
                steps.append((np.array([row]), byte_ids[byte : byte + 1]))
        rows, at = rows[start > 0], start[start > 0]
    owners, made = (np.concatenate(parts) for parts in zip(*steps))
    order = np.argsort(owners[::-1], kind="stable")
    return made[::-1][order], np.cumsum(np.bincount(owners, minlength=count))


class Coder:
    """Encodes and decodes texts with a loaded vocabulary, remembering the words it has seen."""

    def __init__(self, vocabulary: dict):
        self.vocabulary = vocabulary
        # A broadcast value lives as long as its Python worker, so tasks share the memory of words.
        self.memory: dict[str, Words] = vocabulary.setdefault("memory", {"words": Words()})
        self.marker = vocabulary["bytes"][np.frombuffer(MARK.encode(), np.uint8)]

    def words(self, text: str) -> list[str]:
        return _WORD.findall(" " + text) if self.vocabulary["splits"] else [" " + text]

    def learn(self, known: Words) -> None:
        """Segment the new words, those of similar length together."""
        new = [word.encode() for word in known.take_new()]
        by_size: dict[int, list[int]] = {}
        for place, word in enumerate(new):
            by_size.setdefault(len(word).bit_length(), []).append(place)
        order, parts, sizes = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for bits, own in by_size.items():
            step = max(1, (1 << 17) >> bits)
            for start in range(0, len(own), step):
                ids, ends = segment(self.vocabulary, [new[place] for place in own[start : start + step]])
                parts.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            order += own
        # Back into the order in which the words were met.
        size = np.concatenate(sizes)
        first = np.cumsum(size) - size
        back = np.argsort(np.array(order, np.int64))
        size, first = size[back], first[back]
        ends = np.cumsum(size)
        known.add(np.concatenate(parts)[np.repeat(first - ends + size, size) + np.arange(size.sum())], ends)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.memory["words"].places) > _REMEMBERED:
            self.memory["words"] = Words()
        known = self.memory["words"]
        # The marker itself is no piece of a text: it stands between words, in bytes.
        cut = [[self.words(text)] if MARK not in text else self._around_markers(text) for text in texts]
        places = [[known.places_of(run) for run in runs] for runs in cut]
        self.learn(known)
        out = []
        for text, runs in zip(texts, places):
            parts = [known.ids_at(runs[0])]
            for run in runs[1:]:
                parts += [self.marker, known.ids_at(run)]
            out.append(np.concatenate(parts) if text else np.zeros(0, np.int32))
        return out

    def _around_markers(self, text: str) -> list[list[str]]:
        first, *others = text.split(MARK)
        return [self.words(first), *(_WORD.findall(part) for part in others)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of the ids: markers become spaces, byte pieces become characters, the leading space goes."""
        ids = np.asarray(ids, np.int64)
        starts = self.vocabulary["spelt_at"][ids]
        sizes = self.vocabulary["spelt_at"][ids + 1] - starts
        ends = np.cumsum(sizes)
        places = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if ends.size else 0)
        return self.vocabulary["spelt"][places].tobytes().decode("utf-8", "replace").removeprefix(" ")


def vocabulary_for(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The vocabulary in all tasks; its size is that of the model file."""
    return spark.sparkContext.broadcast(load(path or public_tokenizers.path(MODEL)))


def with_pieces(docs: DataFrame, vocabulary: Broadcast, text: str = "text", names: tuple[str, str] = ("piece_ids", "decoded")) -> DataFrame:
    """``docs`` with the piece ids of the text, and the text decoded from them."""
    place = docs.columns.index(text)
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(names[0]), F.lit(None).cast("string").alias(names[1])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary.value)
        for batch in slices(batches, place):
            texts = batch.column(place).to_pylist()
            coded = iter(coder.encode_all([text for text in texts if text is not None]))
            ids = [None if text is None else next(coded) for text in texts]
            back = [None if own is None else coder.decode(own) for own in ids]
            flat = np.concatenate([np.zeros(0, np.int32), *(own for own in ids if own is not None)])
            ends = np.cumsum([0, *(0 if own is None else own.size for own in ids)])
            # A null in the offsets makes a null list.
            offsets = pa.array(ends.astype(np.int32), mask=np.array([own is None for own in ids] + [False]))
            made = [pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, vocabulary: Broadcast, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece_ids, n_pieces, round_trip``: the ids of every text and whether they decode to it."""
    source = docs.select(column(id).alias("doc_id"), column(text).alias("text"))
    coded = with_pieces(source, vocabulary)
    return coded.select(
        "doc_id", "piece_ids",
        F.when(F.col("piece_ids").isNull(), 0).otherwise(F.size("piece_ids")).cast("bigint").alias("n_pieces"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(table(spark, sf_dir, "documents"), vocabulary_for(spark))
