"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-case words joined by one space.  An item of ``m``
characters may occur with up to ``k = m // CHARS_PER_EDIT`` edits.  It is split into
``k + 1`` pieces; an occurrence within the budget leaves one piece untouched, so an
automaton over all pieces finds every candidate place, and Myers' bit-parallel distance
verifies it.  Nothing within the budget can be missed.

The items go to the tasks in blocks of a bounded number of characters, one pass over
the documents per block, so the broadcast stays bounded whatever the benchmark's size.

Every item with a word is searched.  One too short for an edit has to stand at word ends;
scripts written without spaces have none, so there it may stand anywhere.

Defined results: null, empty and wordless documents match nothing, and so do such items; repeated rows are
judged alike; items with the same text are all reported; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.common import column, keep_rows, slices, table

CHARS_PER_EDIT = 16
# Scripts without spaces between words: Thai to Myanmar, Khmer, kana and ideographs.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
BLOCK_CHARS = 4_000_000

Item = tuple[int, str]
Match = tuple[int, int, int]  # distance, start and end in the normalised text

HIT_SCHEMA = "doc_id bigint, item_id bigint, distance int, start bigint, end bigint"


def normal(text: str | None) -> str:
    """Lower-case words joined by one space."""
    return " ".join(re.findall(r"\w+", (text or "").lower()))


def budget(item: str) -> int:
    return len(item) // CHARS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """``(offset, piece)`` for budget-plus-one pieces of nearly equal length."""
    parts = budget(item) + 1
    cuts = [len(item) * part // parts for part in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def piece_automaton(items: list[Item]) -> ahocorasick.Automaton | None:
    """Finds the pieces of all (normalised) items; the value of a piece lists ``(item place, offset)``."""
    owners: dict[str, list[tuple[int, int]]] = {}
    for place, (_, text) in enumerate(items):
        for offset, piece in pieces(text):
            owners.setdefault(piece, []).append((place, offset))
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for piece, places in owners.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return automaton


def pattern_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for place, char in enumerate(item):
        masks[char] = masks.get(char, 0) | 1 << place
    return masks


def myers(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to any substring of ``text``, and the first end where it occurs."""
    everything, top = (1 << length) - 1, 1 << length - 1
    plus, minus, score = everything, 0, length
    best, end = length, 0
    for place, char in enumerate(text, 1):
        match = masks.get(char, 0)
        x = match | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & everything
        up, down = minus | (everything & ~(d0 | plus)), plus & d0
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & everything
        plus = (down << 1 & everything) | (everything & ~(d0 | up))
        minus = up & d0
        if score < best:
            best, end = score, place
    return best, end


def best_match(item: str, masks: dict[str, int], text: str, starts: list[int]) -> Match | None:
    """The closest occurrence around the supposed ``starts`` of the item; the leftmost of equals."""
    size, allowed = len(item), budget(item)
    for start in sorted(set(starts)):
        if start >= 0 and text.startswith(item, start):
            return 0, start, start + size
    windows: list[list[int]] = []
    for start in sorted(set(starts)):
        low, high = max(0, start - allowed), min(len(text), start + size + allowed)
        if windows and low <= windows[-1][1]:
            windows[-1][1] = max(windows[-1][1], high)
        else:
            windows.append([low, high])
    best: Match | None = None
    for low, high in windows:
        distance, end = myers(masks, size, text[low:high])
        if distance <= allowed and (best is None or distance < best[0]):
            # The start: the same search backwards from the end.
            back, length = myers(pattern_masks(item[::-1]), size, text[max(low, low + end - size - allowed) : low + end][::-1])
            best = distance, low + end - length, low + end
    return best


def at_word_ends(text: str, start: int, end: int) -> bool:
    """Whether no word of a spaced script goes on over the start or end of the span."""
    edges = [text[place - 1 : place + 1] for place in (start, end) if 0 < place < len(text)]
    return all(" " in edge or _UNSPACED.search(edge) for edge in edges)


class Matcher:
    """All occurrences of a block of items in one text."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.automaton = piece_automaton(items)
        self.masks: dict[int, dict[str, int]] = {}

    def matches(self, text: str) -> Iterator[tuple[int, Match]]:
        """``(item place, match)`` for each item that occurs in the normalised text."""
        if self.automaton is None or not text:
            return
        places: dict[int, list[int]] = {}
        for last, (length, owners) in self.automaton.iter(text):
            for item, offset in owners:
                places.setdefault(item, []).append(last + 1 - length - offset)
        for item in sorted(places):
            wanted = self.items[item][1]
            starts = places[item]
            if not budget(wanted):  # its only piece is the item itself
                starts = [start for start in starts if at_word_ends(text, start, start + len(wanted))]
            masks = self.masks.setdefault(item, pattern_masks(wanted))
            found = best_match(wanted, masks, text, starts)
            if found:
                yield item, found


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Code-point span in ``text`` of a span of its normalised form."""
    lowered = text.lower()
    at, first, last = 0, None, 0
    for word in re.finditer(r"\w+", lowered):
        if first is None and at + len(word.group()) > start:
            first = word.start() + max(0, start - at)
        if at < end:
            last = word.start() + min(len(word.group()), end - at)
        at += len(word.group()) + 1
    first = first or 0
    if len(lowered) == len(text) or not last:
        return first, last
    # Some letters are longer in lower case: each place there belongs to the letter it came from.
    place = [i for i, letter in enumerate(text) for _ in letter.lower()]
    return place[first], place[last - 1] + 1


def item_blocks(benchmark: DataFrame, id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[Item]]:
    """The usable items, normalised, in blocks of about ``block_chars`` characters."""
    items = benchmark.select(column(id).cast("bigint").alias("i"), column(text).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-size // block_chars)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == block).collect()
        ready = [(row["i"], normal(row["t"])) for row in own]
        ready = sorted((item for item in ready if item[1]), key=lambda item: (item[0] is None, item[0], item[1]))
        if ready:
            yield ready


def find_items(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document row and item that occurs in it: its closest occurrence, as a span of the original text."""
    spark = docs.sparkSession
    source = docs.select(column(id).cast("bigint").alias("doc_id"), column(text).alias("text"))
    found = None
    for items in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for batch in slices(batches, 1):
                rows = []
                for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for item, (distance, start, end) in matcher.matches(normal(value)):
                        rows.append((doc, matcher.items[item][0], distance, *original_span(value, start, end)))
                made = list(zip(*rows)) or [[]] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(made, types)],
                    ["doc_id", "item_id", "distance", "start", "end"],
                )

        hits = source.mapInArrow(run, HIT_SCHEMA)
        found = hits if found is None else found.union(hits)
    return docs.sparkSession.createDataFrame([], HIT_SCHEMA) if found is None else found


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item occurs."""
    for items in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def clean(texts: list, sent=sent) -> list[bool]:
            matcher = Matcher(sent.value)
            return [next(matcher.matches(normal(value)), None) is None for value in texts]

        docs = keep_rows(docs, text, clean)
    return docs


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
