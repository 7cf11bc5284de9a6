"""Personal data: patterns, and a conditional random field over word shapes.

The patterns find e-mail addresses, IP addresses, card and phone numbers in their usual
form.  The field (``crf``) is trained on a small labelled table made here by rule, and
adds spans in other forms: spelt-out addresses, numbers with other separators.  A span of
the field that overlaps one of the patterns is not added, and the digits or marks of its
kind are checked.

Each kind has a digit, an ``@`` or a spelt-out dot (in four languages); a line without any
of them can hold no such span, and only the other lines are decoded.  Decoding takes whole lines.

Defined results: a null or empty text has no spans; spans are in code points, end
exclusive; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from brindle.llm.common import column, slices, table
from brindle.llm.crf import Decoder, Model, train

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{mark}-{kind}" for kind in KINDS for mark in "BI")]
SENTENCES = 900

Span = tuple[str, int, int]  # kind, start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# How the marks of an address are spelt out, in English, Spanish, German and French.
_AT = "at arroba ät klammeraffe arobase arrobase".split()
_DOT = "dot punto punkt point".split()
_GATE = re.compile(r"[0-9@]|\b(?:" + "|".join(_DOT) + r")\b", re.I)
_SPELT = re.compile(
    r"[\w.+%-]+[\s(\[]*(?:@|\b(?:" + "|".join(_AT) + r")\b)[\s)\]]*[\w-]+(?:[\s(\[]*(?:\.|\b(?:" + "|".join(_DOT) + r")\b)[\s)\]]*[\w-]+)+", re.I
)
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_CUES = frozenset([*_AT, *_DOT, *"phone tel call fax mobile cell ip address host server card visa amex credit mail email version v date id order page room".split()])


def digits_of(text: str) -> str:
    return "".join(re.findall("[0-9]", text))


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 - 9 * (int(d) > 4) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses; found from each ``@`` outwards, so a long word is read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns: by kind, then start."""
    found = [("email", *span) for span in emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if is_ip(m.group().split("."))]
    for match in _CARD.finditer(text):
        digits = digits_of(match.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found


def token_class(token: str, glued: bool) -> str:
    """The shape of a token, whether it touches the one before, and the word itself if it is a cue."""
    joint = "+" if glued else "-"
    if token.isdecimal():
        size = min(len(token), 20)
        return f"digits{size}:{joint}:{'byte' if size <= 3 and int(token) <= 255 else ''}"
    if token.isalpha():
        lower = token.lower()
        if lower in _CUES:  # the marks of an address are one cue each, in whatever language
            return f"cue:{'at' if lower in _AT else 'dot' if lower in _DOT else lower}:{joint}"
        case = "lower" if token == lower else "title" if token[1:] == lower[1:] else "upper" if token == token.upper() else "mixed"
        return f"word{joint}:{case}:{min(len(token), 6)}"
    return f"mark{token if token.isascii() else ''}:{joint}"


def tokens_of(line: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Classes and places of the tokens of a line."""
    classes, places, before = [], [], -1
    for match in _TOKEN.finditer(line):
        classes.append(token_class(match.group(), match.start() == before))
        before = match.end()
        places.append(match.span())
    return classes, places


def labels_of(places: list[tuple[int, int]], spans: list[Span]) -> list[str]:
    """The label of each token under marked spans."""
    labels = ["O"] * len(places)
    for kind, low, high in spans:
        inside = [i for i, (a, b) in enumerate(places) if a < high and b > low]
        for i in inside:
            labels[i] = f"I-{kind}"
        if inside:
            labels[inside[0]] = f"B-{kind}"
    return labels


def _card_number(pick: random.Random, size: int) -> str:
    body = "".join(pick.choice("0123456789") for _ in range(size - 1))
    return next(body + last for last in "0123456789" if luhn(body + last))


def labelled_table(sentences: int = SENTENCES, seed: int = 1) -> list[tuple[str, list[Span]]]:
    """Sentences with marked spans, made by rule: the kinds in many forms, among words and numbers that are none."""
    pick = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve el ma ra li".split()

    def word() -> str:
        made = "".join(pick.choice(syllables) for _ in range(pick.randint(1, 4)))
        return made.title() if pick.random() < 0.1 else made

    def number(size: int) -> str:
        return "".join(pick.choice("0123456789") for _ in range(size))

    # The same address spelt out in other languages.
    pairs = [("arroba", "punto"), ("at", "punkt"), ("ät", "punkt"), ("klammeraffe", "punkt"), ("arobase", "point"), ("arrobase", "point")]
    spelt = [(f" {a} ", f" {b} ") for a, b in pairs] + [(f" ({a}) ", f" ({b}) ") for a, b in pairs] + [(f"({a})", f"({b})") for a, b in pairs[::2]]

    def email() -> str:
        at, dot = pick.choice([("@", "."), (" at ", " dot "), (" AT ", " DOT "), (" (at) ", " (dot) "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" @ ", "."), (" [at] ", " [dot] "), *spelt, *spelt[: len(pairs)]])
        plain = at.strip(" ()[]").isalpha()  # spelt out: mostly a word at a word
        user = word() if plain and pick.random() < 0.6 else pick.choice([word(), word() + "." + word(), word() + "." + number(2), word() + number(2)])
        host = word() if plain and pick.random() < 0.7 else pick.choice([word(), "mail" + number(1) + "." + word(), "mail"])
        top = pick.choice("com org net edu de fr es".split())
        return user + at + host + dot + top

    def ip() -> str:
        return pick.choice([".", ".", " . ", "[.]", " dot ", "(.)"]).join(str(pick.randint(0, 255)) for _ in range(4))

    def card() -> str:
        if pick.random() < 0.3:
            digits, joint = _card_number(pick, 15), pick.choice(["", " ", "-"])
            return joint.join([digits[:4], digits[4:10], digits[10:]])
        digits = _card_number(pick, 16)
        return pick.choice([" ", "-", ".", "", " - ", "/"]).join(digits[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return pick.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00 44 {number(2)} {c} {number(4)}", f"+49/{b}/{number(6)}", f"1-{a}-{b}-{c}", f"+{number(2)} {a} {b} {c}"])

    def other() -> str:
        hexes = "".join(pick.choice("0123456789abcdef") for _ in range(pick.choice([16, 32, 40])))
        return pick.choice([
            f"20{number(2)}-0{number(1)}-1{number(1)}", f"1{number(1)}/0{number(1)}/20{number(2)}", f"{pick.randint(1, 9)}.{pick.randint(0, 20)}.{pick.randint(0, 9)}",
            f"{number(1)},{number(3)}.{number(2)}", f"1{number(1)}:{number(2)}", f"password={hexes}", f'token = "{hexes}"', f"id {number(5)}", f"pages {number(2)}-{number(2)}",
            f"at {word()}", f"order {number(6)}", f"v{number(1)}.{number(1)}", f"{word()} at {word()}.", f"{word()} point {word()}", f"punto {word()}", f"der punkt {word()}", f"{number(2)} punto {number(2)}", f"{number(4)}", f"{word()}@", f"the dot {word()}", f"({number(4)})", f"{number(12)}", f"{number(3)} {word()} {number(4)}", f"{number(1)}.{number(1)}.{number(1)}.{number(1)}.{number(1)}.{number(1)}",
        ])

    made = {"email": email, "ip": ip, "card": card, "phone": phone}
    rows = []
    for _ in range(sentences):
        text, spans = "", []
        for _ in range(pick.randint(1, 3)):
            text += " ".join(word() for _ in range(pick.randint(1, 5))) + pick.choice([" ", " ", ", ", ": ", ". "])
            kind = pick.choice([*KINDS, "other", "other"])
            if kind == "other":
                text += other()
            else:
                start = len(text)
                text += made[kind]()
                spans.append((kind, start, len(text)))
            text += pick.choice([" ", " ", ". ", ", ", " | "])
        rows.append((text + word() + pick.choice([".", ""]), spans))
    return rows


def trained(rows: list[tuple[str, list[Span]]] | None = None) -> Model:
    """The field, trained on a labelled table."""
    sequences = []
    for text, spans in labelled_table() if rows is None else rows:
        classes, places = tokens_of(text)
        sequences.append((classes, labels_of(places, spans)))
    return train(sequences, LABELS)


def holds(kind: str, text: str) -> bool:
    """Whether a span of the field has what its kind needs."""
    digits = digits_of(text)
    if kind == "email":
        return bool(_SPELT.fullmatch(text))
    if kind == "ip":
        return is_ip(re.findall("[0-9]+", text))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def spans_in(labels: list[str], places: list[tuple[int, int]]) -> list[Span]:
    """The marked spans of a labelled line."""
    spans: list[Span] = []
    for label, (low, high) in zip(labels, places):
        if label[0] == "B":
            spans.append((label[2:], low, high))
        elif label[0] == "I":
            spans[-1] = (spans[-1][0], spans[-1][1], high)
    return spans


def lines_to_read(text: str) -> list[tuple[int, int]]:
    """Start and end of the lines that may hold personal data."""
    lines, at = [], 0
    while match := _GATE.search(text, at):
        low = text.rfind("\n", 0, match.start()) + 1
        high = text.find("\n", match.end())
        high = len(text) if high < 0 else high
        lines.append((low, high))
        at = high
    return lines


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))
    return ",".join(f"{kind}:{low}:{high}" for kind, low, high in ordered)


def find_all(texts: list[str], decoder: Decoder) -> list[tuple[list[Span], list[Span]]]:
    """The spans of the patterns and those the field adds, for each text."""
    base = [base_spans(text) for text in texts]
    lines = [(place, low, high) for place, text in enumerate(texts) for low, high in lines_to_read(text)]
    parsed = [tokens_of(texts[place][low:high]) for place, low, high in lines]
    added: list[list[Span]] = [[] for _ in texts]
    for (place, start, _), (_, places), labels in zip(lines, parsed, decoder.decode([classes for classes, _ in parsed])):
        for kind, low, high in spans_in(labels, places):
            low, high = low + start, high + start
            if holds(kind, texts[place][low:high]) and all(high <= a or low >= b for _, a, b in base[place]):
                added[place].append((kind, low, high))
    return list(zip(base, added))


RESULT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
)


def find_personal_data(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the patterns' spans by kind, their digest, all spans, and how many the field added."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in slices(batches, 1):
            texts = [value or "" for value in batch.column(1).to_pylist()]
            found = find_all(texts, decoder)
            counts = np.array([[sum(span[0] == kind for span in base) for kind in KINDS] for base, _ in found], np.int64).reshape(-1, len(KINDS))
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            spans = [joined(base + added) for base, added in found]
            extra = [len(added) for _, added in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, i]) for i in range(len(KINDS))), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extra, pa.int64())],
                [field.split(" ")[0] for field in RESULT.split(", ")],
            )

    return docs.select(column(id).cast("bigint").alias("doc_id"), column(text).alias("text")).mapInArrow(run, RESULT)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"), trained())
