import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brindle.llm import token_alignment as T

ODD = [
    None, "", " ", "héllo 世界 <|endoftext|> </s> <s>\n\n  x", "▁a", "a▁", "a b \t\t\r\n", "😀😀 " * 3, " leading  and trailing ", "a" * 700,
    "plain words of a text.", "plain words of a text.", " x y", "123456789 12.5%", "<0x41>", "x\0y", "don't we'll", "ß" * 300,
    "the word " * 3000,
]


@pytest.fixture(scope="module")
def tokens():
    with open(public_tokenizers.path(T.MODEL_A), encoding="utf-8") as a, open(public_tokenizers.path(T.MODEL_B), "rb") as b:
        return T.Tokens(a.read(), b.read())


def plain_groups(tokens, text):
    """The groups of a text, token by token."""
    (a,), (b,) = tokens.encode([text or ""])
    ends_a, ends_b = (np.cumsum([len(side[i]) for i in ids], dtype=int).tolist() for side, ids in ((tokens.bytes_a, a), (tokens.bytes_b, b)))
    found, at_a, at_b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
        found.append((a[at_a:to_a], b[at_b:to_b]))
        at_a, at_b = to_a, to_b
    return found


def brute(tokens, rows):
    parts = [plain_groups(tokens, text) for _, text in rows]
    links = [[(x, y) for a, b in own for x in a for y in b] for own in parts]
    held = Counter(pair for own in links for pair in set(own))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    made = []
    for (doc, _), own, pairs in zip(rows, parts, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        made.append(
            (doc, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(pairs), sum(held[p] == most[p[0]] for p in pairs),
             sum(held[p] for p in pairs), hashlib.sha256(shown.encode()).hexdigest() if own else "")
        )
    return sorted(made, key=repr)


def result(frame):
    found = T.alignment(frame)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_tokens_spell_the_text(tokens):
    for text in filter(None, ODD):
        (a,), (b,) = tokens.encode([text])
        if a:
            assert b"".join(tokens.bytes_a[i] for i in a) == b"".join(tokens.bytes_b[i] for i in b) == (" " + text).encode()
    assert tokens.encode(["▁a"]) == ([[]], [[]])  # a piece's mark in a text comes back as a blank


def test_special_strings_are_plain_text(tokens):
    (a,), (b,) = tokens.encode(["x <|endoftext|> </s>"])
    assert a and 50256 not in a and not {0, 1, 2} & set(b)


def test_odd_rows(spark, docs, tokens):
    rows = [*enumerate(ODD), (None, "no id"), (None, "no id"), (3, "same id"), (10, "plain words of a text.")]
    frame = docs(rows).withColumn("row", F.lit("x")).withColumn("pairs", F.lit(1))
    assert result(frame) == brute(tokens, rows)


def test_whole_table(spark, sf_dir, tokens):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert sorted(map(tuple, T.op13_alignment(spark, sf_dir).collect()), key=repr) == brute(tokens, rows)


def test_empty(spark, docs):
    assert result(docs([])) == []


def test_counts_by_a_join(spark, docs, tokens, monkeypatch):
    monkeypatch.setattr(T, "broadcast_if_small", lambda df: df)
    rows = [(i, f"row {i} of words " * (i + 1)) for i in range(40)]
    assert result(docs(rows)) == brute(tokens, rows)


@pytest.mark.parametrize("entry", [2, 3, 50])
def test_entries_part_at_cuts_only(tokens, entry, monkeypatch):
    texts = [text or "" for text in ODD] + ["aaaa bbbb " * 40 + "世" * 50]
    a, b = (T.Side.of(ids, sizes) for ids, sizes in zip(tokens.encode(texts), (tokens.sizes_a, tokens.sizes_b)))
    whole = T.groups(a, b)
    monkeypatch.setattr(T, "ENTRY", entry)
    monkeypatch.setattr(T, "_PROBE", 2)
    assert (T.groups(a, b) == whole).all() and len(T.entries(a, b)[0]) > len(texts)


def test_wide_groups_fold(tokens, monkeypatch):
    a, b = (T.Side.of(ids, sizes) for ids, sizes in zip(tokens.encode(["a" * 700, "x " * 30, "世界" * 20]), (tokens.sizes_a, tokens.sizes_b)))
    found = T.groups(a, b)
    plain = T.linked(found, a, b, 50257, 32000)
    monkeypatch.setattr(T, "_WIDE", 0)
    assert all((one == other).all() for one, other in zip(T.linked(found, a, b, 50257, 32000), plain))
