import os
import zlib
from glob import glob

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import token_files as T
from brindle.plans.workspace import shared_dir

MODEL = public_tokenizers.path(T.MODEL)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(MODEL)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_whole_table(spark, sf_dir, tokenizer):
    rows = {r["doc_id"]: r for r in T.op2_token_files(spark, sf_dir).collect()}
    before = 0
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert len(rows) == len(given)
    for r in given:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        got = rows[r["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (before, len(ids), crc(ids))
        before += len(ids)


@pytest.mark.parametrize("by_word", [True, False])
def test_words_and_whole_texts_agree(tokenizer, by_word):
    texts = [
        "", "  ", "It's THAN. É.é İx ÀÁ. don't... ×.a ÷ ,", "a\x1cb c", "e\u0301. ẞ ß.", "日本語 テスト。", "<|endoftext|> x<|startoftext|>y", "\u00a0nb\u2003sp ǅ.",
        "123. 1.2,3 a1.", "a!?b .,; (x)-[y] _z_ <b> <|x", "Ünïcödé ß ÿ. ¿qué? «a»", "x\u0085y", "Σίσυφος. ΟΔΟΣ. ς", "s t're. 'S", "ſ. ŉ. İ. ı", "a" * 5000, "than than. Than, THAN!",
    ]
    with open(MODEL, encoding="utf-8") as file:
        encoder = T.Encoder(file.read(), by_word)
    assert [ids.tolist() for ids in encoder.encode_all(texts)] == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_words_forgotten_come_back(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "_REMEMBERED", 5)
    with open(MODEL, encoding="utf-8") as file:
        encoder = T.Encoder(file.read())
    for i in range(40):
        text = f"word{i % 7} and Other{i}, again. the end"
        assert encoder.encode_all([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_edge_cases(spark, docs, tokenizer):
    rows = [(5, "b words"), (5, "a words"), (None, "no id"), (2, None), (3, ""), (4, "word " * 60_000), (5, "b words"), (-1, "x")]
    path = shared_dir(spark, "tokens")
    T.write_token_files(docs(rows).withColumn("ids", F.lit(0)).withColumn("shard", F.lit("x")), path, shards=4)
    got = sorted(T.checksums(T.read_token_files(spark, path)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, -1, 2, 3, 4, 5, 5, 5]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == 1 and got[2]["ids_crc32"] == crc([1]) and got[4]["n_tokens"] == 60_001
    empty = shared_dir(spark, "tokens")
    T.write_token_files(docs([]), empty)
    assert T.checksums(T.read_token_files(spark, empty)).count() == 0


def test_files_can_be_skipped(spark, sf_dir):
    path = shared_dir(spark, "tokens")
    T.write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, shards=4)
    found = T.lookup(spark, path, [17, 23])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(doc_id" in plan
    assert sorted(r["doc_id"] for r in found.collect()) == [17, 23]
    ranges = []
    for name in sorted(glob(f"{path.removeprefix('file:')}/*.orc")):
        ids = orc.ORCFile(name).read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        ranges.append((ids[0], ids[-1]))
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) > 1


def test_bloom_filters_are_written(spark, docs, monkeypatch):
    frame = docs([(i * 7919, "x") for i in range(4_000)])

    def size():
        path = shared_dir(spark, "tokens")
        T.write_token_files(frame, path, shards=1)
        return sum(os.path.getsize(name) for name in glob(f"{path.removeprefix('file:')}/*.orc"))

    with_filters = size()
    monkeypatch.setattr(T, "ORC_OPTIONS", {name: value for name, value in T.ORC_OPTIONS.items() if "bloom" not in name})
    # About ten bits for each id at one false hit in a hundred.
    assert with_filters - size() > 4_000
