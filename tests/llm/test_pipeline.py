import inspect
import re

import corpus_pipeline
import pytest
from brindle.llm import decontaminate, language, line_dedup, simhash
from pyspark.sql import functions as F
from tests_llm_brute import brute_lines


def brute(spark, rows, items):
    """The stages on ``(doc_id, text, lang, source)`` rows, plainly."""
    schema = "doc_id bigint, text string, lang string, source string"
    model = language.fit(spark.createDataFrame(rows, schema))
    judge = language.scorer(model.languages, model.bits, model.weights)
    rows = [row for row in rows if judge([row[1]])[0][1] >= language.MIN_SCORE]
    rows = brute_lines(rows, line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    prints = {row[0]: simhash.fingerprint(row[1].encode()) & (1 << 64) - 1 for row in rows}
    best = {doc: doc for doc in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if best[a] < best[b] and (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS:
                    best[b], changed = best[a], True
    rows = [row for row in rows if best[row[0]] == row[0]]
    wanted = [decontaminate.normal(item) for item in items]
    return sorted(row for row in rows if not any(item in decontaminate.normal(row[1]) for item in wanted))


def test_against_the_plain_version(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(spark, [tuple(r) for r in table.collect()], items)
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids", "decoded"]
    assert sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in got.collect()) == want
    assert got.where("decoded <> text or n_chars <> length(text)").count() == 0


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontaminate", "pieces"]
    assert all(list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"] for _, stage in corpus_pipeline.STAGES)


@pytest.mark.parametrize("empty", [True, False])
def test_odd_documents(spark, docs, written, empty):
    item = "The quick brown fox jumps over the lazy dog and runs away"
    rows = [] if empty else [
        (1, "the cat sat on the mat with another cat"), (2, None), (3, ""), (4, "12345"), (5, "the cat sat on the mat with another cat"),
        (None, "a text without an id but with words"), (7, item), (8, "the dog " * 60_000), (9, "le chat " * 30, "fr", None), (9, "le chat " * 30, "fr", None),
        *((100 + i, f"the line number {i} of the english texts has words", "en") for i in range(60)),
    ]
    frame = docs(rows).withColumn("fingerprint", F.lit("x")).withColumn("piece_ids", F.lit(0))
    sf = written(documents=frame, benchmark=spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string"))
    got = corpus_pipeline.run(spark, sf)
    assert got.columns[:7] == frame.columns and len(got.columns) == 9
    ids = [r["doc_id"] for r in got.collect()]
    if empty:
        assert ids == []
    else:
        assert {1, None, 8, 9} <= set(ids) and not {2, 3, 4, 5, 7} & set(ids) and ids.count(9) == 1


def test_every_stage_keeps_its_names_apart():
    source = inspect.getsource(corpus_pipeline)
    assert not re.search(r"except|limit\(", source)
