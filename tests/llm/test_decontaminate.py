import random

import pytest
from pyspark.sql import functions as F

from brindle.llm import decontaminate as D


def distance_to_substrings(item, text):
    """Least edit distance of the item to any substring of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def spoil(pick, text, edits):
    for _ in range(edits):
        at = pick.randrange(len(text))
        text = pick.choice([text[:at] + text[at + 1 :], text[:at] + pick.choice("abcdefgh") + text[at:], text[:at] + "q" + text[at + 1 :]])
    return text


def test_myers_against_the_table():
    pick = random.Random(3)
    for _ in range(150):
        text = "".join(pick.choice("abc ") for _ in range(pick.randint(0, 90)))
        item = "".join(pick.choice("abc ") for _ in range(pick.randint(1, 80)))
        assert D.myers(D.pattern_masks(item), len(item), text)[0] == distance_to_substrings(item, text)


def test_nothing_within_the_budget_is_missed():
    pick = random.Random(5)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
    items = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(6, 25)))) for i in range(12)]
    matcher = D.Matcher(items)
    for _ in range(120):
        place = pick.randrange(len(items))
        inside = spoil(pick, items[place][1], pick.randint(0, D.budget(items[place][1]) + 3))
        text = " ".join(pick.choice(words) for _ in range(20)) + " " + inside + " " + " ".join(pick.choice(words) for _ in range(20))
        want = {i: d for i, (_, item) in enumerate(items) if (d := distance_to_substrings(item, text)) <= D.budget(item)}
        got = {i: match[0] for i, match in matcher.matches(text)}
        assert got == want


def test_pieces():
    item = "x" * 100
    assert "".join(piece for _, piece in D.pieces(item)) == item and len(D.pieces(item)) == D.budget(item) + 1


def test_whole_table(spark, sf_dir):
    items = [(r["item_id"], D.normal(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {(doc, item) for doc, text in docs for item, wanted in items if wanted in D.normal(text)}
    rows = D.op5_decontaminate(spark, sf_dir).collect()
    assert want and want <= {(r["doc_id"], r["item_id"]) for r in rows}
    texts, wanted = dict(docs), dict(items)
    for r in rows:
        span = D.normal(texts[r["doc_id"]][r["start"] : r["end"]])
        assert distance_to_substrings(wanted[r["item_id"]], span) == r["distance"] <= D.budget(wanted[r["item_id"]])


ITEM = "The quick brown fox jumps over the lazy dog and runs away into the woods"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def test_edge_cases(spark, docs):
    rows = [
        (1, f"Before it. {ITEM.upper()}, after."), (1, f"Before it. {ITEM.upper()}, after."), (2, "nothing here"), (3, ""), (None, ITEM.replace("lazy", "lzay")),
        (5, None), (6, ITEM.replace(" ", "\n\t ")), (7, "pad " * 300_000 + ITEM), (8, ITEM[:40]), (9, "...!?"),
    ]
    benchmark = bench(spark, ITEM, ITEM, None, "", "too short")
    found = D.find_items(docs(rows), benchmark).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in found) == sorted((str(d), i) for d in (1, 1, None, 6, 7) for i in (0, 1))
    spans = {r["doc_id"]: (r["start"], r["end"]) for r in found}
    assert spans[1] == (11, 11 + len(ITEM)) and spans[7] == (1_200_000, 1_200_000 + len(ITEM))
    frame = docs(rows).withColumn("item_id", F.lit(0))
    kept = D.without_items(frame, benchmark)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5, 8, 9]


@pytest.mark.parametrize("texts", [(), (None,), ("too short",)])
def test_nothing_to_look_for(spark, docs, texts):
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    assert D.find_items(docs([(1, "text")]), benchmark).count() == 0
    assert D.without_items(docs([(1, "text")]), benchmark).count() == 1
    assert D.find_items(docs([]), bench(spark, ITEM)).count() == 0


def test_blocks_give_the_same(spark, docs):
    items = [f"{ITEM} version {i} of this long sentence" for i in range(9)]
    blocks = list(D.item_blocks(bench(spark, *items), block_chars=200))
    assert len(blocks) > 2 and sorted(i for block in blocks for i, _ in block) == list(range(9))


def test_short_items_and_unspaced_scripts(spark, docs):
    chinese = "植物在光照下把二氧化碳和水转化为有机物并释放氧气的过程叫做什么请从下列选项中选出最合适的一个答案并说明你的理由和依据"
    benchmark = bench(spark, chinese, "extraordinarily uncharacteristic misunderstandings notwithstanding", "cat", "光合作用", "...")
    rows = [
        (1, f"问题：前文{chinese}后文。"), (2, f"前文{chinese.replace('释放', '放出')}后文"), (3, "Some extraordinarily uncharacteristic misunderstandings, notwithstanding."), (4, "a catalog of bobcats"),
        (5, "A cat."), (6, "bobcats and the cat"), (7, "研究光合作用的人"), (8, "nothing"), (9, None), (10, "..."),
    ]
    found = D.find_items(docs(rows), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(1, 0, 0), (2, 0, 2), (3, 1, 0), (5, 2, 0), (6, 2, 0), (7, 3, 0)]
    spans = {r["doc_id"]: (r["start"], r["end"]) for r in found}
    assert spans[6] == (16, 19) and spans[7] == (2, 6)
    assert sorted(r["doc_id"] for r in D.without_items(docs(rows), benchmark).collect()) == [4, 8, 9, 10]


@pytest.mark.parametrize("front", ["", "İ", "İİİİİİ ", "ßİ x İ", "ǅ ŉ "])
def test_spans_where_lower_case_is_longer(front):
    item = "The quick brown fox jumps over the lazy dog and runs away"
    text = f"{front} {item} at last"
    normal = D.normal(text)
    start = normal.index(D.normal(item))
    low, high = D.original_span(text, start, start + len(D.normal(item)))
    assert text[low:high] == item
