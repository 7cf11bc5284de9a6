import itertools
import random
import re

import compare
import pytest
from pyspark.sql import functions as F

from brindle.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def brute(facts):
    """The lightest repair by trying every edit of every row, with up to two insertions before each and at the end."""
    best = None
    steps = [["K"] * bool(initial) + ["Ru", "Ra", "D"] if fault not in (C.BLANK, C.COPY) else ["D"] for initial, fault in facts]
    inserts = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*steps):
        for put in itertools.product(inserts, repeat=len(facts) + 1):
            initials, audit, cost = "", "", 0
            for i, made in enumerate(put):
                initials, audit, cost = initials + made, audit + "I" * len(made), cost + 5 * len(made)
                if i < len(edits):
                    edit = edits[i]
                    initials += facts[i][0] if edit == "K" else edit[1:]
                    audit += edit[0]
                    cost += {"K": 0, "R": 1, "D": 2}[edit[0]] + (5 if facts[i][1] == C.CUT and edit != "D" else 0)
            if PATTERN.fullmatch(initials) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(25))
def test_lightest_against_all_edits(seed):
    draw = random.Random(seed)
    facts = [(draw.choice("suauatx") if draw.random() < 0.95 else "", draw.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(draw.randrange(4))]
    assert C.derive(facts)[C.ASSISTANT] == brute(facts)


@pytest.mark.parametrize("seed", range(20))
def test_blocks_chain_to_the_whole(seed):
    draw = random.Random(seed)
    facts = [(draw.choice("suua"), draw.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(draw.randrange(60))]
    width = draw.randrange(1, 9)
    cost, pieces = C.chain(C.all_spans(facts[low : low + width]) for low in range(0, len(facts), width))
    assert (cost, "".join(audit for _, audit in pieces)) == C.derive(facts)[C.ASSISTANT]


def test_agenda_pops_in_order_of_weight():
    chart = C.lightest({"a": (0, ""), "b": (3, "")}, lambda item, chart: [((1, "x"), "c")] if item == "a" else [((2, "y"), "b")] if item == "c" else [])
    assert list(chart.items()) == [("a", (0, "")), ("c", (1, "x")), ("b", (2, "y"))]


def odd_rows():
    draw = random.Random(5)
    texts = ["Yes.", "No!", "cut", "", " \t\n", None, "Yes.", "a? ", "é.", "ends. \r\n", "x" * 5000 + "."]
    rows = [
        (draw.choice([1, 2, 3, 4, 5, 6, 7, None]), draw.choice([None, 0, 1, 2, 3, 4, 5, 6, 9]),
         draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), draw.choice(texts))
        for _ in range(160)
    ]
    return rows + rows[:20] + [(100 + i, 0, "user", "only row") for i in range(60)]


def test_odd_rows_against_sql(spark, written, tmp_path):
    frame = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5).withColumn("audit", F.lit(1)).withColumn("place", F.lit("x"))
    sf = written(conversations=frame)
    connection = compare.duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet/*.parquet')")
    got = C.op11_conversations(spark, sf)
    assert compare.differences(got, connection, C.OP11_SQL) is None
    lost = got.where("conv_id >= 100 and audit = ''").first()
    assert lost["cost"] == 0 and lost["repaired_sha256"].startswith("e3b0c442")


def test_whole_table_against_sql(spark, sf_dir):
    connection = compare.connect(sf_dir)
    assert compare.differences(C.op11_conversations(spark, sf_dir), connection, C.OP11_SQL) is None


@pytest.mark.parametrize("made", [C.repaired, C.repaired_rows])
def test_long_conversations_in_blocks(spark, made, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    draw = random.Random(1)
    rows = [(draw.choice([1, 1, 1, 2, None]), draw.randrange(300), draw.choice(["user", "assistant"]), f"{draw.randrange(200)}.") for _ in range(900)]
    rows += [(1, 7, "user", "copied.")] * 200 + [(9, 0, "user", "short."), (9, 1, "assistant", "one.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    usual, cut = ([tuple(r) for r in made(frame, long_rows=limit).collect()] for limit in (10_000, 50))
    assert sorted(usual, key=repr) == sorted(cut, key=repr) and len(usual) >= 4


def test_repaired_rows_follow_the_pattern(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "user", "c."), (2, 0, "system", "s.")]
    got = C.repaired_rows(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in got] == [(1, 0, "K", "user", "b."), (1, 1, "R", "assistant", "c.")]
    summary = {r["conv_id"]: r for r in C.repaired(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert summary[1]["cost"] == 3 and summary[2]["audit"] == "D" and summary[1]["illegal"] == 1


def test_empty(spark, written):
    sf = written(conversations=spark.createDataFrame([], SCHEMA))
    got = C.op11_conversations(spark, sf)
    assert got.count() == 0
    assert got.dtypes[1:8] == [(n, "bigint") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", "string")]
