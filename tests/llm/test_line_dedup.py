import compare
import pytest
from pyspark.sql import functions as F

from brindle.llm import line_dedup as L


def test_oracle(spark, sf_dir):
    connection = compare.connect(sf_dir)
    assert compare.differences(L.op3_line_dedup(spark, sf_dir), connection, L.OP3_SQL) is None
    connection.close()


def brute(rows, max_ratio=L.MAX_RATIO, min_pages=L.MIN_PAGES):
    hosts = {}
    for _, text, _, source in rows:
        if text is not None:
            hosts.setdefault(source, set()).add(text)
    out = []
    for doc, text, _, source in rows:
        if text is not None:
            pages = hosts[source]
            share = {line.strip(" "): sum(line.strip(" ") in {x.strip(" ") for x in page.split("\n")} for page in pages) for line in text.split("\n")}
            text = "\n".join(
                line for line in text.split("\n")
                if not line.strip(" ") or not (share[line.strip(" ")] >= min_pages and share[line.strip(" ")] > max_ratio * len(pages))
            )
        out.append((doc, text, source))
    return sorted(out, key=str)


def test_small_hosts(docs):
    rows = [(i, f"Menu\nown line {i}\n  Menu  \n\nFooter", "en", "a") for i in range(6)]
    rows += [(10, "Menu\nFooter", "en", "b"), (11, "Footer", "en", "b"), (12, None, "en", "b"), (13, "", "en", "b"), (14, "Menu", "en", None)]
    rows += [(20 + i, f"Menu\n{i}", None, None) for i in range(4)] + [(5, "Menu\nown line 5\n  Menu  \n\nFooter", "en", "a")]
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in L.drop_boilerplate(docs(rows)).collect()), key=str)
    assert got == brute(rows)
    assert (0, "own line 0\n", "a") in got and (10, "Menu\nFooter", "b") in got and (14, "", None) in got


def test_copies_of_a_page_are_one_page(docs):
    rows = [(i, "same\ntext", "en", "a") for i in range(50)] + [(100 + i, f"other {i}", "en", "a") for i in range(50)]
    assert L.drop_boilerplate(docs(rows)).where("text = 'same\ntext'").count() == 50


@pytest.mark.parametrize("text", ["", "x", "long " * 200_000])
def test_texts_are_whole(docs, text):
    assert [r["text"] for r in L.drop_boilerplate(docs([(1, text)])).collect()] == [text]


def test_empty_table_and_clashing_names(docs):
    assert L.drop_boilerplate(docs([])).count() == 0
    frame = docs([(i, f"Menu\n{i}") for i in range(5)]).withColumn("llm_host", F.lit(1)).withColumn("line", F.lit("x")).withColumn("pages", F.lit(3))
    got = L.drop_boilerplate(frame)
    assert got.columns == frame.columns and {r["text"] for r in got.collect()} == set("01234")
