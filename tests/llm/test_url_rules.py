import itertools

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.llm import url_rules as U


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[cut:]
    end = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def plain_rule(host, path):
    fits = [(kind, h + p) for kind, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda rule: len(rule[1])) if fits else None


URLS = [
    None, "", "example.com/en/", "http://EXAMPLE.com/en/1", "https://www.example.com/en/", "https://a.www.example.com/en/x?y", "http://notexample.com/en/", "http://x.net/es/1",
    "http://net/fr/", "http://x.net/esp/", "x://h?a/b#c", "http://É.com/A", "a://b://c.net/es/", "http://com", "http://com/", "http://x.net#/es/", "http://x.net/ES/", "http://u@h:80/p", "://com/x\ny",
]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string").withColumn("rule", F.lit(1)).withColumn("items", F.lit(2))
    labels = spark.createDataFrame([], "page_id int, block boolean")
    rows = {r["page_id"]: r for r in U.judge(pages, labels).collect()}
    for place, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        got = rows[place]
        assert (got["host"], got["path"]) == (host, path)
        assert (got["rule"], got["verdict"]) == ((rule[1], rule[0]) if rule else (None, "allow"))


def brute_rules(sets, support, confidence, lift):
    """Association rules that conclude block, by counting every subset."""
    counts, blocked = {}, {}
    for items, block in sets:
        for size in range(1, len(items) + 1):
            for chosen in itertools.combinations(items, size):
                counts[chosen] = counts.get(chosen, 0) + 1
                blocked[chosen] = blocked.get(chosen, 0) + block
    share = sum(block for _, block in sets) / len(sets)
    return {
        " & ".join(chosen): (n, blocked[chosen] / n) for chosen, n in counts.items()
        if blocked[chosen] >= support * len(sets) and blocked[chosen] / n >= confidence and blocked[chosen] / n / share >= lift
    }


def corpus(spark):
    urls, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        host = "spam.example.org" if bad else f"site{i % 4}.example.org"
        urls.append((i, f"https://{host}/{'ads' if i % 3 == 0 else 'en'}/{i}" + ("?q=1" if i % 2 else "")))
        if i % 10 != 7:
            labels.append((i, 0 if bad else 1, 0))
    urls += [(900 + i, "http://spam.example.org/x") for i in range(3)] + [(900, "http://spam.example.org/x"), (None, "https://spam.example.org/en/1"), (990, None)]
    return spark.createDataFrame(urls, "page_id bigint, url string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_learned_rules_against_counting(spark):
    pages, labels = corpus(spark)
    urls, marks = U.parsed(pages), U.block_labels(labels)
    mined = {r["rule"]: r["confidence"] for r in U.mine(urls, marks).collect()}
    known = {r["page_id"]: r["block"] for r in marks.collect()}
    sets = [(tuple(r["items"]), known[r["page_id"]]) for r in urls.collect() if r["page_id"] in known]
    want = brute_rules(sets, max(U.MIN_SUPPORT, U.MIN_LABELS / len(sets)), U.MIN_CONFIDENCE, U.MIN_LIFT)
    assert want and mined == {rule: pytest.approx(conf) for rule, (_, conf) in want.items()}
    fired = {rule for rule in want}
    for r in U.judge(pages, marks).collect():
        items = next(set(u["items"]) for u in [r_ for r_ in urls.collect() if r_["page_id"] == r["page_id"]][:1]) if r["page_id"] in (0, 1, 901, 990) else None
        if items is not None:
            block = any(set(rule.split(" & ")) <= items for rule in fired)
            assert r["verdict"] == ("block" if block else "allow")


def test_verdicts_and_rows(spark):
    pages, labels = corpus(spark)
    rows = U.judge(pages, U.block_labels(labels)).collect()
    assert len(rows) == pages.count()
    assert all((r["verdict"] == "block") == (r["host"] == "spam.example.org") for r in rows)


def test_oracle(spark, sf_dir):
    connection = compare.connect(sf_dir)
    assert compare.differences(U.op9_url_rules(spark, sf_dir), connection, U.OP9_SQL) is None
    connection.close()


def test_oracle_where_rules_fire(spark):
    pages, labels = corpus(spark)
    connection = duckdb.connect()
    connection.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    connection.register("labels", labels.toPandas())
    got = U.judge(pages, U.block_labels(labels))
    assert got.where("learned is not null").count() > 50
    assert compare.differences(got, connection, U.OP9_SQL) is None


def test_no_python_in_the_plan(spark, sf_dir):
    plan = U.op9_url_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_whole_table(spark, sf_dir):
    rows = U.op9_url_rules(spark, sf_dir).collect()
    given = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(given)
    for r in rows:
        host, path = plain_parts(given[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule[1] if rule else None)
        assert r["verdict"] == (rule[0] if rule else "block" if r["learned"] else "allow")


def test_empty_tables_and_nulls(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    labels = spark.createDataFrame([(None, 0, 1), (1, None, None), (1, 0, None), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {r["page_id"]: r["block"] for r in U.block_labels(labels).collect()} == {1: True, 2: False}
    assert U.judge(pages, U.block_labels(labels)).count() == 0


def test_tokens_of_every_part_are_learned(spark):
    """A middle host label, a later path segment and a query name, each over many hosts."""
    urls, labels = [], []
    for i in range(600):
        tail = [f"www.casino-win.s{i}.org/en/{i}", f"a{i}.org/x{i}/en/free-bets/{i}.html", f"b{i}.org/en/{i}?pills={i}"][i % 3] if i < 300 else f"c{i}.org/en/{i}?q={i}"
        urls.append((i, f"https://{tail}"))
        labels.append((i, 0 if i < 300 else 1, 0))
    urls += [(900, "http://m.casino.zz.info/new"), (901, "http://other.info/a/b/bets"), (902, "http://other.info/a?x=1&pills=2#f"), (903, "http://other.info/a?q=1")]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    rows = {r["page_id"]: r["verdict"] for r in U.judge(pages, U.block_labels(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")), []).collect()}
    assert {i for i, verdict in rows.items() if verdict == "block"} == {*range(300), 900, 901, 902}


def token_corpus():
    """Blocked URLs that share a later folder, a middle host label or a query name; none of the fixed places tells."""
    urls, labels = [], []
    for i in range(600):
        tail = [f"www.casino-win.s{i}.org/en/{i}", f"a{i}.org/x{i}/en/free-bets/{i}.html", f"b{i}.org/en/{i}?pills={i}"][i % 3] if i < 300 else f"c{i}.org/en/{i}?q={i}"
        urls.append((i, f"https://{tail}"))
        labels.append((i, 0 if i < 300 else 1, 0))
    urls += [(900, "http://m.casino.zz.info/new"), (901, "http://other.info/a/b/bets"), (902, "http://other.info/a?x=1&pills=2#f"), (903, "http://other.info/a?q=1"), (904, None)]
    return urls, labels


def mixed_corpus():
    """Two tokens that tell only together, beside one that tells alone."""
    urls, labels = [], []
    for i in range(480):
        folder = ["red/blue", "red/white", "grey/blue", "grey/white"][i % 4]
        urls.append((i, f"https://h{i}.org/{folder}/{i}" + ("?spam=1" if i % 16 == 3 else "")))
        labels.append((i, 0 if i % 4 == 0 or i % 16 == 3 else 1, 0))
    return urls, labels


@pytest.mark.parametrize("made", [token_corpus, mixed_corpus])
def test_oracle_over_all_tokens(spark, made):
    import pandas as pd

    urls, labels = made()
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    connection = duckdb.connect()
    connection.register("pages", pd.DataFrame(urls, columns=["page_id", "url"]).astype({"page_id": "Int64"}))
    connection.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
    got = U.judge(pages, U.block_labels(marks))
    blocked = got.where("learned is not null")
    assert blocked.count() >= 100
    assert compare.differences(got, connection, U.OP9_SQL) is None
    if made is mixed_corpus:
        assert {r["learned"] for r in blocked.select("learned").distinct().collect()} >= {"dir=blue & dir=red"} or blocked.where("learned like '% & %'").count() > 0


def parallel_corpus(names):
    """Blocked URLs with all query names but one each; allowed ones have none of them."""
    urls = [(i, f"https://h{i}.org/p?" + "&".join(f"k{n}=y" for n in range(names) if n != i % names)) for i in range(120)]
    urls += [(200 + i, f"https://g{i}.org/p?other={i}") for i in range(120)] + [(500, "http://x.org/?k3=2"), (501, "http://x.org/?k=2")]
    labels = [(i, 0, 0) for i in range(120)] + [(200 + i, 1, 0) for i in range(120)]
    return urls, labels


@pytest.mark.parametrize("names", [10, 24])
def test_tokens_of_nearly_the_same_rows(spark, names):
    import time

    urls, labels = parallel_corpus(names)
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    marks = U.block_labels(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    start = time.perf_counter()
    got = {r["page_id"]: r["verdict"] for r in U.judge(pages, marks, []).collect()}
    assert time.perf_counter() - start < 60
    assert {i for i, verdict in got.items() if verdict == "block"} == {*range(120), 500}
    if names == 10:  # the same by counting every set of tokens
        known = {r["page_id"]: r["block"] for r in marks.collect()}
        rows = {r["page_id"]: r["tokens"] for r in U.parsed(pages).collect()}
        often = {t for t in set().union(*rows.values()) if sum(known[i] for i in known if t in rows[i]) >= U.MIN_LABELS}
        sets = [(tuple(t for t in rows[i] if t in often), known[i]) for i in known]
        rules = [set(rule.split(" & ")) for rule in brute_rules(sets, U.MIN_LABELS / len(sets), U.MIN_CONFIDENCE, U.MIN_LIFT)]
        assert {i for i in rows if any(rule <= set(rows[i]) for rule in rules)} == {*range(120), 500}
