import itertools

import pytest
import xxhash
from pyspark.sql import functions as F

from brindle.llm import simhash as S


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable, by repeated comparison of all pairs."""
    best = dict(prints and {k: k for k in prints})
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and best[a] != best[b]:
                best[a] = best[b] = min(best[a], best[b])
                changed = True
    return best


TEXTS = [
    "one two three four five six seven", "One TWO three four five six seven", "one two three four five six eight", "", None, " \t\n ", "solo",
    "two words", "Éa ÉA éa nb sp and more", "x " * 70000, "one two three four five six seven",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode()) & (1 << 64) - 1 == brute_fingerprint(text)


def test_sparks_hash_is_the_same(spark):
    got = spark.sql("SELECT xxhash64('a b c') AS h").first()["h"]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_whole_table(spark, sf_dir):
    rows = S.op8_simhash(spark, sf_dir).collect()
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {doc: brute_fingerprint(text) for doc, text in given.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {doc: f"{value:016x}" for doc, value in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints)


@pytest.mark.parametrize(("radius", "segments"), [(3, 2), (3, 3), (4, 2), (1, 2), (3, 4)])
def test_no_pair_is_lost(spark, radius, segments):
    import random

    pick = random.Random(radius * 10 + segments)
    seeds = [pick.getrandbits(64) for _ in range(25)]
    values = set(seeds)
    for seed in seeds:
        for _ in range(8):
            value = seed
            for _ in range(pick.randint(1, 5)):
                value ^= 1 << pick.randrange(64)
            values.add(value)
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    got = [(r["a"], r["b"]) for r in S.close_pairs(frame, radius=radius, segments=segments).collect()]
    want = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(-5, 129)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: -5 for i in [*range(100, 130), -5]}}


def test_edge_cases(spark, docs):
    rows = [(7, ""), (3, None), (None, " \n"), (9, "solo"), (9, "solo"), (4, "a b c d"), (None, "x y z w"), (2, "A B C D")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (None, 3), (9, 9), (9, 9), (4, 2), (None, None), (2, 2)], key=str)
    kept = S.one_per_class(docs(rows).withColumn("FINGERPRINT", F.lit(1)).withColumn("least", F.lit(2)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "FINGERPRINT", "least"]
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=str) == sorted(
        [(3, None), (9, "solo"), (2, "A B C D"), (None, "x y z w")], key=str
    )
    assert S.near_duplicates(docs([])).count() == 0 and S.one_per_class(docs([])).count() == 0


def test_a_hot_group_of_copies_folds_before_the_search(spark, docs):
    rows = [(i, "the very same text again and again") for i in range(400)] + [(i, f"text number {i} is its own {i * 7}") for i in range(400, 440)]
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(docs(rows)).collect()}
    assert all(got[i] == 0 for i in range(400))
    assert S.one_per_class(docs(rows)).where("doc_id < 400").count() == 1
