import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import super_min_hash as S


def brute_set(text, width=2):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def brute(rows):
    """``doc_id: (n_shingles, component_id)`` by comparing all pairs of distinct sets."""
    sets = [frozenset(brute_set(text)) for _, text in rows]
    known = sorted(set(sets), key=len)
    root = {one: one for one in known}

    def find(one):
        while root[one] != one:
            one = root[one]
        return one

    for i, one in enumerate(known):
        for other in known[i + 1 :]:
            if 100 * len(one) < 80 * len(other):
                break
            if one and 100 * len(one & other) >= 80 * len(one | other):
                root[find(one)] = find(other)
    least = {}
    for (doc, _), own in zip(rows, sets):
        if own:
            least.setdefault(find(own), []).append(doc)
    least = {one: min((doc for doc in docs if doc is not None), default=None) for one, docs in least.items()}
    return [(doc, len(own), least[find(own)] if own else doc) for (doc, _), own in zip(rows, sets)]


def result(frame, **options):
    found = S.near_duplicates(frame, **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = found.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr)


def words_of(draw, n, vocabulary=3000):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return words


@pytest.mark.parametrize("size", [1, 3, 10, 200, 5000])
def test_registers_estimate_similarity(size):
    draw = np.random.default_rng(size)
    errors = []
    for _ in range(40):
        base = draw.integers(0, 1 << 63, 2 * size).astype(np.uint64)
        one, other = base[: size + size // 2], base[size // 2 :]
        truth = np.intersect1d(one, other).size / np.union1d(one, other).size
        first, second = S.signatures([one, other])
        errors.append((first == second).mean() - truth)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def plain_signature(elements, registers):
    """One element at a time, all ranks."""
    found = [2**64 - 1] * registers
    for element in elements.tolist():
        order = list(range(registers))
        for rank in range(registers):
            drawn = int(S.mixed(np.array([(element + (rank + 1) * int(S._STEP)) % 2**64], np.uint64))[0])
            place = rank + ((drawn & 0xFFFFFFFF) * (registers - rank) >> 32)
            order[rank], order[place] = order[place], order[rank]
            found[order[rank]] = min(found[order[rank]], rank << 32 | drawn >> 32)
    return found


def test_early_stop_changes_nothing():
    draw = np.random.default_rng(0)
    sets = [draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (0, 1, 2, 7, 40, 300)]
    got = S.signatures(sets, 24)
    assert [row.tolist() for row in got] == [plain_signature(one, 24) for one in sets]


def test_large_sets_in_parts(monkeypatch):
    draw = np.random.default_rng(0)
    sets = [draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (5, 1000, 3, 700, 2)]
    whole = S.signatures(sets)
    monkeypatch.setattr(S, "_AT_ONCE", 64)
    assert (S.signatures(sets) == whole).all()


def test_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in table.collect()])
    assert result(table.withColumn("size", F.lit(1)).withColumn("keys", F.lit("x"))) == sorted(want, key=repr)
    assert sum(component != doc for doc, _, component in want) > 5


def test_odd_rows(spark, docs):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, "x y"), (None, "one two"),
        (10, "a b c d e"), (10, "a b c d e"), (11, "A B\tC  D\nE"), (None, "only null ids here"), (None, "only null ids here"),
        (13, "a b " * 50_000), (14, "a b " * 40_000), (None, None), (15, "É b c"), (16, "é b c"), (17, "a b c d e f"),
    ]
    assert result(docs(rows)) == sorted(brute(rows), key=repr)


def test_empty(spark, docs):
    assert result(docs([])) == []


@pytest.mark.parametrize("edits", [6, 10])
def test_one_large_group_is_linear(spark, docs, edits, monkeypatch):
    """Copies of one text with edits of their own: alike to it, not always to one another; pairs grow with the copies, not their square."""
    compared = []

    def counting(pairs, sets, plain=S.verified):
        pairs = S.materialize(pairs, "pairs")
        compared.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(S, "verified", counting)
    monkeypatch.setattr(S, "direct", None)  # no key is left with several classes
    draw = random.Random(edits)
    base = words_of(draw, 200)
    rows = [(7, " ".join(base))] + [(100 + i, " ".join(edited(draw, base, edits))) for i in range(600)]
    draw.shuffle(rows)
    got = result(docs(rows))
    assert {component for _, _, component in got} == {7}
    assert sum(compared) <= 10 * len(rows)


def test_recall_of_edited_copies(spark, docs):
    draw = random.Random(3)
    rows, doc = [], 0
    for _ in range(150):
        base = words_of(draw, draw.randrange(8, 300))
        for _ in range(2):
            rows.append((doc, " ".join(edited(draw, base, draw.randrange(1 + len(base) // 15)))))
            doc += 1
    got, want = result(docs(rows)), sorted(brute(rows), key=repr)
    missed = sum(a != b for a, b in zip(got, want))
    assert len(got) == len(want) and missed <= 0.01 * len(want)
    assert sum(doc != component for doc, _, component in want) > 50


@pytest.mark.parametrize("rounds", [1, 3])
def test_pairs_left_after_the_hubs(spark, rounds):
    """Sets of one key in which the hub links with none of two classes that link with each other."""
    draw = random.Random(2)
    base = words_of(draw, 120)
    texts = [edited(draw, base, 25) for _ in range(12)]
    texts += [edited(draw, text, 2) for text in texts]
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    sets = [S.shingle_set(text.encode()) for _, text in rows]
    buckets = spark.createDataFrame([(1, i, one.size, 24 - i) for i, one in enumerate(sets)], "key bigint, node bigint, size bigint, central bigint")
    held = spark.createDataFrame([(i, one.view(np.int64).tolist()) for i, one in enumerate(sets)], "node bigint, found array<bigint>")
    want = {frozenset((a, b)) for a, b in itertools.combinations(range(24), 2) if 100 * np.intersect1d(sets[a], sets[b]).size >= 80 * np.union1d(sets[a], sets[b]).size}
    found = S.materialize(S.links(buckets, held, rounds))
    assert {frozenset((r["a"], r["b"])) for r in found.collect()} <= want
    joined = {r["node"]: r["root"] for r in S.components(found).collect()}
    assert want and all(joined[a] == joined[b] for a, b in map(tuple, want))
