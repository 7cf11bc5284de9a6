import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import language as L


def test_held_out_accuracy(spark, sf_dir):
    rows = {r["doc_id"]: r for r in L.op6_language(spark, sf_dir).collect()}
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(given)
    right = total = 0
    for r in given:
        out = rows[r["doc_id"]]
        assert out["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= out["score"] <= 1
        if out["held_out"] and r["lang"]:
            total += 1
            right += out["lang_pred"] == r["lang"]
    assert total > 20 and right >= 0.97 * total


def test_held_out_rows_and_labels_play_no_part(spark, docs):
    base = [(i, f"the cat number {i} sat there", "en") for i in range(40)] + [(i, f"le chat chante ici {i} fois", "fr") for i in range(40, 80)]
    changed = [(i, t, "xx") if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, lang) for i, t, lang in base]
    one, two = L.fit(docs(base)), L.fit(docs(changed))
    assert one.languages == two.languages == ["en", "fr"] and np.array_equal(one.weights, two.weights)


def test_letters_against_a_plain_reading():
    for text in ["", "  ", "123 !", "Abc, dÉf\n\nGHI", "日本 x", "a😀b", "ǅ", "x" * 5]:
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        want = " " + " ".join(plain.split()) + " " if plain.strip() else ""
        assert "".join(map(chr, L.letters(text))) == want


def test_blocks_cover_every_ngram(monkeypatch):
    codes = L.letters("abcdefgh ijkl mnop qrst uvw xyz")
    whole = {tuple(codes[i : i + 3]) for i in range(len(codes) - 2)}
    monkeypatch.setattr(L, "_BLOCK", 7)
    parts = [tuple(part[i : i + 3]) for part in L.blocks(codes) for i in range(len(part) - 2)]
    assert set(parts) == whole and len(parts) == len(codes) - 2


def test_edge_cases(spark, docs):
    learn = docs([(i, f"the cat number {i} sat on that mat", "en") for i in range(40)] + [(i, "der hund schläft auf dem bett", "de") for i in range(40, 80)])
    model = L.fit(learn)
    rows = [(1, None), (2, ""), (3, "123 ..."), (None, "the cat sat"), (5, "der hund " * 100_000), (6, "the cat sat"), (6, "the cat sat")]
    frame = docs(rows).withColumn("score", F.lit("x"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["held_out"]) for r in L.predict(frame, model).collect()}
    assert [got[i][:2] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[None][0] == "en" and got[None][2] is False and got[5][0] == "de" and got[6][0] == "en"
    kept = L.known_language_only(frame, model)
    assert kept.columns == frame.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "6", "6", "None"]


def plain_bayes(learn, texts, bits):
    """Multinomial naive Bayes, n-gram by n-gram: ``log P(n-gram | language)`` by bucket, and language and score of each text."""
    import math

    def grams(text):
        own = L.letters(text or "").tolist()
        for order in range(1, 4):
            for at in range(len(own) - order + 1):
                rolling = 0
                for place, code in enumerate(own[at : at + order], 1):
                    rolling = (rolling * 0x01000193 + code + place) % 2**32
                mixed = ((rolling ^ rolling >> 15) * 0x85EBCA6B) % 2**32
                yield mixed >> 32 - bits

    languages = sorted({lang for _, lang in learn})
    counts = {lang: [0.5] * 2**bits for lang in languages}
    for text, lang in learn:
        for slot in grams(text):
            counts[lang][slot] += 1
    logs = {lang: [math.log(n / sum(own)) for n in own] for lang, own in counts.items()}
    made = []
    for text in texts:
        slots = list(grams(text))
        if not slots:
            made.append(("und", 0.0))
            continue
        totals = {lang: sum(logs[lang][slot] for slot in slots) / 3 for lang in languages}
        best = max(languages, key=lambda lang: totals[lang])
        made.append((best, 1 / sum(math.exp(total - totals[best]) for total in totals.values())))
    return languages, logs, made


def test_against_plain_naive_bayes(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "MAX_BITS", 9)
    learn = [(i, f"the cat number {i % 7} sat on that mat, then ran" if i % 2 else f"der hund {i % 5} schläft auf dem bett unter dem tisch", "en" if i % 2 else "de") for i in range(60)]
    model = L.fit(docs(learn))
    used = [(text, lang) for i, text, lang in learn if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = ["the cat", "der hund und the cat", None, "", "12 3", "a", "z" * 50, "über dem tisch sat the mat " * 40, "qx"]
    languages, logs, want = plain_bayes(used, texts, 9)
    assert model.languages == languages and model.bits == 9
    assert np.allclose(model.weights, np.array([logs[lang] for lang in languages]).T, atol=1e-5)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs(list(enumerate(texts))), model).collect()}
    for place, (lang, score) in enumerate(want):
        assert got[place][0] == lang and got[place][1] == pytest.approx(score, abs=1e-3)
    # Texts scored together, in parts and alone give the same.
    judge = L.scorer(model.languages, model.bits, model.weights)
    alone = [judge([text])[0] for text in texts]
    monkeypatch.setattr(L, "_BLOCK", 5)
    for one, other in zip(judge(texts), alone):
        assert one[0] == other[0]


def test_too_many_languages(docs, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError):
        L.fit(docs([(i, "words", f"l{i}") for i in range(40)]))


def test_ties_take_the_first_language(docs):
    model = L.fit(docs([(i, "same words", lang) for i, lang in zip(range(0, 80), ["b", "a"] * 40)]))
    model.weights[:, 1] = model.weights[:, 0]
    assert L.scorer(model.languages, model.bits, model.weights)(["same words"]) == [("a", pytest.approx(0.5))]


@pytest.mark.parametrize("rows", [[], [(1, "text", None)], [(None, "text", "en")]])
def test_nothing_to_learn(docs, rows):
    model = L.fit(docs(rows))
    assert model.languages == [] and all(r["lang_pred"] == "und" for r in L.predict(docs(rows), model).collect())
