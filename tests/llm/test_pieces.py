import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from brindle.llm import pieces as P


@pytest.fixture(scope="module")
def coder():
    return P.Coder(P.load(public_tokenizers.path(P.MODEL)))


@pytest.fixture(scope="module")
def library(coder):
    """SentencePiece itself, as a unigram model with the same scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = pb.ModelProto()
    with open(public_tokenizers.path(P.MODEL), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for place, score in zip(coder.vocabulary["ids"], coder.vocabulary["scores"]):
        model.pieces[place].score, model.pieces[place].type = score, 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def score(coder, ids):
    own = dict(zip(coder.vocabulary["ids"], coder.vocabulary["scores"]))
    return sum(own.get(i, 0.0) for i in ids)


def test_as_good_as_the_library(spark, sf_dir, coder, library):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    same = 0
    for text, ids in zip(texts, coder.encode_all(texts)):
        other = library.encode(text)
        ids = ids.tolist()
        same += ids == other
        assert score(coder, ids) == pytest.approx(score(coder, other), abs=1e-2 + 1e-5 * len(ids))
    assert same > 0.9 * len(texts)


def test_viterbi_against_all_segmentations(coder):
    vocabulary = coder.vocabulary
    scores = {P_id: s for P_id, s in zip(vocabulary["ids"], vocabulary["scores"])}
    spelt = {vocabulary["spelt"][vocabulary["spelt_at"][i] : vocabulary["spelt_at"][i + 1]].tobytes().decode(): i for i in vocabulary["ids"]}

    def best(word):
        top = [(0.0, [])]
        for end in range(1, len(word) + 1):
            made = [(top[start][0] + scores[spelt[word[start:end]]], top[start][1] + [spelt[word[start:end]]]) for start in range(end) if word[start:end] in spelt and top[start]]
            top.append(max(made, key=lambda pair: pair[0]) if made else None)
        return top[-1][0]

    for word in ["the", "tokenization", "ththandedble", "aaaaaaaa", "été"]:
        ids = coder.encode(word)
        assert score(coder, ids) == pytest.approx(best(" " + word))


@pytest.mark.parametrize(
    "text", ["", " ", "  ", "a", " a ", "\n\t\r", "▁", "a▁ b", "▁▁", "日本語\u0000", "😀 é", "x" * 3000, "no_space" * 500, " " * 70, "tab\tand  two"]
)
def test_round_trip(coder, text):
    assert coder.decode(coder.encode(text)) == text


def test_random_round_trips(coder):
    pick = random.Random(1)
    texts = ["".join(pick.choice(["a", "th", " ", "▁", "é", "漢", "😀", "\n", "{", "=="]) for _ in range(pick.randint(0, 60))) for _ in range(400)]
    assert [coder.decode(ids) for ids in coder.encode_all(texts)] == texts


def test_trie_holds_exactly_the_words():
    words = [b"a", b"ab", b"abc", b"b", b"\xff\x00", b" the", b" them", b"zz"]
    base, check, value = P.double_array(words)

    def find(word):
        state = 0
        for byte in word:
            ahead = base[state] + byte
            if not (0 < ahead < len(check) and check[ahead] == state):
                return -1
            state = ahead
        return value[state]

    assert [find(word) for word in words] == list(range(len(words)))
    assert [find(word) for word in (b"", b"abcd", b" th", b"z", b"ba")] == [-1] * 5


def test_memory_may_start_anew(monkeypatch, coder):
    monkeypatch.setattr(P, "_REMEMBERED", 3)
    fresh = P.Coder({**coder.vocabulary, "memory": {"words": P.Words()}})
    texts = [f"word{i} and more{i}" for i in range(30)]
    assert [fresh.encode(text) for text in texts] == [ids.tolist() for ids in coder.encode_all(texts)]


def test_whole_table_and_edge_cases(spark, sf_dir, docs):
    rows = P.op4_pieces(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.where("not round_trip").count() == 0
    vocabulary = P.vocabulary_for(spark)
    frame = docs([(1, None), (2, ""), (None, "x y"), (3, "word " * 50_000), (3, "word " * 50_000)])
    got = {r["doc_id"]: r for r in P.encoded_documents(frame.withColumn("n_pieces", F.lit(1)), vocabulary).collect()}
    assert got[1]["piece_ids"] is None and got[1]["n_pieces"] == 0 and got[2]["piece_ids"] == []
    assert got[None]["n_pieces"] == 2 and all(r["round_trip"] for r in got.values())
    assert P.encoded_documents(docs([]), vocabulary).count() == 0
