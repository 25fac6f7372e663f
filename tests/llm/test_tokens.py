import numpy as np
import pyarrow as pa
import pytest
from llm_data import EDGES, docs  # noqa: F401

from tempora.llm.sentencepiece import MODEL, Vocabulary, decode, decode_ids, encode, encode_texts, op8_sentencepiece

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary()


def brute(word, scores):
    """Best path of a word, position by position; of equal scores the longer last piece."""
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + scores[word[s:end]], best[s][1] + [word[s:end]])
                   for s in range(max(0, end - 16), end) if word[s:end] in scores and best[s]]
        best.append(max(options, key=lambda o: o[0]) if options else None)
    return best[-1][1]


def test_words_equal_the_plain_search(vocabulary):
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=MODEL)
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    words = ["the", "tokenizer", "xyzzy", "Straße", "a", "internationalization" * 3, "zzzzzzzzzzzzzzzzzzzz"]
    ids, per = encode_texts(pa.array(words), vocabulary)
    at = np.concatenate([[0], np.cumsum(per)])
    for w, a, b in zip(words, at, at[1:]):
        assert [model.id_to_piece(int(i)) for i in ids[a:b]] == brute("▁" + w, scores)


def test_text_without_spaces_equals_the_plain_search(vocabulary):
    import random
    import time

    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=MODEL)
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (47, 48, 49, 333, 2000)]
    words += ["的一是不了人我在有他这为之大来以个中上们" * 40, "ab" * 500, "naïveßtraße" * 60]
    words = [w for w in words if all(c in scores for c in w)]
    ids, per = encode_texts(pa.array(words), vocabulary)
    at = np.concatenate([[0], np.cumsum(per)])
    for w, a, b in zip(words, at, at[1:]):
        assert [model.id_to_piece(int(i)) for i in ids[a:b]] == brute("▁" + w, scores)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(80_000))
    spaced = " ".join(text[i:i + 6] for i in range(0, len(text), 6))
    spent = []
    for t in (spaced, text):
        start = time.process_time()
        encode_texts(pa.array([t]), vocabulary)
        spent.append(time.process_time() - start)
    assert spent[1] < 10 * max(spent[0], 0.02), spent


def test_paths_equal_the_librarys_best_one(vocabulary, spark):
    """The same pieces and scores in the library's lattice: its best path."""
    import sentencepiece as sp
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    model = sp.SentencePieceProcessor(model_proto=proto.SerializeToString())
    text = " ".join(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect())
    words = sorted({w for w in text.split() if w.isalpha() and w.isascii()})[:400]
    ids, per = encode_texts(pa.array(words), vocabulary)
    at = np.concatenate([[0], np.cumsum(per)])
    assert len(words) > 200
    for w, a, b in zip(words, at, at[1:]):
        best = model.nbest_encode_as_ids(w, 1)[0]
        mine = ids[a:b].tolist()
        score = [sum(model.get_score(i) for i in path) for path in (best, mine)]
        assert mine == best or score[0] == score[1]


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b\n\tc", "▁", "▁a ▁ b", "漢字かな\U0001f600", "x" * 5000, "\0\x7f",
         "é́", "a b", "end\n", "\U0001f3f3️‍\U0001f308 ok", "<0x41><s>"]


def test_round_trip(vocabulary):
    ids, per = encode_texts(pa.array(TEXTS + [None]), vocabulary)
    assert [b.decode() for b in decode_ids(ids, per, vocabulary).to_pylist()] == TEXTS + [""]


def test_bytes_that_are_no_utf8(vocabulary):
    raw = pa.array([b"ok", b"\xff\xfea \xc3", "é".encode()], pa.binary())
    ids, per = encode_texts(raw, vocabulary)
    assert decode_ids(ids, per, vocabulary).to_pylist() == raw.to_pylist()


def test_batches_do_not_matter(vocabulary):
    ids, per = encode_texts(pa.array(TEXTS), vocabulary)
    one = [encode_texts(pa.array([t]), vocabulary)[0].tolist() for t in TEXTS]
    at = np.concatenate([[0], np.cumsum(per)])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == one


def test_rows(spark, docs, vocabulary):
    df = docs([*EDGES, *enumerate(TEXTS, 100)], "ids n_tokens id")
    out = encode(df, vocabulary=vocabulary, check=True)
    rows = out.collect()
    assert len(rows) == df.count() and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    back = decode(out).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted(
        (str(r.doc_id), r.text or "") for r in df.collect())
    assert encode(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in decode(none).collect()) == [(1, None), (2, "")]


def test_query(spark):
    rows = op8_sentencepiece(spark, SF)
    assert rows.filter("round_trip").count() == rows.count() == 1000
