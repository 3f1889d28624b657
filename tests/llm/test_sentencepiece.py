import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from clickstream.llm.sentencepiece_viterbi import (
    SPACE, Encoder, PieceModel, decode, decode_column, encode_column, load,
)

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return load(PATH)


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()
    return [r[0] for r in rows]


def small(pieces):
    """A made-up model: pieces by score, then the byte pieces."""
    return PieceModel([*pieces, *[("", 0.0)] * 256], list(range(len(pieces), len(pieces) + 256)), -1)


def brute(model, word):
    """Best total over all segmentations; ties to the longer last piece."""
    best = [(0.0, [])]
    score = {p: (s, i) for i, (p, s) in enumerate(zip(model.texts, model_scores(model))) if p}
    for e in range(1, len(word) + 1):
        top = (best[e - 1][0] + model.unknown_score, best[e - 1][1] + [model.byte_ids[b] for b in word[e - 1].encode()])
        for a in range(e - 1, -1, -1):
            if word[a:e] in score:
                s, i = score[word[a:e]]
                if best[a][0] + s >= top[0]:
                    top = (best[a][0] + s, best[a][1] + [i])
        best.append(top)
    return best[-1][1]


def segment(model, words):
    ids, counts = model.segment(words)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def model_scores(model):
    out = [0.0] * len(model.texts)
    for ids, scores in zip(model.ids[1:], model.scores[1:]):
        for i, s in zip(ids.tolist(), scores.tolist()):
            out[i] = s
    return out


def test_brute_force_on_random_models():
    rnd = random.Random(4)
    for _ in range(30):
        pieces = [(SPACE, -1.0)] + [(p, -float(rnd.randint(1, 6))) for p in
                                   {"".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 5))) for _ in range(20)}]
        m = small(pieces)
        for n in (1, 2, 5, 9):
            words = ["".join(rnd.choice("abcdé") for _ in range(n)) for _ in range(40)]
            assert segment(m, words) == [brute(m, w) for w in words]
            assert [m.segment_long(w) for w in words] == [brute(m, w) for w in words]


def test_same_ids_as_the_library_in_unigram_mode(model, texts):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = sorted({w for t in texts for w in (t or "").split() if all(ch in model.texts for ch in w)})[::200]
    assert len(words) > 100
    # nbest_encode searches the whole lattice (encode() takes a short cut that misses some best paths)
    assert [x.tolist() for x in Encoder(model).encode(words)] == [sp.nbest_encode(w, nbest_size=2)[0] for w in words]


def test_round_trip(model, texts):
    odd = [" ", "  a  ", "\n", "\t\r\n x", "▁", "a▁b ▁▁ c", "😀 é 漢字", "\x00\x01", "<s> </s> <0x41> <unk>", "a" * 100_000,
           "é" * 70_000 + " b", " " * 5000, "xy " * 50_000, "\ue000"]
    enc = Encoder(model)
    for t, ids in zip(odd + texts, enc.encode(odd + texts)):
        assert decode(model, ids.tolist()) == t
    assert [len(x) for x in enc.encode([None, ""])] == [0, 0]


def test_long_words_are_segmented_by_the_same_rule(model):
    rnd = random.Random(1)
    words = ["▁" + "".join(rnd.choice("etaoin shrdlu".replace(" ", "")) for _ in range(60)) for _ in range(20)]
    assert segment(model, [w[:61] for w in words]) == [model.segment_long(w[:61]) for w in words]
    long = "".join(words).replace("▁", "")
    assert len(long) > 1000 and segment(model, [long])[0] == model.segment_long(long)


def test_columns(llm):
    docs = llm.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (3, "Hello world")], "doc_id long, text string")
    out = docs.select("doc_id", "text", encode_column(docs.text, PATH).alias("ids"))
    out = out.select("*", decode_column(out.ids, PATH).alias("back"))
    rows = out.collect()
    assert [r.back for r in rows] == ["Hello world", "", "", "Hello world"] and rows[0].ids == rows[3].ids and rows[1].ids == []
    assert out.where("false").count() == 0
