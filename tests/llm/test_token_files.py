import os
import random
import time
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickstream.llm import token_files as TF
from clickstream.llm.token_coder import BLOCK, decode_blocks, encode_blocks
from clickstream.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(blocks):
    coded = encode_blocks(blocks)
    return decode_blocks([x for x, _ in coded], [len(b) for b in blocks], [c for _, c in coded])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=60), min_size=1, max_size=5))
def test_coder_round_trip(blocks):
    blocks = [np.array(b, np.int64) for b in blocks]
    assert all((a == b).all() for a, b in zip(blocks, round_trip(blocks)))


def test_coder_long_blocks_and_compression():
    rng = np.random.default_rng(3)
    text = np.tile(rng.integers(0, 50257, 50), BLOCK // 50)
    skewed = np.minimum(rng.zipf(1.4, BLOCK), 50000)
    blocks = [text, skewed, rng.integers(0, 65536, BLOCK), np.zeros(BLOCK, int), np.full(BLOCK, 65535)]
    assert all((a == b).all() for a, b in zip(blocks, round_trip(blocks)))
    size = [len(x) for x, _ in encode_blocks(blocks)]
    assert size[0] < 0.2 * 2 * BLOCK and size[1] < 0.7 * 2 * BLOCK and size[2] < 1.2 * 2 * BLOCK and size[3] < 600


def test_blocks_are_independent_and_checked():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 300, n) for n in (500, 40, 3)]
    alone = [encode_blocks([b])[0] for b in blocks]
    assert alone == encode_blocks(blocks)
    payload, check = alone[0]
    with pytest.raises(ValueError):
        decode_blocks([payload[:20] + bytes([payload[20] ^ 1]) + payload[21:]], [500], [check])
    for bad in ([2**32], [-1], [1] * (BLOCK + 1)):
        with pytest.raises(ValueError):
            encode_blocks([np.array(bad)])


def test_rich_alphabets_round_trip():
    rng = np.random.default_rng(9)
    blocks = [rng.permutation(BLOCK) * 7, rng.integers(0, 2**32, BLOCK), np.arange(BLOCK), np.array([], int), np.array([2**32 - 1]),
              np.repeat(np.arange(64), 64), rng.integers(0, 33, 1000), rng.integers(0, 32, 1000)]
    assert all((a == b).all() for a, b in zip(blocks, round_trip(blocks)))


def test_bits_an_id_of_the_documents():
    """Below 8.5 bits an id in blocks of 4096 (a plain adaptive order-0 count model takes 8.59 there)."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")["text"].to_pylist()
    ids, _ = TF.Tokenizer(PATH, public_tokenizers.PATTERN).encode(texts, 2)
    coded = encode_blocks([ids[a:a + BLOCK] for a in range(0, len(ids), BLOCK)])
    assert 8 * sum(len(x) for x, _ in coded) < 8.5 * len(ids)


def test_same_ids_as_the_library():
    lib = Tokenizer.from_file(PATH)
    texts = ["Hello  world\n\n  it's 42!", None, "", " ", "a b 漢字 <|endoftext|> x", "tab\t\t x\r\n", "é" * 3000, "x" * 100_000]
    ids, counts = TF.Tokenizer(PATH, public_tokenizers.PATTERN).encode(texts, 2)
    want = [e.ids + [2] for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def brute(rows):
    lib = Tokenizer.from_file(PATH)
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_round_trip(llm):
    rnd = random.Random(8)
    rows = [(rnd.randint(0, 500), " ".join(rnd.choice(["the", "river", "été", "42", "\n", "Zx"]) for _ in range(rnd.randint(0, 400))))
            for _ in range(150)]
    rows += [(7, None), (8, ""), (9, "word " * 12_000), (None, "no id"), (600, "x" * 40_000), (7, "again"), (7, "again")]
    docs = llm.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    for size in (1 << 30, 30_000):
        path = scratch_path(llm, f"token-test-{uuid.uuid4().hex}")
        TF.write_token_files(docs, path, PATH, public_tokenizers.PATTERN, 2, shard_bytes=size)
        got = sorted((tuple(r) for r in TF.read_token_files(llm, path).collect()), key=lambda r: r[1])
        assert got == brute(rows)


def test_empty_table(llm):
    path = scratch_path(llm, f"token-test-{uuid.uuid4().hex}")
    TF.write_token_files(llm.createDataFrame([], "doc_id long, text string"), path, PATH, public_tokenizers.PATTERN, 2)
    assert TF.read_token_files(llm, path).count() == 0
    assert os.path.isdir(path)


def test_added_tokens_get_the_ids_of_the_default_call(llm):
    lib = Tokenizer.from_file(PATH)
    texts = ["a b <|endoftext|> x", "<|endoftext|>", "<|endoftext|><|endoftext|>  \n", "x  <|endoftext|>", "<|endoftext |> a",
             "plain  words\n\n", "a <|endoftext|>\n\n<|endoftext|>'s  b ", ""]
    want = [e.ids + [2] for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 275, 220, 50256, 2124, 2]
    ids, counts = TF.Tokenizer(PATH, public_tokenizers.PATTERN, special_text=False).encode(texts, 2)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    path = scratch_path(llm, f"token-test-{uuid.uuid4().hex}")
    TF.write_token_files(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, PATH,
                         public_tokenizers.PATTERN, 2)
    got = sorted(tuple(r) for r in TF.read_token_files(llm, path).collect())
    starts = np.cumsum([0, *map(len, want)]).tolist()
    assert got == [(i, starts[i], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(want)]


ODD = ["'", "'", "s", "t", "re", "ve", "ll", "m", "d", " ", " ", "  ", "\n", "\t", " ", "　", " ", "\x1c", "\x85", "a", "Z", "é", "漢",
       "字", "1", "٣", "½", "!", "_", "😀", "́", "𝒳", "﻿", "\0", "<|endoftext|>", "<|endof", "text|>"]
#: Letters of later Unicode versions than the tokenizer library's.
LATER = ["\u0558", "\u208f", "\U000107bb"]


def odd_texts(seed, n=3000, signs=ODD):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 14))) if i % 50 else None for i in range(n)]
    return texts + ["x" * 300 + " " + "漢" * 100 + "'s", *("ab" * 30 + "c" * k for k in range(12)), "'", "'s", " 's", "a 's", "!'s", "\n's", " "]


def check_against_the_library(tok, texts):
    lib = Tokenizer.from_file(PATH)
    ids, counts = tok.encode(texts, 2)
    want = [e.ids + [2] for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_cuts_by_class_and_by_pattern():
    by_class = TF.Tokenizer(PATH, public_tokenizers.PATTERN)
    by_pattern = TF.Tokenizer(PATH, public_tokenizers.PATTERN + "|(?!)")
    assert by_class.direct and not by_pattern.by_class
    for seed in range(3):
        for tok in (by_class, by_pattern):
            check_against_the_library(tok, odd_texts(seed))
    check_against_the_library(by_class, odd_texts(7, signs=ODD + 3 * LATER))  # classes are the library's (before: regex's)
    assert [x.tolist() for x in by_class.encode([], 2)] == [[], []]


def test_cuts_of_one_hash_are_told_apart(monkeypatch):
    for name in ("_MIX1", "_MIX2", "_MIX3"):
        monkeypatch.setattr(TF, name, np.uint64(0))
    check_against_the_library(TF.Tokenizer(PATH, public_tokenizers.PATTERN), odd_texts(5, 60))


def test_full_memory_begins_anew(monkeypatch):
    monkeypatch.setattr(TF, "MEMORY_CUTS", 50)
    tok = TF.Tokenizer(PATH, public_tokenizers.PATTERN)
    for seed in range(4):
        check_against_the_library(tok, odd_texts(seed, 200))
    many = TF.Tokenizer(PATH, public_tokenizers.PATTERN)
    check_against_the_library(many, [f"w{i * 7919:x}q{i}" + "z" * (i % 40) for i in range(60_000)])  # the table grows


def test_bytes_that_are_no_text_raise():
    tok = TF.Tokenizer(PATH, public_tokenizers.PATTERN)
    with pytest.raises(UnicodeDecodeError):
        tok.encode(TF.pa.array([b"abc \xff\xfe"]).view(TF.pa.string()).cast(TF.pa.large_string()), 2)


def test_a_worker_remembers_cuts_from_task_to_task():
    a = TF._tokenizer(PATH, public_tokenizers.PATTERN, False)
    assert TF._tokenizer(PATH, public_tokenizers.PATTERN, False) is a
    assert TF._tokenizer(PATH, public_tokenizers.PATTERN, True) is not a


def test_known_cuts_cost_less_than_the_pattern():
    """Texts of known cuts take less CPU time than running the pattern over them (before: the pattern was run over every text)."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(5000)]
    texts = [" ".join(rnd.choices(words, k=500)) for _ in range(600)]
    tok = TF.Tokenizer(PATH, public_tokenizers.PATTERN)
    tok.encode(texts, 2)

    def cost(f):
        took = []
        for _ in range(3):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)
    assert cost(lambda: tok.encode(texts, 2)) < cost(lambda: [tok.findall(t) for t in texts])


def test_counts_still_to_come_cost_less_than_counts_so_far():
    """A block of ids that all occur once ends with a known id; ids of one block cost about the logarithm of what is left."""
    rng = np.random.default_rng(1)
    ids = rng.permutation(np.arange(BLOCK))
    (payload, check), = encode_blocks([ids])
    bits = sum(np.log2(np.arange(1, BLOCK + 1)))
    assert 8 * len(payload) < 1.1 * bits + 8 * 1600 and (decode_blocks([payload], [BLOCK], [check])[0] == ids).all()


def test_damaged_blocks_raise():
    rng = np.random.default_rng(6)
    ids = np.minimum(rng.zipf(1.3, 2000), 60000)
    (payload, check), = encode_blocks([ids])
    for at in range(0, len(payload), 37):
        for bad in (payload[:at] + bytes([payload[at] ^ 0x55]) + payload[at + 1:], payload[:at]):
            with pytest.raises(ValueError):
                decode_blocks([bad], [2000], [check])
