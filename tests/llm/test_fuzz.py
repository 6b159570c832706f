"""Encoders against the library on many odd texts, and on long ones with and without white space."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_llm import VOCAB, docs
from tokenizers import Tokenizer

from contiglink.llm import bpe, token_files

POOL = ["abc", "Hello", "don't", "ΟΔΟΣ", "é", "é", " ", "\n", "\t", " ", "　", "\x1c", "\x85", "中文", "한국", "🙂", "<|endoftext|>", "<|", "|>", "123", "..", "'s", "İ", "ß", "​", "ﬁ", "ạ̈", "\x0b", "ﷺ", "ก็", "ẞ"]


def odd_texts(n=20_000, seed=7):
    r = random.Random(seed)
    letter = lambda: chr(r.choice([r.randrange(1, 0x250), r.randrange(0x250, 0x3000), r.randrange(0x3000, 0xD7FF), r.randrange(0xE000, 0x11000), r.randrange(0x1F000, 0x1FB00)]))
    return ["".join(r.choice(POOL) if r.random() < 0.8 else letter() for _ in range(r.randrange(0, 10))) for _ in range(n)]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(VOCAB)


def test_ids_equal_the_library(lib):
    texts = odd_texts()
    want = [e.ids for e in lib.encode_batch_fast(texts, add_special_tokens=False)]
    own, by_library = bpe.WordBpe(VOCAB), token_files.library_encoder(VOCAB)
    own.pieces.keep_bytes = own.words.keep_bytes = 1 << 18  # tables that overflow
    for first, ((flat, at), (back, to)) in bpe.gather(pa.array(texts), own.results, 1 << 14):
        for i in range(len(at) - 1):
            assert np.frombuffer(flat[at[i] : at[i + 1]], "<u4").tolist() == want[first + i], texts[first + i]
            assert str(back[to[i] : max(to[i], to[i + 1] - 1)], "utf-8") == lib.decode(want[first + i], skip_special_tokens=False)
    for first, ((flat, at),) in bpe.gather(pa.array(texts), by_library, 1 << 14, by_library.stretches):
        for i in range(len(at) - 1):
            assert np.frombuffer(flat[at[i] : at[i + 1]], "<u4").tolist() == want[first + i], texts[first + i]


def test_finer_cuts_keep_the_ids(lib):
    """Capitals, marks, combining characters and contractions, in blocks without the names of added tokens."""
    r = random.Random(12)
    pool = [*"aZéÉßñ×÷'’.,-=<>|#%1٣²", "'S", "'ll", "\u0301", "\u0331", "\u0338", "H", "İ", "Σ", "ǅ", "क़", " ", "\n", "\t", "\u00a0", "\u2003", "don't", "中", "\x00", "\x01"]
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(0, 14))).replace("<|", "<") for _ in range(20_000)]
    encode = token_files.library_encoder(VOCAB)
    assert encode.by_words and encode.stretches is token_files.cut_words
    want = [e.ids for e in lib.encode_batch_fast(texts, add_special_tokens=False)]
    for first, ((flat, at),) in bpe.gather(pa.array(texts), encode, 1 << 14, encode.stretches):
        for i in range(len(at) - 1):
            assert np.frombuffer(flat[at[i] : at[i + 1]], "<u4").tolist() == want[first + i], texts[first + i]


def test_tables_are_bounded_in_bytes():
    made = []
    known = bpe.Known(lambda k: made.append(k) or b"x" * 10, keep_bytes=5000)
    for k in range(1000):
        assert known[f"w{k}"] == b"x" * 10
    assert len(known) + len(known.old) < 40 and known["y" * 1000] and "y" * 1000 not in known
    assert known.all([f"w{k}" for k in range(998, 1003)], lambda ks: [b"x" * 10 for _ in ks]) == [b"x" * 10] * 5


def test_long_texts(spark, lib):
    r = random.Random(2)
    letters = "".join(r.choice("aeiourst") for _ in range(5_000_000))
    texts = [" ".join(letters[k : k + 7] for k in range(0, len(letters), 7)), letters]
    want = [len(e.ids) for e in lib.encode_batch_fast(texts[:1], add_special_tokens=False)]
    got = {x.doc_id: x.n_tokens for x in bpe.encode_texts(docs(spark, texts), VOCAB, ids=False, digests=True).collect()}
    assert got[0] == want[0] and 0 < got[1] < len(letters)
    files = {x.doc_id: x.n_tokens for x in token_files.token_files(docs(spark, texts[:1]), VOCAB).collect()}
    assert files[0] == want[0] + 1
