"""Stretches of letters, alone or before one mark, are encoded without the split pattern and kept once; results are the library's."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from contiglink.llm import bpe

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def test_single_words_are_not_split():
    own, r = bpe.WordBpe(VOCAB), random.Random(4)
    library = Tokenizer.from_file(VOCAB)
    words = ["".join(r.choice("abcdefghinorstuABCXYZ") for _ in range(r.choice([1, 2, 5, 9, 48, 49, 90]))) for _ in range(400)]
    pieces = [w + m for w in words for m in ("", r.choice([chr(k) for k in range(128) if not chr(k).isalpha() and not bpe.WHITE.match(chr(k)) and chr(k) not in "\x1c\x1d\x1e\x1f"]))]
    ids, texts = own.results([p.encode() for p in pieces])
    assert not own.pieces and not own.pieces.old
    for p, i, t in zip(pieces, ids, texts):
        want = library.encode(p, add_special_tokens=False).ids
        assert np.frombuffer(i, "<u4").tolist() == want, p
        assert t.decode() == library.decode(want, skip_special_tokens=False) + " ", p


def test_other_pieces_equal_the_library():
    own, library, r = bpe.WordBpe(VOCAB), Tokenizer.from_file(VOCAB), random.Random(5)
    tokens = ["<|endoftext|>", "<|", "'s", "'ll", "é", "Σ", "ß", "漢字", " ", "12", "a", "Ab", ".", "...", "́", "\U0001f600"]
    for _ in range(3000):
        p = "".join(r.choice(tokens) for _ in range(r.randrange(1, 7)))
        ids, texts = own.results([p.encode()])
        want = library.encode(p, add_special_tokens=False).ids
        assert np.frombuffer(ids[0], "<u4").tolist() == want, p
        assert texts[0].decode() == (library.decode(want, skip_special_tokens=False) + " " if want else ""), p
