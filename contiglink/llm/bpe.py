"""BPE encoding and decoding with a contiguous rank array per word.

A word is held as part boundaries and the ranks of adjacent parts. The least rank is found by a scan, its
boundary is deleted and the two neighbouring ranks are looked up anew, until no pair has a rank. Words of more
than SHORT parts keep the same rule with a heap instead of the scan, so that a text without white space does not
take quadratic time.

Texts are cut at ASCII white space, which no token crosses. A block of texts becomes one Arrow column of such
stretches; each distinct one is encoded (and its ids decoded) once, and the results are gathered for all. A worker
keeps the results of short stretches in a table that is bounded in bytes.

Null texts count as empty: no ids, and the decoded text is empty. Columns other than the id and the text are not
read, so clashing names do no harm; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import blocks, codes_of, word_column

SHORT = 48
KEEP_BYTES = 64 << 20  # of a table and the old one each
KEEP_WORD = 256  # longer entries are not kept
ENTRY = 250  # bytes that an entry of a table takes besides its content
BLOCK = 8 << 20
WHITE = regex.compile(r"\p{White_Space}+")
END = "</w>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Known(dict):
    """A table that works out missing entries, bounded in bytes.

    When it is full it becomes the old one, whose entries come back on use. Long entries are never kept.
    """

    def __init__(self, make: Callable, keep_bytes: int = KEEP_BYTES):
        super().__init__()
        self.make, self.keep_bytes, self.old, self.held = make, keep_bytes, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > KEEP_WORD:
            return
        size = ENTRY + 2 * len(key) + (len(value) if isinstance(value, bytes) else sum(map(len, value)))
        if self.held + size > self.keep_bytes:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        self.held += size

    def all(self, keys: list, make_all: Callable[[list], list]) -> list:
        """The entries of many different keys; those missing are worked out together."""
        out = list(map(self.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        if self.old:
            for i in missing:
                out[i] = self.old.get(keys[i])
            again = [i for i in missing if out[i] is not None]
            missing = [i for i in missing if out[i] is None]
            self.put_all([keys[i] for i in again], [out[i] for i in again])
        if missing:
            new = [keys[i] for i in missing]
            values = make_all(new)
            for i, value in zip(missing, values):
                out[i] = value
            self.put_all(new, values)
        return out

    def put_all(self, keys: list, values: list[bytes], at_once: int = 4096) -> None:
        """put for many entries, whose sizes are added up `at_once` at a time; the table is too large by no more than these."""
        for first in range(0, len(keys), at_once):
            some = {k: v for k, v in zip(keys[first : first + at_once], values[first : first + at_once]) if len(k) <= KEEP_WORD}
            size = ENTRY * len(some) + 2 * sum(map(len, some)) + sum(map(len, some.values()))
            if self.held + size > self.keep_bytes:
                self.old, self.held = dict(self), 0
                self.clear()
            self.update(some)
            self.held += size


def gather(
    texts: pa.Array, results: Callable[[list[bytes]], list[list[bytes]]], most: int = BLOCK, stretches: Callable = word_column
) -> Iterator[tuple[int, list[tuple[memoryview, np.ndarray]]]]:
    """Results of each text's stretches without white space, in a row.

    results: distinct stretches -> lists of byte strings, one for each. Yields the first row of a block of texts and,
    for each list, (bytes, bounds): text first + i has the bytes from bounds[i] to bounds[i + 1]. stretches: a block's
    bytes and offsets -> the column of its stretches, and the first one of each text.
    """
    for first, buf, offsets in blocks(texts, most):
        column, at = stretches(buf, offsets)
        code, distinct = codes_of(column)
        out = []
        for made in results(distinct.to_pylist()):
            taken = pa.array(made, pa.large_binary()).take(pa.array(code))
            _, bounds, data = taken.buffers()
            ends = np.frombuffer(bounds, np.int64)[: len(taken) + 1] if bounds else np.zeros(1, np.int64)
            out.append((memoryview(data or b""), ends[at]))
        yield first, out


def word_spec(path: str) -> dict:
    """A vocabulary file of the kind that WordBpe reads; of another kind: ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"] or spec["model"]["end_of_word_suffix"] != END or spec["decoder"]:
        raise ValueError(f"{path}: not a word-end BPE file with NFC, white space and lower case")
    return spec


class WordBpe:
    """Encoder and decoder for a vocabulary file of the tokenizers library whose words end in `</w>`."""

    def __init__(self, path: str):
        self.path, self.rules = path, None
        spec = word_spec(path)
        splits = spec["pre_tokenizer"]["pretokenizers"]
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): k for k, m in enumerate(spec["model"]["merges"])}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {s: np.uint32(i).tobytes() for s, i in special.items()}
        self.at_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.tokens = [""] * (1 + max([*self.vocab.values(), *special.values()]))
        for s, i in [*self.vocab.items(), *special.items()]:
            self.tokens[i] = s
        self.split = regex.compile(splits[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.letters = byte_alphabet()
        self.pair = {self.vocab[a] << 32 | self.vocab[b]: k for (a, b), k in self.rank.items()}
        self.joined = [0] * (1 + max(self.rank.values(), default=-1))
        for (a, b), k in self.rank.items():
            self.joined[k] = self.vocab[a + b]
        self.id_bytes = [np.uint32(i).astype("<u4").tobytes() for i in range(len(self.tokens))]
        self.token_bytes = [f"{s} ".encode() for s in self.tokens]
        self.words = Known(self.encode_word, KEEP_BYTES // 2)
        self.pieces = Known(self.encode_and_decode, KEEP_BYTES // 2)

    def parts(self, word: str) -> list[int]:
        """Boundaries of the parts of word + `</w>` when no pair has a rank any more."""
        if len(word) > SHORT:
            return self._long_parts(word + END, [*range(len(word)), len(word) + len(END)])
        return [0, *itertools.accumulate(len(self.tokens[i]) for i in self._short_ids([self.vocab[x] for x in [*word[:-1], word[-1:] + END]]))]

    def _short_ids(self, ids: list[int]) -> list[int]:
        """The parts' ids, from those of the letters, of which the last has `</w>`."""
        pair, joined, none = self.pair.get, self.joined, len(self.joined)
        ranks = [pair(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            ids[i] = joined[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pair(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = pair(ids[i - 1] << 32 | ids[i], none)
        return ids

    def _long_parts(self, s: str, bounds: list[int]) -> list[int]:
        n, rank = len(bounds) - 1, self.rank.get
        ends, before = bounds[1:], [*range(-1, n - 1)]  # by start of a part; -1 as an end: merged away
        heap = [(r, a) for a, b, c in zip(bounds, bounds[1:], bounds[2:]) if (r := rank((s[a:b], s[b:c]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, a = heapq.heappop(heap)
            b = ends[a]
            if b < 0 or b >= n or rank((s[a:b], s[b : ends[b]])) != r:
                continue
            ends[a], ends[b] = ends[b], -1
            if (c := ends[a]) < n:
                before[c] = a
                if (r := rank((s[a:c], s[c : ends[c]]))) is not None:
                    heapq.heappush(heap, (r, a))
            if (p := before[a]) >= 0 and (r := rank((s[p:a], s[a:c]))) is not None:
                heapq.heappush(heap, (r, p))
        return [*(a for a in range(n) if ends[a] >= 0), bounds[-1]]

    def encode_word(self, word: bytes) -> tuple[bytes, bytes]:
        """Of one word as the split pattern gives it, in UTF-8: ids as little-endian 32-bit integers, and their text with a space at the end."""
        return self.encode_letters("".join(map(self.letters.__getitem__, word)))

    def encode_letters(self, s: str) -> tuple[bytes, bytes]:
        """encode_word for a word in the byte alphabet."""
        if len(s) > SHORT:
            bounds = self.parts(s)
            s += END
            ids = [self.vocab[s[a:b]] for a, b in zip(bounds, bounds[1:])]
        else:
            vocab = self.vocab
            ids = [vocab[c] for c in s[:-1]]
            ids.append(vocab[s[-1] + END])
            ids = self._short_ids(ids)
        return b"".join([self.id_bytes[i] for i in ids]), b"".join([self.token_bytes[i] for i in ids])

    def encode_and_decode(self, piece: bytes) -> tuple[bytes, bytes]:
        """encode_word for a stretch of text without white space."""
        text = piece.decode("utf-8")
        if self.at_special and "<|" in text:
            both = [self._special(x) if x in self.special else self._plain(x) for x in self.at_special.split(text) if x]
            return b"".join([x[0] for x in both]), b"".join([x[1] for x in both])
        return self._plain(text)

    def _special(self, token: str) -> tuple[bytes, bytes]:
        return self.special[token], f"{token} ".encode()

    def results(self, distinct: list[bytes]) -> list[list[bytes]]:
        both = [self.result(x) for x in distinct]
        return [[x[0] for x in both], [x[1] for x in both]]

    def result(self, piece: bytes) -> tuple[bytes, bytes]:
        """encode_and_decode, kept. ASCII letters are one word and need no splitting, nor do such with a mark or a digit after them."""
        if piece.isalpha():
            return self.words[piece.lower()]
        if piece[:-1].isalpha() and piece[-1] < 128:
            (a, b), (c, d) = self.words[piece[:-1].lower()], self.words[piece[-1:]]
            return a + c, b + d
        return self.pieces[piece]

    def _plain(self, piece: str) -> tuple[bytes, bytes]:
        low = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()  # no final sigma
        if low.isascii() or not UNSURE.search(low) or all(unicodedata.category(c) != "Cn" for c in low):
            both = [self.words[w.encode()] for w in self.split.findall(low)]
        else:
            if self.rules is None:
                from tokenizers import Tokenizer

                self.rules = Tokenizer.from_file(self.path)
            both = [self.encode_letters(w) for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(piece))]
        if len(both) == 1:
            return both[0]
        return b"".join([x[0] for x in both]), b"".join([x[1] for x in both])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(self.result(x.encode("utf-8"))[0] for x in WHITE.split(text) if x)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: Outside the scripts whose letters have long been settled. Code points of a late Unicode version are letters to
#: one library and unassigned to another; the few pieces with such are split by the tokenizers library's own rules.
UNSURE = regex.compile(r"[^\u0000-\u024F\u0370-\u0377\u0384-\u0527\u3040-\u3096\u30A0-\u30FF\u4E00-\u9FCC\uAC00-\uD7A3]")
@functools.lru_cache(1)
def encoder(vocabulary: str) -> WordBpe:
    """One for all tasks of a worker."""
    return WordBpe(vocabulary)


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, decoded: bool = False, digests: bool = False) -> DataFrame:
    """Each row's text encoded: id_col, n_tokens and as asked ids (array<int>), decoded text, and digests of both."""
    fields = [("n_tokens", pa.int64())] + [("ids", pa.list_(pa.int32()))] * ids + [("decoded", pa.string())] * decoded + [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] * digests
    names = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            for first, ((flat, at), (text, to)) in gather(batch.column(1), bpe.results):
                n = len(at) - 1
                out: dict[str, pa.Array] = {"n_tokens": pa.array(np.diff(at) // 4)}
                spans = list(zip(at[:-1].tolist(), at[1:].tolist(), to[:-1].tolist(), (np.maximum(to[1:] - 1, to[:-1])).tolist()))
                if ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(((at - at[0]) // 4).astype(np.int32)), pa.array(np.frombuffer(flat[at[0] : at[-1]], "<i4")))
                if decoded:
                    out["decoded"] = pa.array([str(text[c:d], "utf-8") for _, _, c, d in spans], pa.string())
                if digests:
                    out["ids_sha256"] = pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b, _, _ in spans], pa.string())
                    out["decoded_sha256"] = pa.array([hashlib.sha256(text[c:d]).hexdigest() for _, _, c, d in spans], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *(out[n] for n, _ in fields)], [id_col, *(n for n, _ in fields)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *(f"{n} {names[n]}" for n, _ in fields)]))
