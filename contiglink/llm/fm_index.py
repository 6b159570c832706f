"""Benchmark decontamination with an FM-index per training shard.

Words are maximal stretches of ASCII letters (lowered) and digits and of all characters from U+0080. A benchmark
item's phrases are its windows of 10 consecutive words, or the item itself if it is shorter. A shard is a few
megabytes of documents, at most SHARD_WORDS words; a longer text goes on in the next shard, which starts some words
earlier, so that no phrase is cut. All its words are indexed: the suffix array gives the Burrows-Wheeler transform,
kept as a wavelet matrix over bit vectors with block counts. The phrases search backward together, one word a step;
occurrences are located by walking to a sampled suffix position, and overlapping ones merge into removal spans.
Words are compared by their bytes throughout, never by hashes.

The benchmark is written to the shared folder in slices of bounded size; a shard is indexed once and takes one slice
after the other, of which a task holds HOLD_BYTES at most, so nothing that grows is broadcast. Work on documents
needs no shuffle at all. Null texts and texts without words have no words and no hits. Items without words have no
phrases; repeated items or ids count once. Items with a null id are searched like all others: their hits count, but
no item is named for them (n_items). Repeated documents give repeated rows; empty tables give empty or hit-free
results. Only ids and texts are read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, read_file, write_file
from .hashing import LOWER, blocks, codes_of, slices as shards, word_column

WINDOW = 10
SAMPLE = 16
SHARD_BYTES = 4 << 20
SHARD_WORDS = 1_000_000
HOLD_BYTES = 64 << 20  # of phrase slices
SLICE_BYTES = 8 << 20  # of benchmark text
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The texts' words in a row, each by its place among the distinct ones; where each text's words start; the distinct ones."""
    for _, buf, offsets in blocks(texts, 1 << 62):
        column, at = word_column(LOWER[buf], offsets, LETTERS)
        code, distinct = codes_of(column)
        return code, at, distinct
    return np.zeros(0, np.int32), np.zeros(1, np.int64), pa.array([], pa.large_binary())


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of text in order. Symbol 0 is a separator; separators differ, those further left being smaller."""
    n = len(text)
    gaps = text == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, text + int(gaps.sum())).astype(np.int64)
    bits = int(max(int(rank.max(initial=0)), n) + 1).bit_length()
    take = min(3, 62 // bits)

    def keys(at: np.ndarray, h: int) -> np.ndarray:
        out = rank[at] + 1
        for k in range(1, take):
            q = at + k * h
            out = out << bits | np.where(q < n, rank[np.minimum(q, n - 1)] + 1, 0)
        return out

    order, h = np.arange(n), 1
    todo = np.arange(n)  # places in order that are not settled
    while len(todo):
        at = order[todo]
        key = keys(at, h)
        # members of a group lie together and share the rank, which leads the key: sorting keeps groups in place
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[todo] = at
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        first = todo[np.flatnonzero(new)][np.cumsum(new) - 1]  # a group's rank: its first place
        rank[at] = first
        last = np.ones(len(todo), bool)
        last[:-1] = new[1:]
        todo = todo[~(new & last)]
        h *= take
    return order


class Bits:
    """A bit vector with the number of set bits before each block of 64."""

    def __init__(self, bit: np.ndarray):
        padded = np.zeros(len(bit) // 64 * 8 + 8, np.uint8)
        packed = np.packbits(bit, bitorder="little")
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.total = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        k = i >> 6
        return self.before[k] + np.bitwise_count(self.words[k] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of symbols in a sequence, a level for each bit from the top."""

    def __init__(self, values: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits, self.zeros = [], []
        values = values.astype(np.int32)
        for b in range(self.levels - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(len(values) - self.bits[-1].total)
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c[k] stands before place i[k]."""
        low, i = np.zeros_like(i), i.copy()
        for level, bits in enumerate(self.bits):
            one = (c >> (self.levels - 1 - level) & 1).astype(bool)
            under, upto = bits.rank(low), bits.rank(i)
            low = np.where(one, self.zeros[level] + under, low - under)
            i = np.where(one, self.zeros[level] + upto, i - upto)
        return i - low

    def at(self, i: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        c, i = np.zeros(len(i), np.int64), i.copy()
        for level, bits in enumerate(self.bits):
            one, upto = bits.at(i), bits.rank(i)
            c = c << 1 | one
            i = np.where(one, self.zeros[level] + upto, i - upto)
        return c


class FmIndex:
    """An index of a text of symbols 0 (separator) to size - 1; the text starts and ends with separators."""

    def __init__(self, text: np.ndarray, size: int):
        sa = suffix_array(text)
        self.bwt = WaveletMatrix(text[sa - 1], size)
        self.first = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(text, minlength=size))])
        run = np.arange(len(text))
        start = np.maximum.accumulate(np.where(text == 0, run, 0)) + 1  # of the stretch between separators
        kept = ((run - start) % SAMPLE == 0)[sa]
        self.kept = kept
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
        self.samples = sa[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each phrase (a row of symbols)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.first[-1])
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k]
            low[live] = self.first[c] + self.bwt.rank(c, low[live])
            high[live] = self.first[c] + self.bwt.rank(c, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the rows."""
        out, steps, live, rows = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(live):
            now = rows[live]
            done = self.kept[now]
            out[live[done]] = self.samples[self.before[now[done]]] + steps
            live, now = live[~done], now[~done]
            c = self.bwt.at(now)
            rows[live] = self.first[c] + self.bwt.rank(c, now)
            steps += 1
        return out


def write_phrases(benchmark: DataFrame, folder: str, window: int = WINDOW, slice_bytes: int = SLICE_BYTES, id_col: str = "item_id", text_col: str = "text") -> tuple[list[str], int]:
    """Write the items' phrases in slices of at most slice_bytes of text, or of one item; the files' names, few for any benchmark, and the longest phrase's words.

    A slice has its items' words in a row, and of each distinct phrase where it first starts and which items have it.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col))
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in shards(batch, 1, slice_bytes):
                ids, at, distinct = coded_words(rows.column(1))
                phrases: dict[int, dict[tuple, tuple[int, set]]] = {}
                names: dict[str, int] = {}
                for item, a, b in zip(rows.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    n = min(window, b - a)
                    own = ids[a:b].tolist()
                    for k in range(b - a - n + 1) if n else ():
                        phrases.setdefault(n, {}).setdefault(tuple(own[k : k + n]), (a + k, set()))[1].update(() if item is None else (names.setdefault(item, len(names)),))
                if not phrases:
                    continue
                out = {"words": ids.astype(np.int32), "sizes": np.array(sorted(phrases))}
                for label, texts in (("vocab", distinct.to_pylist()), ("names", [x.encode("utf-8") for x in names])):
                    out[label], out[f"{label}_at"] = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
                for n, found in phrases.items():
                    out[f"p{n}"] = np.array([start for start, _ in found.values()], np.int64)
                    out[f"n{n}"] = np.array([len(x) for _, x in found.values()])
                    out[f"i{n}"] = np.array([y for _, x in found.values() for y in sorted(x)], np.int32)
                data = io.BytesIO()
                np.savez(data, **out)
                write_file(file := f"{folder}/slice-{part:05d}-{piece:05d}.npz", data.getvalue())
                piece += 1
                yield pa.RecordBatch.from_pydict({"file": [file], "longest": pa.array([max(phrases)], pa.int32())})

    told = items.repartition(max(1, -(-size // slice_bytes))).mapInArrow(run, "file string, longest int").collect()
    return [r.file for r in told], max((r.longest for r in told), default=1)


class Shard:
    """The index of consecutive words of some texts, with a separator between texts."""

    def __init__(self, codes: np.ndarray, text_of: np.ndarray, distinct: pa.Array):
        turn = np.zeros(len(codes), np.int64)
        turn[1:] = text_of[1:] != text_of[:-1]
        place = np.arange(len(codes)) + 1 + np.cumsum(turn)
        text, self.word = (np.zeros(int(place[-1]) + 2, np.int64) for _ in range(2))
        text[place], self.word[place] = codes + 1, np.arange(len(codes))
        self.index, self.distinct = FmIndex(text, len(distinct) + 1), distinct

    def find(self, part: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of a slice's phrases, by size: the size, and the phrase and the first word of each occurrence."""
        bounds, data = part["vocab_at"].astype(np.int64), part["vocab"]
        vocab = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        symbol = pc.fill_null(pc.index_in(vocab, value_set=self.distinct), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        for n in part["sizes"].tolist():
            phrases = symbol[part["words"]][part[f"p{n}"][:, None] + np.arange(n)]
            whole = np.flatnonzero((phrases > 0).all(1))  # all words stand in the shard
            low, high = self.index.search(phrases[whole])
            many = high - low
            which = np.repeat(np.arange(len(whole)), many)
            if len(which):
                rows = np.repeat(low, many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                yield n, whole[which], self.word[self.index.locate(rows)]


class Slices:
    """The phrase slices, of which some are held in memory."""

    def __init__(self, files: list[str], longest: int, hold_bytes: int = HOLD_BYTES):
        self.files, self.longest, self.held, self.room = files, longest, {}, hold_bytes

    def read(self, file: str) -> dict[str, np.ndarray]:
        if file in self.held:
            return self.held[file]
        with np.load(io.BytesIO(read_file(file))) as got:
            part = dict(got)
        size = sum(x.nbytes for x in part.values())
        if size <= self.room:
            self.room -= size
            self.held[file] = part
        return part

    def hits(self, texts: pa.Array, shard_words: int = SHARD_WORDS) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """Where each text's words start, whether each word is hit, and each text's items."""
        codes, at, distinct = coded_words(texts)
        items: list[set[str]] = [set() for _ in range(len(texts))]
        edge = np.zeros(len(codes) + 1, np.int64)
        text_of = np.repeat(np.arange(len(texts)), np.diff(at))
        for first in range(0, len(codes) if self.files else 0, shard_words):
            last = first + shard_words + self.longest - 1
            shard = Shard(codes[first:last], text_of[first:last], distinct)
            for file in self.files:
                part = self.read(file)
                for n, which, word in shard.find(part):
                    np.add.at(edge, first + word, 1)
                    np.add.at(edge, first + word + n, -1)
                    own, ends = part[f"i{n}"], np.cumsum(part[f"n{n}"])
                    starts = ends - part[f"n{n}"]
                    for key in np.unique(text_of[first + word] * len(starts) + which).tolist():
                        d, p = divmod(key, len(starts))
                        items[d].update(part["names"][k:m].tobytes().decode("utf-8") for k, m in zip(part["names_at"][own[starts[p] : ends[p]]], part["names_at"][own[starts[p] : ends[p]] + 1]))
        return at, np.cumsum(edge)[:-1] > 0, items


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark phrase."""
    files, longest = write_phrases(benchmark, fresh_path(docs.sparkSession, "phrases"), window, slice_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = Slices(files, longest)
        for batch in (s for b in batches for s in shards(b, b.schema.get_field_index(text_col), SHARD_BYTES)):
            at, hit, _ = slices.hits(batch.column(batch.schema.get_field_index(text_col)))
            total = np.concatenate([np.zeros(1, np.int64), np.cumsum(hit)])
            yield batch.filter(pa.array(total[at[1:]] == total[at[:-1]]))

    return docs.mapInArrow(run, docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Each document's id, n_words, n_hit, n_items, items_sha256, contaminated, and spans: removal spans of word numbers."""
    files, longest = write_phrases(benchmark, fresh_path(docs.sparkSession, "phrases"), window, slice_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = Slices(files, longest)
        for batch in (s for b in batches for s in shards(b, 1, SHARD_BYTES)):
            n = batch.num_rows
            at, hit, items = slices.hits(batch.column(1))
            total = np.concatenate([np.zeros(1, np.int64), np.cumsum(hit)])
            n_hit = total[at[1:]] - total[at[:-1]]
            spans: list[list] = [[] for _ in range(n)]
            for d in np.flatnonzero(n_hit).tolist():
                own = np.concatenate([[0], hit[at[d] : at[d + 1]].astype(np.int8), [0]])
                turn = np.diff(own)
                spans[d] = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist())]
            digests = [hashlib.sha256(",".join(sorted(x)).encode("utf-8")).hexdigest() for x in items]
            cols = [batch.column(0), pa.array(np.diff(at)), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()), pa.array(n_hit > 0), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,end:long>>")
