"""Token-id files: a concatenated id array with Elias-Fano document boundaries.

One file holds the ids of consecutive documents, 2 or 4 bytes an id, after two Elias-Fano sequences: the document
ids (ascending, less the least) and the running id counts at which documents start and end. An Elias-Fano
sequence keeps the low bits of each value packed and the high bits in unary; select(i) finds the i-th set bit
from a sampled directory, so offsets come from near-minimal space without a table of 64-bit integers.

Rows are range-partitioned by id, so files follow each other in ascending order and a document's global start is
the sum of the files before it plus its start in its file. Rows without an id come first. Null texts are empty
documents: they hold the end id alone. Repeated ids stay as repeated entries, ordered by text; their rows are dealt
to tasks by the start of the text too, so only copies of one row stay together. Reading back takes documents in
blocks, whose offsets are selected through the directory. An empty table gives no file and an empty result.

Ids are held as wide as in the file, a block of texts in one array, and written without joining them. The manifest is
one small file that one task writes, and a task reads as many files as make READ_IDS: where Spark's writers start a
process for each file (a local folder's permissions), many tasks with tiny files would start as many.
"""

from __future__ import annotations

import functools
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import END, KEEP_WORD, UNSURE, Known, gather, word_spec
from .common import fresh_path, read_file, staged, write_file
from .hashing import WORD, word_column, words

MAGIC = b"IDS1"
STEP = 256  # a directory entry for so many set bits
FILE_IDS = 1 << 24  # ids in a file at most, but for one longer document
READ_DOCS = 4096  # documents whose offsets are selected at once
READ_IDS = 1 << 22  # ids that a task reads at least, if there are so many
RANGE_CHARS = 64  # characters of a text by which the rows of one id are dealt to tasks


class EliasFano:
    """A non-decreasing sequence of integers from 0."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        marks = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(marks[-1]) + 1 if n else 0), np.uint8)
        high[marks] = 1
        low = np.zeros((n, bits), np.uint8)
        for b in range(bits):
            low[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), marks[::STEP].astype("<u4"))

    def tobytes(self) -> bytes:
        return struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.directory.tobytes()

    @classmethod
    def frombytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, bits, n_low, n_high = struct.unpack_from("<QBQQ", data)
        at = 25
        low, at = np.frombuffer(data, np.uint8, n_low, at), at + n_low
        high, at = np.frombuffer(data, np.uint8, n_high, at), at + n_high
        k = -(-n // STEP)
        return cls(n, bits, low, high, np.frombuffer(data, "<u4", k, at)), at + 4 * k

    def select(self, i: int) -> int:
        """Place of the i-th set bit of the high part."""
        at = int(self.directory[i // STEP])
        left, byte = i % STEP, at >> 3
        window = self.high[byte : byte + 64].copy()
        window[0] &= 0xFF << (at & 7) & 0xFF
        while True:
            ones = np.cumsum(np.bitwise_count(window))
            if ones[-1] > left:
                k = int(np.searchsorted(ones, left, side="right"))
                left -= int(ones[k - 1]) if k else 0
                return 8 * (byte + k) + int(np.flatnonzero(np.unpackbits(window[k : k + 1], bitorder="little"))[left])
            left -= int(ones[-1])
            byte += len(window)
            window = self.high[byte : byte + 64]

    def __getitem__(self, i: int) -> int:
        value, at = self.select(i) - i, i * self.low_bits
        for b in range(self.low_bits - 1, -1, -1):
            value = value << 1 | int(self.low[(at + b) >> 3]) >> ((at + b) & 7) & 1
        return value

    def slice(self, i: int, j: int) -> np.ndarray:
        """Values i to j - 1: select finds the first one's directory entry, and no bits beyond the last one's are unpacked."""
        j = min(j, self.n)
        if i >= j:
            return np.zeros(0, np.int64)
        first, last = i // STEP, -(-j // STEP)
        at, end = int(self.directory[first]), int(self.directory[last]) if last < len(self.directory) else 8 * len(self.high)
        marks = np.flatnonzero(np.unpackbits(self.high[at >> 3 : (end + 7) >> 3], bitorder="little")) + (at & ~7)
        out = marks[marks >= at][i - first * STEP :][: j - i] - np.arange(i, j) << self.low_bits
        a, b = i * self.low_bits, j * self.low_bits
        low = np.unpackbits(self.low[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 :][: b - a].reshape(j - i, self.low_bits)
        for k in range(self.low_bits):
            out |= low[:, k].astype(np.int64) << k
        return out


def pack(doc_ids: list[int | None], sizes: list[int], ids: list[np.ndarray], width: int) -> list[bytes | memoryview]:
    """A file's bytes in pieces. doc_ids ascend, those that are None first; sizes: each one's ids; ids: all of them in a row, as wide as in the file."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    head = MAGIC, struct.pack("<BQq", width, len(doc_ids) - len(known), least), EliasFano.of(known - least).tobytes(), EliasFano.of(np.cumsum([0, *sizes])).tobytes()
    return [*head, *(x.data for x in ids)]


class TokenFile:
    """A file's documents: doc_id(i), span(i) in ids, ids(i); of documents i to j - 1: doc_ids(i, j), bounds(i, j)."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        view = memoryview(data)
        self.width, self.nulls, self.least = struct.unpack_from("<BQq", view, 4)
        at = 21
        self.names, k = EliasFano.frombytes(view[at:])
        self.ends, m = EliasFano.frombytes(view[at + k :])
        self.flat = np.frombuffer(view, f"<u{self.width}", -1, at + k + m)

    def __len__(self) -> int:
        return self.nulls + self.names.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.names[i - self.nulls] + self.least

    def span(self, i: int) -> tuple[int, int]:
        return self.ends[i], self.ends[i + 1]

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        known = self.names.slice(max(0, i - self.nulls), max(0, j - self.nulls)) + self.least
        return [None] * (j - i - len(known)) + known.tolist()

    def bounds(self, i: int, j: int) -> np.ndarray:
        """Where the documents start, and where the last one ends."""
        return self.ends.slice(i, j + 1)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.flat[a:b]


#: Bytes by kind: ASCII letters, and ASCII marks that are neither letters, digits, white space nor control characters.
LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def cut_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """word_column of bytes whose A-Z are lower-cased, with further cuts between a letter and an ASCII mark after it.

    A letter ends a word of the split pattern there wherever that word began, so the ids stay the same. Letters are
    ASCII's and those from U+00C0 to U+00FF. A capital stays before a character that might combine with it, and a block
    that holds the start of an added token's name is left as it is.
    """
    if not len(buf) or b"<|" in buf.tobytes():
        return word_column(buf, offsets)
    low = np.where((buf >= 65) & (buf <= 90) & (np.append(buf[1:], np.uint8(0)) < 0xCC), buf + np.uint8(32), buf)
    letter = LETTER[buf]
    letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    begins = np.zeros(len(buf), bool)
    begins[words(low, offsets)[0]] = True
    begins[1:] |= letter[:-1] & MARK[buf[1:]]
    starts = np.flatnonzero(begins)
    kept = WORD[low]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
    bounds = np.append(before[starts], before[-1])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(low[kept])])
    return column, np.searchsorted(starts, offsets)


def one_word(s: str) -> bool:
    """Whether a stretch is letters alone, for the split pattern too once it is normalized."""
    return s.isalpha() and (s.isascii() or ((low := s.lower()).isalpha() and unicodedata.is_normalized("NFC", low) and not UNSURE.search(low)))


class LibraryEncoder:
    """Stretches without white space -> their ids as little-endian 32-bit integers, by the tokenizers library.

    The vocabulary's split pattern never crosses white space, so a text's ids are those of its stretches in a row.
    A table bounded in bytes keeps the results for all tasks of the worker. size is the number of ids; stretches cuts
    a block as `gather` asks for.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = t = Tokenizer.from_file(vocabulary)
        t.no_truncation()
        t.no_padding()
        self.size = t.get_vocab_size(with_added_tokens=True)
        self.special = next(((x.content, i) for i, x in sorted(t.get_added_tokens_decoder().items())), None)
        self.known = Known(self.one)
        # whether words are lower-cased, letters or marks, and their last id is marked
        self.by_words = word_ends(vocabulary)
        self.ends = np.zeros(1 + max(t.get_vocab().values()), bool)
        if self.by_words:
            self.ends[[i for x, i in t.get_vocab().items() if x.endswith(END)]] = True
        self.stretches = cut_words if self.by_words else word_column

    def __call__(self, distinct: list[bytes]) -> list[list[bytes]]:
        return [self.known.all(distinct, self.many)]

    def one(self, s: bytes) -> bytes:
        return self.ids(s.decode("utf-8")).tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def many(self, rows: list[bytes]) -> list[bytes]:
        """All in two calls: stretches of one word, line by line, whose ids are cut where words end, and the others."""
        texts = [x.decode("utf-8") for x in rows]
        done: dict[bytes, bytes] = {}
        if self.by_words:
            plain = [k for k, s in enumerate(texts) if one_word(s) and len(s) <= KEEP_WORD]
            ids = self.ids("\n".join([texts[k] for k in plain]))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain):
                done = dict(zip([rows[k] for k in plain], cut_bytes(ids, np.append(0, cuts[:-1]), cuts)))
        if self.special is not None:
            mark = self.special[0]
            mixed = [k for k, s in enumerate(texts) if rows[k] not in done and mark not in s and len(s) <= KEEP_WORD]
            ids = self.ids(mark.join([texts[k] for k in mixed]))
            cuts = np.flatnonzero(ids == self.special[1])
            if len(cuts) == max(0, len(mixed) - 1):
                done |= zip([rows[k] for k in mixed], cut_bytes(ids, np.append(0, cuts + 1), np.append(cuts, len(ids))))
        return [done[x] if x in done else self.one(x) for x in rows]


def cut_bytes(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    flat = ids.tobytes()
    return [flat[a:b] for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]


def word_ends(vocabulary: str) -> bool:
    """Whether a file of the tokenizers library is one that WordBpe knows."""
    try:
        word_spec(vocabulary)
    except ValueError:
        return False
    return True


@functools.lru_cache(1)
def library_encoder(vocabulary: str) -> LibraryEncoder:
    """One for all tasks of a worker."""
    return LibraryEncoder(vocabulary)


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Encode the texts, write files to folder in ascending id order, and return the manifest: part, piece, file, docs, n_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(vocabulary)
        part, piece, width = TaskContext.get().partitionId(), 0, 2 if max(encode.size, end_id) < 1 << 16 else 4
        names: list[int | None] = []
        sizes: list[int] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, sizes, ids, held, piece
            file = f"{folder}/part-{part:06d}-{piece:05d}.ids"
            write_file(file, *pack(names, sizes, ids, width))
            row = pa.RecordBatch.from_pydict({"part": [part], "piece": [piece], "file": [file], "docs": [len(names)], "n_ids": [held]}, pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("n_ids", pa.int64())]))
            names, sizes, ids, held, piece = [], [], [], 0, piece + 1
            return row

        for batch in batches:
            rows = iter(batch.column(0).to_pylist())
            for _, ((flat, at),) in gather(batch.column(1), encode, stretches=encode.stretches):
                block = np.insert(np.frombuffer(flat[at[0] : at[-1]], "<u4").astype(f"<u{width}"), (at[1:] - at[0]) // 4, end_id)
                first = done = 0
                for n in (np.diff(at) // 4 + 1).tolist():
                    if held and held + n > file_ids:
                        ids.append(block[first:done])
                        yield flush()
                        first = done
                    names.append(next(rows))
                    sizes.append(n)
                    held += n
                    done += n
                ids.append(block[first:])
        if names:
            yield flush()

    first = F.col(id_col).asc_nulls_first()
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).repartitionByRange(first, F.left(text_col, F.lit(RANGE_CHARS)).asc_nulls_first()).sortWithinPartitions(first, F.col(text_col).asc_nulls_first())
    return staged(rows.mapInArrow(run, "part int, piece int, file string, docs long, n_ids long").repartition(1), "token-manifest")


def read_token_files(manifest: DataFrame, ids: bool = False, id_col: str = "doc_id", read_docs: int = READ_DOCS) -> DataFrame:
    """Documents of the files: id, start (ids of all documents before), n_tokens, ids_crc32 and as asked ids."""
    whole = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(whole), F.lit(0)).cast("long"))
    fields = [(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = TokenFile(read_file(file))
                for i in range(0, len(got), read_docs):
                    j = min(i + read_docs, len(got))
                    ends = got.bounds(i, j)
                    flat = [got.flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    cols = [got.doc_ids(i, j), base + ends[:-1], np.diff(ends), [zlib.crc32(x.astype("<u4")) for x in flat]] + [[x.astype(np.int32) for x in flat]] * ids
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])

    files, n_ids = manifest.agg(F.count("*"), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    tasks = max(1, min(files, -(-n_ids // READ_IDS)))
    return based.select("file", "base").repartition(tasks).mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 1, **names) -> DataFrame:
    """Write and read back: the table of read_token_files."""
    return read_token_files(write_token_files(docs, vocabulary, end_id, fresh_path(docs.sparkSession, "token-files"), **names))
