"""Periodic runs of words within a text, by merging suffix classes in descending order of their common prefixes.

A run is a stretch of consecutive words with smallest period q and length >= max(least, 2 * q) that no neighbouring
word extends with that period. Such a run has two suffixes, q words apart, that share length - q >= least / 2 words.
So only positions whose next least / 2 words occur again matter: their suffixes are sorted by prefix doubling, and
the gaps between neighbours, from the longest common prefix down, unite classes of suffixes (union-find; each class
keeps its positions in order). Two positions that become neighbours in a class when it is united at prefix length l
share exactly l words; if they lie d <= l apart and the words before them differ, they are the start of a run of
period d and length l + d. No other position of the class lies between them, so no smaller period fits.

Words are stretches without ASCII white space. A null or blank text has no words and no runs; a null id is carried
along; rows that repeat are judged alike; an empty table gives an empty result. Columns besides id and text are not
read. A text is held whole by one task, nothing else of the table is.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
#: numbers in a stretch of an ordered set of positions
STRETCH = 1024


class Positions:
    """A set of numbers in order, held in sorted stretches of bounded length."""

    __slots__ = ("parts", "heads", "size")

    def __init__(self, x: int):
        self.parts, self.heads, self.size = [[x]], [x], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.parts:
            yield from part

    def add(self, x: int) -> None:
        k = max(0, bisect_left(self.heads, x) - 1)
        part = self.parts[k]
        part.insert(bisect_left(part, x), x)
        self.heads[k] = part[0]
        self.size += 1
        if len(part) > STRETCH:
            half = len(part) // 2
            self.parts[k : k + 1] = [part[:half], part[half:]]
            self.heads[k : k + 1] = [part[0], part[half]]

    def around(self, x: int) -> tuple[int, int]:
        """The members next to member x, -1 where there is none."""
        k = bisect_left(self.heads, x)
        if k == len(self.heads) or self.heads[k] != x:
            k -= 1
        part = self.parts[k]
        i = bisect_left(part, x)
        before = part[i - 1] if i else self.parts[k - 1][-1] if k else -1
        after = part[i + 1] if i + 1 < len(part) else self.parts[k + 1][0] if k + 1 < len(self.parts) else -1
        return before, after


def _classes(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _classes(a * (int(b.max()) + 1) + b)


def window_classes(codes: np.ndarray, width: int) -> np.ndarray:
    """A class for the window of width words at each position, in the windows' order; windows past the end are alike in none."""
    level = np.concatenate([codes + 1, np.zeros(width, np.int64)])
    at, done = level, 1
    while done < width:
        step = min(done, width - done)  # windows of done words, step apart, cover done + step
        n = len(at) - step
        at = _pairs(at[:n], at[step : step + n])
        done += step
    return at[: len(codes)]


def sorted_suffixes(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions whose next width words occur twice or more, in their suffixes' order, and the words that each shares with the one before."""
    rank = window_classes(codes, width)
    count = np.bincount(rank)
    places = np.flatnonzero(count[rank] > 1)
    if not len(places):
        return places, places
    order = places[np.argsort(rank[places], kind="stable")]
    # a suffix's rank is the slot where its class starts; ranks of windows that occur once are only compared
    slot = np.arange(len(order))
    new = np.ones(len(order), bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    follow, k = rank.astype(np.int64), width
    group = np.maximum.accumulate(np.where(new, slot, 0))
    step = len(order) + 1
    while True:
        open_ = ~new | np.append(~new[1:], False)
        if not open_.any():
            break
        act, g = order[open_], group[open_]
        key = np.where(act + k < len(codes), follow[np.minimum(act + k, len(codes) - 1)] + 1, 0)
        by = np.lexsort((key, g))
        act, key = act[by], key[by]
        order[open_] = act
        new[open_] = np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])])
        group = np.maximum.accumulate(np.where(new, slot, 0))
        # ranks for the next round: by window class, then by slot within it
        follow = rank.astype(np.int64) * step
        follow[order] += group + 1
        k *= 2
    return order, _shared(codes, order, width)


def _shared(codes: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Words that each suffix shares with the one before it in order (0 for fewer than width), in the text's order of positions."""
    words, n = codes.tolist(), len(codes)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = [0] * n
    h = 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            h = 0
            continue
        h = h - 1 if h > width else 0
        top = n - (i if i > j else j)
        while h < top and words[i + h] == words[j + h]:
            h += 1
        out[i] = h
    return np.array(out, np.int64)[order]


def runs_of(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of codes from 0, by start, then period."""
    n, width = len(codes), max(1, -(-least // 2))
    if n < max(least, 2):
        return []
    order, shared = sorted_suffixes(codes, width)
    if not len(order):
        return []
    words, places, common = codes.tolist(), order.tolist(), shared.tolist()
    joins = np.flatnonzero(shared >= width)
    up = list(range(len(places)))
    sets: list[Positions | None] = [None] * len(places)
    found = []

    def root(r: int) -> int:
        while up[r] != r:
            up[r] = r = up[up[r]]
        return r

    for r in joins[np.argsort(-shared[joins], kind="stable")].tolist():
        ell, a, b = common[r], root(r - 1), root(r)
        large, small = sets[a] or Positions(places[a]), sets[b] or Positions(places[b])
        if large.size < small.size:
            large, small = small, large
        fresh = list(small)
        for x in fresh:
            large.add(x)
        up[b], sets[a], sets[b] = a, large, None
        last = -1
        for k, x in enumerate(fresh):
            lower, higher = large.around(x)
            for p, q in ((lower, x), (x, higher)):
                # neighbours that both come from the smaller class met before
                if p < 0 or q < 0 or q - p > ell or (p == lower and p == last) or (q == higher and k + 1 < len(fresh) and q == fresh[k + 1]):
                    continue
                if ell + q - p >= least and (p == 0 or words[p - 1] != words[q - 1]):
                    found.append((p, ell + q - p, q - p))
            last = x
    return sorted(found, key=lambda run: (run[0], run[2]))


def coded(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds beyond its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()])


def words_of(key, text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()  # of bytes: ASCII white space alone


def with_planted_run(key, text: str | None) -> list[bytes]:
    """The words, for a tenth of the keys repeated with a period from a word on, both drawn by the key's checksum."""
    words = words_of(key, text)
    n = len(words)
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", words: Callable[[object, str | None], list[bytes]] = words_of, runs: bool = False, texts: bool = False
) -> DataFrame:
    """Each document's id, n_runs, its longest run (start, length, period, exponent_milli) and digests; as asked all runs and the collapsed text.

    words: what makes a list of words of an id and a text. Of runs of one length the first counts as the longest,
    of those the one of the smaller period; without runs its four columns are null.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", runs array<struct<start:long,length:long,period:long>>" * runs + ", collapsed string" * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = words(key, text.as_py())
                found = runs_of(coded(own), least) if len(own) >= least else []
                start, length, period = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
                flat = collapse(own, found)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
                row = [len(found), start, length, period, 1000 * length // period if found else None, hashlib.sha256(listed).hexdigest(), hashlib.sha256(flat).hexdigest()]
                rows.append(row + [[dict(zip(("start", "length", "period"), x)) for x in found]] * runs + [flat.decode("utf-8")] * texts)
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(_RUN)] * runs + [pa.string()] * texts
            names = [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", *["runs"] * runs, *["collapsed"] * texts]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
