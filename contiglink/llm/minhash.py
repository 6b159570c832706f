"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles of `shingle` words (ASCII letters lowered, words cut at ASCII white
space; with fewer words, the whole sequence): 4 in op8_minhash, 5 in the pipeline's stage. The sketch of Dahlgaard, Knudsen and Thorup (2017) has t bins: in round i < t
every element is placed into one hashed bin with the value (i, hash), in round t + j into bin j; a bin keeps its
least value, and rounds end when all bins are full, which they are after 2t rounds whatever the set. Bands of
`rows` neighbouring bins are hashed to keys.

1. Rows with the same words (128 bits of BLAKE2 over the sequence) form a class, and classes are compared from here on.
2. In every band bucket each class is paired with one pivot; pairs are verified on full sets, made of the words of
   both texts and not of hashes, and links are closed into components. Pairs grow with the members, not their square.
3. In buckets that still hold several components each class is paired with another pivot, drawn by the bucket's key,
   so that a group of which no member is close to all is joined by many; the pairs are verified likewise.
4. Members of a bucket that still lie in different components may be linked without either being linked to a pivot.
   For all classes of such buckets an exact prefix join follows: shingles are ordered by the number of
   classes that hold them, those of one component alone first, as they can't be shared with another. In a pair of
   similarity 0.8 the first common shingle lies in the first ninth of the smaller set and the first fifth of the
   larger, and what follows it must still suffice for their sizes. Shingles meet by classes of set size; none of the
   pairs within a shingle's most frequent component is made; a shingle of many is dealt out in cells of at most
   CELL x CELL pairs. The pairs are verified likewise.

So no link between documents that meet in a bucket is lost, and no group's pairs are all emitted. With 6 rows and
40 bands a pair at similarity 0.8 meets in no bucket with probability 5e-6; links also close transitively. Keys with
a large share of the rows (a class, a bucket, a pivot, a shingle) are looked up in broadcasts of at most a thousand
rows, or their partner is dealt out in copies, so no task gets a whole group.

Null and empty texts (or white space alone) have an empty set and are linked with nothing. Rows with the same id
are one document, with all links of its rows. A null id stays alone: component null, kept. An empty table gives an
empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.hot import LEAST, SHARE, hot_lookup
from .common import Scratch, staged
from .components import components
from .hashing import LOWER, SPACE, U, blocks, codes_of, mix, runs_of, slices, string_hashes, word_column

SHINGLE = 4
ROWS, BANDS = 6, 40
PERCENT = 80
CELL = 2000
FEW = 1 << 20  # row numbers that are broadcast, some 32 MB at most
SEEDS = mix(np.arange(1, 4097, dtype=U) * U(0x9E3779B97F4A7C15))
TO_SPACE = LOWER.copy()
TO_SPACE[SPACE] = 32


def digests(buf: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits for each text's words: equal words in the same order, equal digest."""
    word = ~SPACE[buf]
    keep = word.copy()
    keep[1:] |= word[:-1]  # one mark of white space after each word
    flat = TO_SPACE[buf[keep]].tobytes()
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[offsets].tolist()
    return [hashlib.blake2b(flat[a:b].strip(b" "), digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:])]


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): text i has the sorted distinct shingle hashes bounds[i] to bounds[i + 1]."""
    column, at = word_column(LOWER[buf], offsets)
    code, distinct = codes_of(column)
    h = string_hashes(distinct)[code]
    runs = runs_of(h, k)
    sets = [np.zeros(0, U)]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(runs[a : b - k + 1]))
        else:
            sets.append(runs_of(h[a:b], b - a) if b > a else sets[0])
    return np.cumsum([0, *map(len, sets[1:])]), np.concatenate(sets)


def sketches(bounds: np.ndarray, hashes: np.ndarray, t: int) -> np.ndarray:
    """A row of t values for each set; rows of empty sets mean nothing."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    top = ~U(0)
    out = np.full(n * t, top, U)
    live_sets = size > 0
    for i in range(2 * t):
        rehashed = mix(hashes ^ SEEDS[i])
        bins = (rehashed & U(0xFFFFFF)) % U(t) if i < t else np.full(len(hashes), i - t, U)
        # (round, hash): 12 bits of round suffice for t up to 2048
        np.minimum.at(out, owner * t + bins.astype(np.int64), U(i) << U(52) | rehashed >> U(12))
        if i & 3 == 3 or i > 8 or len(hashes) < 4096:
            open_sets = live_sets & (out.reshape(n, t) == top).any(axis=1)
            if not open_sets.any():
                break
            stay = open_sets[owner]
            owner, hashes, live_sets = owner[stay], hashes[stay], open_sets
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, rows: int, bands: int) -> np.ndarray:
    out = np.zeros((len(sketch), bands), U)
    by = sketch.reshape(len(sketch), bands, rows)
    for r in range(rows):
        out = mix(out * U(0xC2B2AE3D27D4EB4F) + by[:, :, r])
    return mix(out + np.arange(bands, dtype=U))


def fingerprints(texts: DataFrame, rows: int = ROWS, bands: int = BANDS, shingle: int = SHINGLE) -> DataFrame:
    """k, n_shingles, f1 and f2 (equal for equal words), and the band keys, of each row of (k, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, buf, offsets in blocks(batch.column(1)):
                n = len(offsets) - 1
                bounds, hashes = shingle_sets(buf, offsets, shingle)
                prints = np.frombuffer(b"".join(digests(buf, offsets)), "<i8").reshape(n, 2)
                keys = band_keys(sketches(bounds, hashes, rows * bands), rows, bands).view(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(np.diff(bounds)), *(pa.array(np.ascontiguousarray(prints[:, j])) for j in (0, 1)), flat], ["k", "n_shingles", "f1", "f2", "bands"])

    return texts.select("k", "text").mapInArrow(run, "k long, n_shingles long, f1 long, f2 long, bands array<long>")


def exact_pairs(texts: pa.Array, percent: int, k: int) -> np.ndarray:
    """Whether texts i and n + i of 2n texts have the similarity, by their words. Texts of fewer than k words have it with none."""
    n = len(texts) // 2
    for _, buf, offsets in blocks(texts, 1 << 62):
        column, at = word_column(LOWER[buf], offsets)
        word = codes_of(column)[0].astype(np.int64)
        text = np.repeat(np.arange(2 * n), np.diff(at))
        run = word
        for i in range(1, k):  # a number for each run of i + 1 words, one more word a step
            run = codes_of(pa.array(run[:-1] * (len(word) + 1) + word[i:]))[0].astype(np.int64) if len(run) > 1 else run[:0]
        inside = text[: len(run)] == text[k - 1 :][: len(run)]
        run, text = run[inside], text[: len(run)][inside]
        pair = np.unique((text % n * 2 + text // n) * (len(word) + 1) + run)  # distinct (pair, side, shingle)
        side, run = np.divmod(pair, len(word) + 1)
        sizes = np.bincount(side, minlength=2 * n).reshape(n, 2).sum(1)
        both = np.sort(side // 2 * (len(word) + 1) + run)
        same = np.bincount(both[1:][both[1:] == both[:-1]] // (len(word) + 1), minlength=n)
        return (same > 0) & (100 * same >= percent * (sizes - same))
    return np.zeros(0, bool)


def with_texts(pairs: DataFrame, texts: DataFrame, end: str, other: str, name: str, total: int) -> DataFrame:
    """Pairs with the text of one end. The text of an end that many pairs share is dealt out in copies."""
    side = texts.select(F.col("k").alias(end), F.col("text").alias(name))
    if total < LEAST:
        return pairs.join(side, end)
    hot = F.broadcast(pairs.groupBy(end).agg(F.count("*").alias("n")).where(F.col("n") * SHARE > total))  # at most SHARE rows
    parts = F.coalesce(F.ceil(F.col("n") / CELL), F.lit(1)).cast("int")
    left = pairs.join(hot, end, "left").withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("n")
    right = side.join(hot, end, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    return left.join(right, [end, "part"]).drop("part")


def verified(pairs: DataFrame, total: int, texts: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The pairs (a, b), of which there are `total`, whose full sets have the similarity."""
    both = with_texts(with_texts(pairs, texts, "a", "b", "ta", total), texts, "b", "a", "tb", total).select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 2, 2 << 20)):
            keep = exact_pairs(pa.concat_arrays([batch.column(2), batch.column(3)]), percent, shingle)
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def shingles_of(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """k, s: the shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, buf, offsets in blocks(batch.column(1)):
                bounds, hashes = shingle_sets(buf, offsets, shingle)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys[first : first + len(bounds) - 1], np.diff(bounds))), pa.array(hashes.view(np.int64))], ["k", "s"])

    return texts.select("k", "text").mapInArrow(run, "k long, s long")


def looked_up(df: DataFrame, keys: DataFrame, total: int, on: str, how: str) -> DataFrame:
    """Semi or anti join of wide rows with a written table of `total` distinct numbers: few are broadcast, so the rows stay where they are."""
    return df.join(F.broadcast(keys) if total <= FEW else keys, on, how)


def near_groups(rows: DataFrame, scratch: Scratch, linked: str = "true", ties: DataFrame | None = None, bands_of: tuple[int, int] = (ROWS, BANDS), percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """k, n_shingles and component (a k) of each row; component is null for empty sets and where `linked` is false.

    rows: a written table with k (unique), text and what `linked` names. ties: rows (a, b) that belong together anyhow.
    scratch: what the result reads, to be cleared when the result is written.
    """
    temp = Scratch()
    prints = scratch.staged(fingerprints(rows, *bands_of, shingle), "sketches")
    filled = prints.where("n_shingles > 0")
    if linked != "true":
        filled = filled.join(rows.where(linked).select("k"), "k", "left_semi")
    classes, members = scratch.measured(filled.groupBy("f1", "f2").agg(F.min("k").alias("key"), F.count("*").alias("copies")), "classes", F.sum("copies"))
    member = scratch.staged(hot_lookup(filled.select("k", "f1", "f2"), classes, ["f1", "f2"], "copies", members).select("k", "key"), "members")
    heads = temp.staged(prints.join(classes.select(F.col("key").alias("k")), "k", "left_semi").select("k", "n_shingles", "bands"), "heads")
    at = heads.select("k", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    pivots = at.groupBy("band").agg(F.min("k").alias("pivot"), F.max("k").alias("last"), F.count("*").alias("size")).where("pivot < last").drop("last")
    pivots, total = temp.measured(pivots, "pivots", F.sum("size"))
    met = temp.staged(hot_lookup(at, pivots, ["band"], "size", total), "buckets")  # buckets of more than one class
    texts = temp.staged(looked_up(rows.select("k", "text"), *temp.measured(met.select("k").distinct(), "near-keys", F.count("*")), "k", "left_semi"), "near-texts")

    stars = temp.measured(met.where("k != pivot").select(F.col("pivot").alias("a"), F.col("k").alias("b")).distinct(), "stars", F.count("*"))
    links = verified(*stars, texts, percent, shingle)
    if ties is not None:
        end = lambda x: member.select(F.col("k").alias(x), F.col("key").alias(f"{x}_key"))
        links = links.unionByName(ties.join(end("a"), "a").join(end("b"), "b").select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))
    labels = components(links)
    split = _split(met, labels, temp)
    for more in (_drawn, _across):
        if not split[-1]:  # each bucket lies in one component
            break
        links, found = more(*split, texts, percent, shingle, temp)
        if found:
            labels = _joined(labels, links, scratch)
            split = _split(met, labels, temp) if more is _drawn else split
    temp.clear()
    # a class that nothing is linked with is its own component
    whole = classes.select(F.col("key").alias("node"), "copies").join(labels, "node", "left").select(F.col("node").alias("key"), F.coalesce("component", "node").alias("component"), "copies")
    out = hot_lookup(member, scratch.staged(whole, "wholes"), ["key"], "copies", members).select("k", "component")
    return prints.select("k", "n_shingles").join(out, "k", "left")


def _joined(labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The labels after links (a, b) between components."""
    more = components(links).select(F.col("node").alias("component"), F.col("component").alias("c2"))
    moved = labels.join(more, "component", "left").select("node", F.coalesce("c2", "component").alias("component"))
    new = more.select(F.col("component").alias("node"), F.col("c2").alias("component")).join(labels.select("node"), "node", "left_anti")
    return scratch.staged(moved.unionByName(new), "labels")


def _split(met: DataFrame, labels: DataFrame, temp: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """band, k, n and component c of the members of buckets; band, size and a drawn pivot p of each bucket of several components; their members."""
    lab = temp.staged(met.select("band", "k", "n").join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn("c", F.coalesce("component", "k")).drop("component"), "labelled")
    # the band's key puts its members in an order of its own
    drawn = F.min(F.col("k").bitwiseXOR(F.col("band"))).bitwiseXOR(F.col("band")).alias("p")
    split = lab.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("size"), drawn).where("lo < hi").select("band", "p", "size")
    return lab, *temp.measured(split, "split", F.sum("size"))


def _drawn(lab: DataFrame, split: DataFrame, total: int, texts: DataFrame, percent: int, shingle: int, temp: Scratch) -> tuple[DataFrame, int]:
    """Links between the components (a, b) of classes and the drawn pivots of their buckets, and how many."""
    split = temp.staged(split.join(lab.select("band", F.col("k").alias("p"), F.col("c").alias("cp")), ["band", "p"]), "drawn")
    star = hot_lookup(lab, split, ["band"], "size", total).where("c != cp")
    pairs, total = temp.measured(star.select(F.least("p", "k").alias("a"), F.greatest("p", "k").alias("b"), F.least("c", "cp").alias("ca"), F.greatest("c", "cp").alias("cb")).distinct(), "drawn-pairs", F.count("*"))
    if not total:
        return pairs, 0
    links = verified(pairs.select("a", "b"), total, texts, percent, shingle).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    return temp.measured(links, "drawn-links", F.count("*"))


def _across(lab: DataFrame, split: DataFrame, total: int, texts: DataFrame, percent: int, shingle: int, temp: Scratch) -> tuple[DataFrame, int]:
    """Links between the components (a, b) of classes that meet in a bucket, and how many."""
    opened = temp.staged(hot_lookup(lab, split.drop("p"), ["band"], "size", total).select("k", "n", "c").distinct(), "open")
    sets = temp.staged(shingles_of(texts.join(opened.select("k"), "k", "left_semi"), shingle).join(opened, "k"), "open-shingles")
    # a shingle of one component only can't be shared with another: such come first in the order and are not looked up
    freq, total = temp.measured(sets.groupBy("s").agg(F.count("*").alias("df"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("s", "df", F.col("df").alias("rows")), "shared-shingles", F.sum("rows"))
    if not total:  # no shingle lies in two components
        return freq, 0
    own = Window.partitionBy("k")
    ranked = hot_lookup(sets, freq, ["s"], "rows", total).withColumn("r", F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "s")))
    rest = F.col("n") - F.col("r") + 1
    prefix = temp.staged(ranked.where(100 * rest >= percent * F.col("n")).select("s", "k", "c", "n", "r"), "prefixes")
    # a partner of size n to n * 100 / percent lies in the same class of sizes or the next
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(101 / percent)).cast("int")
    probe = prefix.withColumn("g", size).withColumn("small", F.lit(False))
    small = prefix.where((100 + percent) * rest >= 2 * percent * F.col("n")).withColumn("g", F.explode(F.array(size, size + 1))).withColumn("small", F.lit(True))
    sides = temp.staged(probe.unionByName(small), "sides")
    count = lambda which: F.sum(F.when(which, 1).otherwise(0))
    by = sides.groupBy("s", "g", "c").agg(F.count("*").alias("all"), count(F.col("small")).alias("smalls"))
    major = by.groupBy("s", "g").agg(F.max(F.struct("all", "c", "smalls")).alias("m"), F.count("*").alias("cs"), F.sum("all").alias("rows"), F.sum("smalls").alias("i"))
    major = major.where("cs > 1").select("s", "g", F.col("m.c").alias("major"), (F.col("i") - F.col("m.smalls")).alias("i_few"), F.col("m.smalls").alias("i_major"), (F.col("rows") - F.col("i")).alias("p"), (F.col("rows") - F.col("i") - (F.col("m.all") - F.col("m.smalls"))).alias("p_few"), "rows")
    major, total = temp.measured(major, "majors", F.sum("rows"))
    if not total:
        return major, 0
    marked = temp.staged(hot_lookup(sides, major, ["s", "g"], "rows", total), "marked")
    cells = lambda n: F.greatest(F.ceil(F.col(n) / CELL), F.lit(1)).cast("int")
    spread = lambda df, mine, n_mine, theirs, n_theirs: df.withColumn(mine, F.pmod(F.xxhash64("k"), cells(n_mine)).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), cells(n_theirs) - 1)))
    made = []
    # small sets outside the major component with all, those inside with what lies outside
    for mine, theirs, n_mine, n_theirs in (("c != major", "true", "i_few", "p"), ("c = major", "c != major", "i_major", "p_few")):
        open_cells = marked.where(f"{n_mine} > 0 and {n_theirs} > 0")
        a = spread(open_cells.where("small").where(mine), "x", n_mine, "y", n_theirs)
        b = spread(open_cells.where("not small").where(theirs), "y", n_theirs, "x", n_mine)
        side = lambda df, k: df.select("s", "g", "x", "y", *(F.col(v).alias(f"{v}{k}") for v in ("k", "c", "n", "r")))
        enough = (100 + percent) * (1 + F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb"))) >= percent * (F.col("na") + F.col("nb"))
        pairs = side(a, "a").join(side(b, "b"), ["s", "g", "x", "y"]).where((F.col("ca") != F.col("cb")) & (F.col("na") <= F.col("nb")) & (100 * F.col("na") >= percent * F.col("nb")) & enough)
        made.append(pairs.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b")))
    pairs, total = temp.measured(made[0].unionByName(made[1]).distinct(), "open-pairs", F.count("*"))
    if not total:
        return pairs, 0
    of = lambda x: opened.select(F.col("k").alias(x), F.col("c").alias(f"c{x}"))
    links = verified(pairs, total, texts, percent, shingle).join(of("a"), "a").join(of("b"), "b").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    return temp.measured(links, "open-links", F.count("*"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, bands: int = BANDS, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable) and kept of each row."""
    named = staged(docs.select(F.monotonically_increasing_id().alias("k"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "near-rows")
    ids = named.where("id is not null").select("k", "id")
    scratch = Scratch()
    many, total = scratch.measured(ids.groupBy("id").agg(F.min("k").alias("b"), F.count("*").alias("n")).where("n > 1"), "repeated-ids", F.sum("n"))
    ties = hot_lookup(ids, many, ["id"], "n", total).where("k != b").select(F.col("k").alias("a"), "b")
    kept = Scratch()  # what the result reads
    found, total = kept.measured(near_groups(named, scratch, "id is not null", ties, (rows, bands), percent, shingle).join(named.select("k", "id"), "k"), "near-groups", F.count("component"))
    scratch.clear()
    least = found.where("component is not null").groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
    linked = hot_lookup(found.where("component is not null"), least, ["component"], "n", total)
    out = linked.drop("component").unionByName(found.where("component is null").drop("component").withColumn("component_id", F.col("id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, bands: int = BANDS, percent: int = PERCENT, shingle: int = 5) -> DataFrame:
    """The rows of docs, with all their columns, of which each group of near duplicates keeps one: that of the least id.

    Rows are told apart by themselves, so one of a group stays even where ids are null (these come last) or repeat.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    named = staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    thin = named.select(F.col(row).alias("k"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scratch = Scratch()
    found = near_groups(thin, scratch, bands_of=(rows, bands), percent=percent, shingle=shingle).where("component is not null")
    kept = Scratch()  # what the result reads
    found, total = kept.measured(found.join(thin.select("k", "id"), "k").select("k", "component", F.struct(F.col("id").isNull(), "id", "k").alias("order")), "near-groups", F.count("*"))
    scratch.clear()
    first = found.groupBy("component").agg(F.min("order").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = kept.measured(hot_lookup(found, first, ["component"], "n", total).where("order != first").select(F.col("k").alias(row)), "near-gone", F.count("*"))
    return looked_up(named, *gone, row, "left_anti").select(docs.columns)
