"""Quality classifier: naive Bayes support vectors.

A document's features are indicators of hashed n-grams: words and word pairs, 4-grams of character classes (letter
case, digit, white space, each punctuation mark), and two coarse ones, the class of its length and of the share of
its 3-word runs that are repeats. Indicators are scaled by the log ratio of their smoothed counts in the two
classes and by the vector's length; a linear hinge-loss model is fitted by dual coordinate descent, and its margin
is mapped to a probability on rows left out of the fit, at the labels' own class shares.

Only the text is an input. The fit takes at most `most` labelled rows, half a class, those with the least hash of
their id, and of these as many as have SAMPLE_BYTES of text together (the first is taken whatever its size up to
that), so the driver's share is bounded in bytes as well; the model (one weight a bucket) is of fixed size and travels with the tasks. Scores cover whole texts.
Null and empty texts have only the coarse features. Without both classes among the labels every score is the share
of class 1, or 0.5 without labels. Repeated or null labels: a row counts by its least non-null label. Repeated
documents give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import LOWER, SPACE, U, blocks, mix, runs_of, word_hashes

BITS = 18
MOST = 6000
SAMPLE_BYTES = 48 << 20
EPOCHS, COST, SMOOTH = 12, 1.0, 1.0
THRESHOLD = 0.3
CLASS = np.arange(256, dtype=np.uint8)
CLASS[48:58], CLASS[65:91], CLASS[97:123], CLASS[128:] = ord("0"), ord("A"), ord("a"), ord("a")
CLASS[SPACE] = 32


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bounds, buckets) for blocks of texts in order: text i has the distinct buckets bounds[i] to bounds[i + 1]."""
    mask = U((1 << BITS) - 1)
    for _, buf, offsets in blocks(texts, 1 << 18):
        n = len(offsets) - 1
        low = LOWER[buf]
        h, at = word_hashes(low, offsets)
        owner = np.repeat(np.arange(n), np.diff(at)).astype(np.int64)
        groups = [(owner, h & mask)]
        if len(h) > 1:
            same = owner[1:] == owner[:-1]
            groups.append((owner[1:][same], (runs_of(h, 2) & mask)[same]))
        if len(buf) > 3:
            c = CLASS[buf].astype(np.uint32)
            grams = c[:-3] | c[1:-2] << np.uint32(8) | c[2:-1] << np.uint32(16) | c[3:] << np.uint32(24)
            by = np.repeat(np.arange(n), np.diff(offsets))
            inside = by[3:] == by[:-3]
            # a mark is set once a text: most grams repeat, so drop repeats of the one before cheaply
            groups.append((by[:-3][inside], mix(grams[inside].astype(U) + U(1 << 40)) & mask))
        repeat = np.zeros(n, np.int64)
        triples = runs_of(h, 3)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if b - a > 3:
                run = triples[a : b - 2]
                repeat[i] = 10 - int(10 * len(np.unique(run)) / len(run))
        length = np.ceil(np.log2(np.diff(at) + 1)).astype(np.int64)
        every = np.arange(n)
        groups += [(every, mix((repeat + (1 << 41)).astype(U)) & mask), (every, mix((length + (1 << 42)).astype(U)) & mask)]
        flat = np.unique(np.concatenate([(o << BITS) | x.astype(np.int64) for o, x in groups]))
        yield np.searchsorted(flat >> BITS, np.arange(n + 1)), flat & int(mask)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    constant: float | None = None

    def score(self, bounds: np.ndarray, buckets: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        dot = np.bincount(owner, self.weights[buckets], n)
        norm = np.sqrt(np.bincount(owner, ratio[buckets] ** 2, n))
        return sigmoid(self.slope * (dot / np.maximum(norm, 1e-9) + self.bias) + self.offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int, epochs: int = EPOCHS, cost: float = COST) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model with hinge loss; rows are (indices, values), y is 1 or -1."""
    w, bias, alpha = np.zeros(dim), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1 for _, v in rows])
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, val = rows[i]
            slack = 1 - y[i] * (float(w[idx] @ val) + bias)
            new = min(cost, max(0.0, alpha[i] + slack / square[i]))
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[idx] += step * val
                bias += step
                alpha[i] = new
    return w, bias


def fit(samples: list[tuple[np.ndarray, int]], share: float, smooth: float = SMOOTH) -> tuple[Model, np.ndarray]:
    """The model and the log-count ratios, from (buckets, label) samples; share: of label 1 among all labels."""
    dim = 1 << BITS
    labels = np.array([q for _, q in samples])
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(0), 0, 0, 0, share), np.zeros(dim)
    counts = np.full((2, dim), smooth)
    for buckets, q in samples:
        counts[q][buckets] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    rows = [(b, ratio[b] / max(float(np.linalg.norm(ratio[b])), 1e-9)) for b, _ in samples]
    y = np.where(labels == 1, 1.0, -1.0)
    out = np.zeros(len(rows))
    for fold in range(3):  # margins of rows left out, to map margins to probabilities
        kept = [i for i in range(len(rows)) if i % 3 != fold]
        w, b = dual_descent([rows[i] for i in kept], y[kept], dim)
        for i in range(fold, len(rows), 3):
            out[i] = float(w[rows[i][0]] @ rows[i][1]) + b
    w, b = dual_descent(rows, y, dim)
    slope, offset = logistic(out, labels, share)
    return Model(w * ratio, b, slope, offset), ratio


def logistic(margin: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, rows being weighted to the share."""
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    x = np.stack([margin, np.ones(len(margin))], 1)
    t = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ t)
        grad = x.T @ (weight * (p - labels)) + 1e-3 * t
        t = t - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
    return float(t[0]), float(t[1])


def held_out(id_col: str):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_bytes: int = SAMPLE_BYTES) -> tuple[Model, np.ndarray]:
    """The model and the log-count ratios, from at most `most` labelled rows that are not held out, of at most most_bytes of text.

    One task fits them, as they are bounded; the driver gets weights and ratios alone, which are of fixed size.
    """
    known = labels.where(F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.min(label_col).alias("q")).where("q in (0, 1)")
    ones, total = known.agg(F.sum("q"), F.count("*")).first()
    share = ones / total if total else 0.5
    pick = [known.where(F.col("q") == q).orderBy(F.xxhash64(id_col), id_col).limit(most // 2) for q in (0, 1)]
    chosen = pick[0].unionByName(pick[1]).select(F.col(id_col).alias("pick_id"), "q")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x.astype(np.int32).tobytes() for bounds, buckets in features(batch.column(1)) for x in np.split(buckets, bounds[1:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary())], ["id", "q", "buckets"])

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = source.join(F.broadcast(chosen), F.col("id") == F.col("pick_id"))  # at most `most` ids
    # a repeated id counts once, by the text of least hash, so that the sample is bounded in rows too
    once = sample.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"), F.first(F.col("q").cast("int")).alias("q"))
    # of both classes in turn, by hash, while their texts fit: a window over at most `most` rows of ids and sizes
    size = F.octet_length("text").cast("long")
    once = once.select("id", "least.text", "q", F.xxhash64("id").alias("hash"), size.alias("size"))
    turn = once.select("id", "hash", "size", F.row_number().over(Window.partitionBy("q").orderBy("hash", "id")).alias("turn"))
    fits = turn.withColumn("upto", F.sum("size").over(Window.orderBy("turn", "hash", "id"))).where(F.col("upto") <= most_bytes)
    once = once.join(F.broadcast(fits.select("id")), "id")
    kind = docs.schema[id_col].dataType.simpleString()
    sample = once.select("id", "text", "q").mapInArrow(grams, f"id {kind}, q int, buckets binary")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((i, q, bytes(b)) for batch in batches for i, q, b in zip(*(c.to_pylist() for c in batch.columns))), key=lambda r: r[0])
        order = np.random.default_rng(3).permutation(len(rows))
        model, ratio = fit([(np.frombuffer(rows[i][2], np.int32), rows[i][1]) for i in order], share)
        constant = np.nan if model.constant is None else model.constant
        parts = [model.weights, np.array([model.bias, model.slope, model.offset, constant]), ratio]
        yield pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array([np.asarray(x, np.float64).tobytes() for x in parts], pa.binary())], ["part", "numbers"])

    found = {r.part: np.frombuffer(bytes(r.numbers), np.float64) for r in sample.repartition(1).mapInArrow(fitted, "part long, numbers binary").collect()}
    if not found:
        return fit([], share)
    bias, slope, offset, constant = map(float, found[1])
    return Model(found[0], bias, slope, offset, None if np.isnan(constant) else constant), found[2]


def scores_of(texts: pa.Array, model: Model, ratio: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(model.score(bounds, buckets, ratio) for bounds, buckets in features(texts))])


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most, id_col, text_col))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores_of(batch.column(1), *sent.value))], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score at least the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, most, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array(scores_of(texts, *sent.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
