"""Whitening of embeddings along their leading components, which spectrum slicing finds and numbers.

Entries are quantised to integers, floor(256 * c). The fit list is each distinct quantised vector once: it gives the
sums per dimension (exact), the covariance (centred, then multiplied, in partial sums per task) and from that, on the
driver, the leading eigenvalues. An LDL^T factorisation of the covariance minus a shift has as many positive pivots
as there are eigenvalues above the shift (Sylvester); bisection on these counts brackets each leading eigenvalue by
itself, Rayleigh quotient iteration started in the bracket converges cubically, and counts just below and above the
result certify its number. Equal eigenvalues share a bracket; their vectors are kept orthogonal.

Rows whose vector is null or empty, or holds a null or an entry that is not finite, are dropped, as are rows whose
vector has another length than most distinct vectors (ties: the longer). Entries beyond the range of a long count as
its ends; a deviation that no long holds is null. Components without variance are left out, so a table of one
distinct vector, or an empty one, gives no rows. Ids may be null or repeat; rows are carried one by one. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: The covariance of so many dimensions (32 MB) is solved on the driver; more are refused.
MAX_DIMENSIONS = 2048
SCALE = 256
#: A component's variance is at least this share of all, else it is rounding.
LEAST_SHARE = 1e-12
_EPS = float(np.finfo(np.float64).eps)


def positive_pivots(matrix: np.ndarray) -> int:
    """Eigenvalues above zero of a symmetric matrix: positive pivots of its LDL^T factorisation (Bunch and Kaufman, 1977)."""
    a, n, k, found, alpha = matrix.copy(), len(matrix), 0, 0, (1 + 17**0.5) / 8
    while k < n:
        wide = False
        if k < n - 1:
            below = np.abs(a[k + 1 :, k])
            r = k + 1 + int(below.argmax())
            top, own = below[r - k - 1], abs(a[k, k])
            if own < alpha * top:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if own * other < alpha * top * top:
                    wide = abs(a[r, r]) < alpha * other
                    to = k + wide
                    if to != r:
                        a[[to, r]] = a[[r, to]]
                        a[:, [to, r]] = a[:, [r, to]]
        if wide:  # a two by two pivot has one positive and one negative eigenvalue
            block, c = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(block, c.T)
            found, k = found + 1, k + 2
        else:
            d, c = a[k, k], a[k + 1 :, k]
            if d:
                a[k + 1 :, k + 1 :] -= np.outer(c / d, c)
            found, k = found + int(d > 0), k + 1
    return found


def leading_components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues above rounding of a covariance, falling, and their unit eigenvectors as rows."""
    d, total = len(v), float(np.trace(v))
    if not total > 0:
        return np.zeros(0), np.zeros((0, d))
    eye, norm = np.eye(d), float(np.abs(v).sum(1).max())
    above = {norm * (1 + 1e-9): 0}  # shift: eigenvalues above it
    if (share := LEAST_SHARE * total) not in above:
        above[share] = positive_pivots(v - share * eye)
    values, vectors = [], np.zeros((0, d))

    def count(shift: float) -> int:
        if shift not in above:
            above[shift] = positive_pivots(v - shift * eye)
        return above[shift]

    for j in range(1, min(most, above[share]) + 1):
        low, high = max(s for s, n in above.items() if n >= j), min(s for s, n in above.items() if n < j)

        def halve() -> bool:
            nonlocal low, high
            mid = (low + high) / 2
            if not low < mid < high:
                return False
            low, high = (mid, high) if count(mid) >= j else (low, mid)
            return True

        while not (count(low) == j and count(high) == j - 1) and high - low > 64 * _EPS * norm:
            halve()
        while True:
            mu, x = (low + high) / 2, np.cos(np.arange(1, d + 1) * (j + 0.5))
            best = (np.inf, x, mu)
            for step in range(30):
                try:
                    y = np.linalg.solve(v - mu * eye, x)
                except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
                    y = np.linalg.solve(v - (mu + 4 * _EPS * norm) * eye, x)
                y -= vectors.T @ (vectors @ y)
                x = y / np.linalg.norm(y)
                x -= vectors.T @ (vectors @ x)
                x /= np.linalg.norm(x)
                quotient = float(x @ (v @ x))
                off = float(np.linalg.norm(v @ x - quotient * x))
                if off < best[0]:
                    best = (off, x, quotient)
                elif step > 3:
                    break
                mu = quotient if step else mu  # the first step is an inverse iteration at the middle of the bracket
            off, x, mu = best
            slack = max(4 * off, 64 * _EPS * norm)
            if off <= 1e-10 * norm and low - slack <= mu <= high + slack:
                break
            if not halve():  # the quotient went to another eigenvalue: start closer
                raise RuntimeError(f"no eigenvector found for eigenvalue {j}")
        if not (count(mu - slack) >= j > count(mu + slack)):
            raise RuntimeError(f"eigenvalue {j} is not certified")
        values.append(mu)
        vectors = np.vstack([vectors, x])
    return np.array(values), vectors


def _rows(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Quantised vectors of a list column: row numbers and integer matrices, by vectors' length."""
    n = len(column)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    entries = flat.to_numpy(zero_copy_only=False)  # nulls are NaN
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    fit = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    out = []
    for size in np.unique(sizes[fit]).tolist():
        rows = np.flatnonzero(fit & (sizes == size))
        x = np.floor(entries[(ends[rows] - size)[:, None] + np.arange(size)] * SCALE)
        edge = float(2**63)
        ints = np.where(x >= edge, np.iinfo(np.int64).max, np.where(x < -edge, np.iinfo(np.int64).min, np.where(np.abs(x) < edge, x, 0).astype(np.int64)))
        out.append((rows, ints))
    return np.arange(n), out


def _packed(x: np.ndarray) -> list[bytes]:
    """A vector's bytes: two an entry where all fit, else eight."""
    small = ((x >= -(2**15)) & (x < 2**15)).all(1)
    return [r.astype("<i2").tobytes() if s else r.astype("<i8").tobytes() for r, s in zip(x, small.tolist())]


def _unpacked(column: pa.Array, size: int) -> np.ndarray:
    out = np.empty((len(column), size), np.int64)
    wide = pc.binary_length(column).to_numpy(zero_copy_only=False) > 2 * size
    for flag, kind in ((False, "<i2"), (True, "<i8")):
        at = np.flatnonzero(wide == flag)
        if len(at):
            out[at] = np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), kind).reshape(len(at), size)
    return out


def fit_list(table: DataFrame, vector_col: str) -> DataFrame:
    """dim and x, the bytes of each distinct quantised vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _rows(batch.column(0))[1]:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(_packed(x), pa.binary())], ["dim", "x"])

    return table.select(F.col(vector_col)).mapInArrow(run, "dim int, x binary").distinct()


def _column_sums(fit: DataFrame, size: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * size
        for batch in batches:
            x = _unpacked(batch.column(0), size)
            exact = not len(x) or int(np.abs(x.astype(np.float64)).max()) * len(x) < 2**62
            sums = [a + int(b) for a, b in zip(sums, (x if exact else x.astype(object)).sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["i", "s"])

    parts = fit.select("x").mapInArrow(run, "i int, s decimal(38,0)")
    found = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return [found[i] for i in range(size)]


def _moments(fit: DataFrame, size: int, project, width: int) -> np.ndarray:
    """Sum over the fit list of the outer products of project(x), a matrix of width columns; in partial sums per task."""
    layout = [("i", pa.int32()), ("row", pa.list_(pa.float64()))]

    def emit(m: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(m), pa.int32()), pa.array([r.tolist() for r in m.values()], layout[1][1])], ["i", "row"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = project(_unpacked(batch.column(0), size))
            total += y.T @ y
        yield emit(dict(enumerate(total)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[i] = sums[i] + row if i in sums else np.array(row)
        yield emit(sums)

    parts = fit.select("x").mapInArrow(multiply, "i int, row array<double>").repartition("i").mapInArrow(add, "i int, row array<double>")
    found = {r.i: r.row for r in parts.collect()}
    return np.array([found[i] for i in range(width)])


def whiten(table: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each row and leading component: id, component, n, deviation, whitened, explained, identity_error."""
    kind = table.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    scratch = Scratch()
    lists = scratch.staged(fit_list(table, vector_col), "fit-list")
    most = lists.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    nothing = table.sparkSession.createDataFrame([], schema)
    if not most:
        scratch.clear()
        return nothing
    size, n = most["dim"], most["count"]
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {size} dimensions: at most {MAX_DIMENSIONS} are fitted")
    fit = lists.where(F.col("dim") == size)
    sums = _column_sums(fit, size)
    mean = np.array([s / n for s in sums])
    values, vectors = leading_components(v := _moments(fit, size, lambda x: x - mean, size) / n, components)
    if not len(values):
        scratch.clear()
        return nothing
    scaled = (vectors / np.sqrt(values)[:, None]).T
    spread = _moments(fit, size, lambda x: np.hstack([(x - mean) @ scaled, np.ones((len(x), 1))]), len(values) + 1) / n
    centre = spread[-1, :-1]
    error = float(np.abs(spread[:-1, :-1] - np.outer(centre, centre) - np.eye(len(values))).max())
    explained = (values / np.trace(v)).tolist()
    scratch.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(sums, object)
        for batch in batches:
            for rows, x in _rows(batch.column(1))[1]:
                if x.shape[1] != size:
                    continue
                bound = n * int(np.abs(x.astype(np.float64)).max()) + max(abs(s) for s in sums)
                if bound * bound * size < 2**62:
                    deviation = pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(1))
                else:
                    sizes = ((n * x.astype(object) - exact) ** 2).sum(1)
                    deviation = pa.array([s if s < 2**63 else None for s in sizes], pa.int64())
                y = (x - mean) @ scaled
                k = len(values)
                twice = pa.array(np.repeat(np.arange(len(x)), k))
                cols = [
                    batch.column(0).take(pa.array(rows)).take(twice), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)), deviation.take(twice),
                    pa.array(y.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.select(F.col(id_col), F.col(vector_col)).mapInArrow(run, schema)
