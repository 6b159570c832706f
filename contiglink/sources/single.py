"""One ordered text file from many tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fasta import Bytes, file_sizes
from .staging import fresh_path, remove

CHUNK = 8 << 20


def _local(uri: str) -> str:
    if uri.startswith("file:"):
        return "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri}: a single file needs a file system with writes at offsets, such as a shared mount")
    return uri


def write_single(df: DataFrame, path: str, header: bool = True, order: list | None = None) -> None:
    """df as one TSV file, with one header, in the order asked for (else as it comes).

    Rows are sorted by ranges and written as parts; the parts' sizes, summed, give each its place, and tasks copy
    their parts to these places of one file, a few megabytes at a time. A retried task writes the same bytes to the
    same place. The file gets its name when it is whole, so nobody sees half of it.
    """
    target = _local(path)
    folder = fresh_path(df.sparkSession, "parts")
    (df.orderBy(*order) if order else df).write.csv(folder, sep="\t", header=False, quote="", emptyValue="")
    parts = file_sizes(df.sparkSession, folder).orderBy("file").collect()  # a row a task
    start = len(head := ("\t".join(df.columns) + "\n").encode("utf-8") if header else b"")
    places = []
    for p in parts:
        places.append((p.file, start))
        start += p.size
    os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
    half = f"{target}.{os.path.basename(folder)}"
    with open(half, "wb") as f:
        f.truncate(start)
        f.write(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with Bytes(file) as source, open(half, "r+b") as f:
                    for k in range(0, source.size, CHUNK):
                        os.pwrite(f.fileno(), source.read(k, k + CHUNK), at + k)
                    os.fsync(f.fileno())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    if places:
        todo = df.sparkSession.createDataFrame(places, "file string, at long").repartition(len(places), "file")
        done = todo.mapInArrow(run, "files long").agg(F.sum("files")).first()[0]
        if done != len(places):
            raise RuntimeError(f"{done} of {len(places)} parts were copied")
    os.replace(half, target)
    remove(folder)
