"""Helpers shared by the training-data operators: tables and files in the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import Scratch, fresh_path, shared_dir, staged  # noqa: F401  (for the operators)

#: Rows in an Arrow batch: texts are long, and a batch is held several times over on its way to Python and back.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """For the session of a job; the operators themselves leave its settings alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, *parts: bytes) -> None:
    """Write a whole file under a temporary name, then rename: a retried task leaves the same file."""
    if uri.startswith("file://") or "://" not in uri:
        path = uri.removeprefix("file://")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        temp = f"{path}.{uuid.uuid4().hex}.tmp"
        with open(temp, "wb") as f:
            for p in parts:
                f.write(p)
        os.replace(temp, path)
        return
    store, path = _filesystem(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temp) as f:
        for p in parts:
            f.write(p)
    store.move(temp, path)


def file_size(uri: str) -> int:
    if uri.startswith("file://") or "://" not in uri:
        return os.path.getsize(uri.removeprefix("file://"))
    store, path = _filesystem(uri)
    return store.get_file_info(path).size


def read_file(uri: str, start: int = 0, size: int | None = None) -> bytes:
    """Bytes of a file, or size of them from start."""
    if uri.startswith("file://") or "://" not in uri:
        with open(uri.removeprefix("file://"), "rb") as f:
            f.seek(start)
            return f.read() if size is None else f.read(size)
    store, path = _filesystem(uri)
    with store.open_input_file(path) as f:
        f.seek(start)
        return f.read() if size is None else f.read(size)
