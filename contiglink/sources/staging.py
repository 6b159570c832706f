"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see, from spark.checkpoint.dir.

    Only where the cluster names none (tests on one machine) is a temporary one set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    return _staged(df, fresh_path(df.sparkSession, label))


def _staged(df: DataFrame, path: str) -> DataFrame:
    with shuffles_end(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(path: str) -> None:
    if path.startswith("file://") or "://" not in path:
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        return
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path)
    store.delete_dir(inside)


class Scratch:
    """Staged tables that are removed together, once what was made of them is staged elsewhere."""

    def __init__(self):
        self.paths: list[str] = []

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(path := fresh_path(df.sparkSession, label))
        return _staged(df, path)

    def staged_path(self, df: DataFrame, label: str) -> str:
        """Where the table is staged."""
        self.staged(df, label)
        return self.paths[-1]

    def measured(self, df: DataFrame, label: str, measure: Column) -> tuple[DataFrame, int]:
        """The staged table and a count or sum over it (0 without rows), observed while it is written: no job of its own."""
        seen = Observation()
        table = self.staged(df.observe(seen, measure.alias("n")), label)
        return table, seen.get.get("n") or 0

    def drop(self, path: str) -> None:
        self.paths.remove(path)
        remove(path)

    def clear(self, keep_last: int = 0) -> None:
        old = self.paths[: len(self.paths) - keep_last]
        self.paths = self.paths[len(old) :]
        for path in old:
            remove(path)
