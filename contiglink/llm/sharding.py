"""Sharding by jump consistent hashing.

A row's key is mixed to 64 bits, and the jump sequence of Lamping and Veach (2014) gives its shard without a ring
table: going from n to n + 1 shards moves a row either nowhere or to the new shard. Slots number a shard's rows
from 0: rows are dealt to blocks of a shard by key and checksum, numbered in their block, and offset by the sizes of
the blocks before, so that no task holds a whole shard.

A null key counts as one fixed key. Null texts have size 0 (plus the 8 bytes) and the checksum of nothing, 0.
Repeated rows get slots of their own; an empty table gives an empty result. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .hashing import mix

BLOCK_ROWS = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to shards - 1, of each 64-bit key."""
    key, b, j = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        b[live] = j[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        j[live] = ((b[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live = live[j[live] < shards]
    return b.astype(np.int32)


def shards_of(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard (the shard if there were one more) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = mix(pc.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(jump(keys, shards)), pa.array(jump(keys, shards + 1))], [*batch.schema.names, "shard", "grown_shard"])

    rows = docs.select(
        F.col(key_col).cast("long").alias(key_col),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col)), F.lit(0)).cast("long").alias("text_crc32"),
    )
    dealt = staged(rows.mapInArrow(run, f"`{key_col}` long, size long, text_crc32 long, shard int, grown_shard int"), "dealt")
    blocks = max(1, -(-dealt.count() // (shards * block_rows)))
    number = F.pmod(F.coalesce(key_col, F.lit(-1)), F.lit(blocks)) + F.pmod("text_crc32", F.lit(blocks))  # of one key, by text
    dealt = dealt.withColumn("block", F.pmod(number, F.lit(blocks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "block").count().select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "block").orderBy(key_col, "text_crc32", "size")) - 1
    return dealt.withColumn("place", place).join(offsets, ["shard", "block"]).select(
        key_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"), "grown_shard"
    )
