"""Joins against one row a key that stay even when few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on, so there are at most so many hot keys.
SHARE = 1000
#: Below this many rows no key can overload a task.
LEAST = 20_000


def hot_lookup(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int | None = None, least: int = LEAST) -> DataFrame:
    """Inner join of left with right, which has one row a key and in `count` how many rows of left have it.

    Rows of hot keys meet a broadcast of at most SHARE rows, so they stay where they are; all others are shuffled,
    and no key among them holds more than a SHARE-th of the rows. Both sides are divided by the keys' hashes, of which
    at most SHARE are hot: a row is filtered, not joined, to find its way. `count` is dropped.
    """
    kinds = [[df.schema[k].dataType for k in keys] for df in (left, right)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"keys {keys} of different types: {kinds}")
    if total is None:
        total = right.agg(F.sum(count)).first()[0] or 0
    if total < least:
        return left.join(right.drop(count), keys)
    way = F.xxhash64(*keys)
    hot = [r[0] for r in right.where(F.col(count) * SHARE > total).select(way).distinct().collect()]
    if not hot:
        return left.join(right.drop(count), keys)
    few = F.broadcast(right.where(way.isin(hot)).drop(count))
    rest = left.where(~way.isin(hot)).join(right.where(~way.isin(hot)).drop(count), keys)
    return left.where(way.isin(hot)).join(few, keys).unionByName(rest)


def dealt_join(left: DataFrame, right: DataFrame, key: str, spread: str, cell: int = 2000) -> DataFrame:
    """Inner join of left with wide rows of right, one a key: a key of more than `cell` rows of left is dealt by `spread` to as many copies of its row as it needs."""
    hot = left.groupBy(key).agg(F.ceil(F.count("*") / cell).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("part", F.pmod(F.xxhash64(spread), parts).cast("int")).drop("parts")
    copies = right.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt.join(copies, [key, "part"]).drop("part")
