"""near_dedup runs no step on nothing: the driver's memory grows with the queries it plans, whatever the tables' size."""

import random
import time

import pytest
from pyspark.sql import SparkSession

from contiglink.llm import minhash
from contiglink.operators import graph


@pytest.fixture
def ran(spark):
    """How many queries a function ran, by Spark's own list of executions."""
    store = spark._jsparkSession.sharedState().statusStore()

    def run(f) -> int:
        before = store.executionsCount()
        f()
        time.sleep(1)  # the list is filled by a listener
        return store.executionsCount() - before

    assert isinstance(spark, SparkSession)
    return run


def words(r: random.Random, n: int) -> list[str]:
    return [f"w{r.randrange(10_000)}" for _ in range(n)]


def test_components_settle_at_once(spark, ran):
    star = spark.createDataFrame([(k, 0) for k in range(1, 40)] + [(50, 50)], "a long, b long")
    got = {}
    assert ran(lambda: got.update((x.node, x.component) for x in graph.connected_components(star, "a", "b").collect())) <= 3  # edges, one round, the result
    assert got == {k: 0 for k in range(40)} | {50: 50}
    assert ran(lambda: got.update((x.node, x.component) for x in graph.connected_components(star.where("a = b"), "a", "b").collect())) <= 2


def test_groups_of_one_component(spark, ran):
    r = random.Random(4)
    base = [words(r, 60) for _ in range(20)]
    texts = [" ".join(w if i else [*w[:30], "x", *w[30:]]) for w in base for i in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = []
    n = ran(lambda: kept.extend(x.doc_id for x in minhash.drop_near_duplicates(df).collect()))
    assert sorted(kept) == [3 * i for i in range(20)]
    assert n <= 20, n  # 52 before
