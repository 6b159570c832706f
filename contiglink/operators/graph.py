"""Graph operators: connected components, directed order graph, degrees, PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.staging import Scratch, staged
from .hot import hot_lookup

MAX_ROUNDS = 60
LARGE = 2_000_000  # edges from which on hubs get a plan of their own


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node that an edge names.

    Alternating large stars and small stars (Kiveris et al., 2014): each round links a node's larger neighbours, then
    its smaller ones, to the least of them, until every node points at its component's least. Each round's edges are
    written, so the lineage ends there, and the round before is removed; the state (number of edges and sum of their
    hashes) is observed while the edges and each round are written. Rows with a null end are left out.
    """
    rounds = Scratch()
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    apart = F.col("u") != F.col("v")
    measures = F.count(F.when(apart, 1)).alias("n"), F.coalesce(F.sum(F.when(apart, F.xxhash64("u", "v").cast("decimal(38,0)"))), F.lit(0)).alias("hash")
    both = staged(both.observe(first := Observation(), *measures), "edges")
    e, state = both.where(apart), first.get
    if not state.get("n"):  # each node alone, or none
        return both.toDF("node", "component")

    def point(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
        return rows.join(least.drop("n"), "u") if total < LARGE else hot_lookup(rows, least, ["u"], "n", 2 * total)

    for _ in range(MAX_ROUNDS):
        total = state["n"]
        # large star: every larger neighbour of u points at the least of u and its neighbours
        near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("w"), F.count("*").alias("n")).select("u", F.least("w", "u").alias("m"), "n")
        large = point(near.where("v > u"), least, total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = point(large, low, total).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        seen = Observation()
        e = rounds.staged(small.observe(seen, *measures), "star")
        rounds.clear(keep_last=1)
        if seen.get == state:
            break
        state = seen.get
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = e.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias("v"))
    alone = both.where("u = v").join(e.select(F.explode(F.array("u", "v")).alias("u")), "u", "left_anti")
    return e.unionByName(roots).unionByName(alone).toDF("node", "component")


def order_graph_edges(events: DataFrame) -> DataFrame:
    """donor_order, recipient_order and mean region length of order-level criterion-1 events with level flags."""
    rows = events.where("oHGT").select(F.col("o_region").alias("donor_order"), F.col("o_contig").alias("recipient_order"), "region_len").distinct()
    return rows.groupBy("donor_order", "recipient_order").agg(F.avg("region_len").alias("mean_region_len"))


def graph_degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array(F.struct(F.col("donor_order").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("recipient_order").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))).alias("e"))
    return ends.groupBy("e.node").agg(F.sum("e.i").alias("indegree"), F.sum("e.o").alias("outdegree"))


def pagerank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, rounds: int = 100) -> DataFrame:
    """node, page_rank over distinct directed edges; nodes without edges out spread their rank evenly.

    Rounds end when the ranks' total change is below the tolerance times the number of nodes; after the last
    round without that it raises.
    """
    temp = Scratch()
    e = staged(edges.select(F.col("donor_order").alias("src"), F.col("recipient_order").alias("dst")).distinct(), "order-edges")
    degree = e.groupBy("src").agg(F.count("*").alias("degree"))
    nodes = staged(e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(degree.withColumnRenamed("src", "node"), "node", "left"), "order-nodes")
    n, loose = nodes.agg(F.count("*"), F.count(F.when(F.col("degree").isNull(), 1))).first()
    loose = loose / max(n, 1)
    ranks = nodes.withColumn("page_rank", F.lit(1.0) / max(n, 1))
    for _ in range(rounds):
        given = ranks.where("degree is not null").join(e, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("page_rank") / F.col("degree")).alias("got"))
        new = ranks.withColumnRenamed("page_rank", "was").join(given, "node", "left").withColumn("page_rank", damping * (F.coalesce("got", F.lit(0.0)) + F.lit(loose) / max(n, 1)) + (1 - damping) / max(n, 1)).drop("got")
        seen = Observation()
        new = temp.staged(new.observe(seen, F.coalesce(F.sum(F.abs(F.col("page_rank") - F.col("was"))), F.lit(0.0)).alias("change"), F.coalesce(F.sum(F.when(F.col("degree").isNull(), F.col("page_rank"))), F.lit(0.0)).alias("loose")), "ranks")
        temp.clear(keep_last=1)
        ranks, loose = new.drop("was"), seen.get["loose"]
        if not n or seen.get["change"] < n * tolerance:
            return ranks.select("node", "page_rank")
    raise RuntimeError(f"page ranks did not settle in {rounds} rounds")


def graph_stats(edges: DataFrame) -> DataFrame:
    """node, page_rank, indegree and outdegree of every node."""
    return pagerank(edges).join(graph_degrees(edges), "node")
