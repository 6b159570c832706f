"""Clusters of duplicate-level contigs: representatives by size, ties by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Scratch, staged
from .hot import hot_lookup


#: Overlapping contig pairs from which on hubs get a plan of their own.
LARGE = 2_000_000


def _edges(redundant: DataFrame) -> DataFrame:
    """A row a contig pair: sizes, and the number of ORF pairs."""
    return redundant.groupBy(F.col("contig1").alias("c1"), F.col("contig2").alias("c2"), F.col("total_orfs_ctg1").alias("n1"), F.col("total_orfs_ctg2").alias("n2")).agg(F.count("*").alias("orf_pairs"))


def contig_clusters(redundant: DataFrame, large: int = LARGE) -> DataFrame:
    """cluster_rep, cluster_member: self rows, then size-ranked leftovers (a row an ORF pair), then representatives' neighbours.

    1. Contigs larger than all their neighbours represent them.
    2. Among the contigs untouched by these, ties of size go to the lexicographically largest of a neighbourhood.
    3. What is left goes to larger contigs that have no larger neighbour left.

    Overlaps are symmetric, so what holds of a row's second contig is found under the same name as a first. Each step
    is a flag a contig, aggregated partially before its shuffle and looked up by the rows of its neighbours; in large
    tables the flags of hubs are broadcast to their rows (hot_lookup), so no task gets a hub's rows.
    """
    temp = Scratch()
    edges = temp.staged(_edges(redundant), "contig-pairs")
    flags = temp.staged(edges.groupBy("c1").agg(F.min(F.expr("n1 > n2")).alias("strict"), F.count("*").alias("n")), "contig-flags")
    total = flags.agg(F.sum("n")).first()[0] or 0
    at = lambda df, flag, end: df.select(F.col("c1").alias(f"c{end}"), F.col(flag).alias(f"{flag}{end}"), "n")
    near = hot_lookup(edges, at(flags, "strict", 2), ["c2"], "n", total, large).groupBy("c1").agg(F.max("strict2").alias("near"))
    untouched = temp.staged(flags.where("not strict").join(near.where("not near"), "c1").select("c1", F.lit(True).alias("rest"), "n"), "contig-flags")
    rest = hot_lookup(hot_lookup(edges, at(untouched, "rest", 1), ["c1"], "n", total, large), at(untouched, "rest", 2), ["c2"], "n", total, large)
    rest = temp.staged(rest.select("c1", "c2", "n1", "n2", "orf_pairs"), "contig-pairs")  # both ends untouched: far fewer rows
    other = lambda df: df.select(F.col("c1").alias("c2"))
    tied = rest.where("n1 = n2").select("c1").distinct()
    both = rest.join(tied, "c1", "left_semi").join(other(tied), "c2", "left_semi")
    ties = temp.staged(both.groupBy("c1").agg(F.min(F.expr("c1 >= c2")).alias("greatest")).where("greatest").select("c1"), "contig-flags")
    named = ties.union(rest.join(ties, "c1", "left_semi").select("c2")).distinct()
    left = rest.join(other(named), "c2", "left_anti")
    more = temp.staged(left.where("n1 > n2").join(left.where("n1 < n2").select("c1").distinct(), "c1", "left_anti"), "contig-pairs")
    reps = temp.staged(flags.where("strict").select("c1", "n").unionByName(flags.join(ties, "c1", "left_semi").select("c1", "n")), "contig-reps")
    pair = (F.col("c1").alias("cluster_rep"), F.col("c2").alias("cluster_member"))
    own = reps.select("c1").union(more.select("c1")).distinct().select(F.col("c1").alias("cluster_rep"), F.col("c1").alias("cluster_member"))
    repeated = more.select("c1", "c2", F.explode(F.sequence(F.lit(1), F.col("orf_pairs"))).alias("k")).select(*pair)
    out = staged(own.unionByName(repeated).unionByName(hot_lookup(edges, reps, ["c1"], "n", total, large).select(*pair)), "contig-clusters")
    temp.clear()
    return out


def cluster_accounting(redundant: DataFrame, clusters: DataFrame) -> DataFrame:
    by_size = redundant.groupBy("contig1").agg(F.min(F.expr("total_orfs_ctg1 >= total_orfs_ctg2")).alias("all")).where("all").agg(F.count("*").alias("size_selected_reps"))
    counts = clusters.agg(F.countDistinct("cluster_rep").alias("cluster_reps"), F.countDistinct("cluster_member").alias("cluster_members"))
    named = clusters.select(F.explode(F.array("cluster_rep", "cluster_member")).alias("c")).agg(F.countDistinct("c").alias("contigs_represented"))
    return by_size.join(counts).join(named)  # three tables of one row


def cluster_rep_members(clusters: DataFrame) -> DataFrame:
    """Members of each gene cluster, counted."""
    return clusters.groupBy("cluster_rep").agg(F.count("cluster_member").alias("members"))
