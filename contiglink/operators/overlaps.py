"""Gene sharing between contigs: ORF pairs in clusters, duplicate-level and partial overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import contig_of, orf_id, ordinal_of

#: A gene cluster of more rows is paired in cells of so many by so many.
CELL = 2000


def parse_orfs(clusters: DataFrame) -> DataFrame:
    """cluster_rep, cluster_member, contig and ordinal of each member."""
    member = F.col("cluster_member")
    return clusters.select("cluster_rep", "cluster_member", contig_of(member).alias("contig"), ordinal_of(member).alias("orf_n"))


def contig_orf_counts(orfs: DataFrame, minimum_orfs: int) -> DataFrame:
    return orfs.groupBy("contig").agg(F.count("cluster_member").alias("total_orfs")).where(F.col("total_orfs") >= minimum_orfs)


def passing_orfs(orfs: DataFrame, minimum_orfs: int) -> DataFrame:
    """ORFs of contigs with enough ORFs, with the contig's total. The count is partial before its shuffle, and its join is split where a contig is skewed."""
    return orfs.join(contig_orf_counts(orfs, minimum_orfs), "contig").select(*orfs.columns, "total_orfs")


def all_pairs(passing: DataFrame) -> DataFrame:
    """Every ordered pair of ORFs in a cluster, pairs within a contig included."""
    side = lambda k: passing.select("cluster_rep", F.col("contig").alias(f"contig{k}"), F.col("orf_n").alias(f"orf_n{k}"), F.col("total_orfs").alias(f"total_orfs_ctg{k}"))
    return side(1).join(side(2), "cluster_rep")


def _half_pairs(passing: DataFrame, cell: int) -> DataFrame:
    """One direction of the ORF pairs of each cluster.

    Clusters are counted first, partially before the shuffle; those of more than `cell` rows are paired in cells of so
    many by so many, which are dealt out, so that neither their rows nor their pairs meet in one task.
    """
    rows = passing.select("cluster_rep", F.col("contig").alias("c"), F.col("orf_n").alias("n"), F.col("total_orfs").alias("t"))
    large = passing.groupBy("cluster_rep").agg(F.ceil(F.count("*") / cell).cast("int").alias("parts")).where("parts > 1")
    side = lambda df, k, *keys: df.select("cluster_rep", *keys, *(F.col(v).alias(f"{v}{k}") for v in ("c", "n", "t")))
    small = rows.join(large, "cluster_rep", "left_anti")
    plain = side(small, "a").join(side(small, "b"), "cluster_rep").where("ca < cb")
    dealt = rows.join(large, "cluster_rep").withColumn("own", F.pmod(F.xxhash64("c", "n"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = side(dealt, "a", F.col("own").alias("x"), every.alias("y")).join(side(dealt, "b", F.col("own").alias("y"), every.alias("x")), ["cluster_rep", "x", "y"]).where("ca < cb")
    return plain.unionByName(cells.drop("x", "y"))


def pair_overlaps(passing: DataFrame, cell: int = CELL) -> DataFrame:
    """A row for each ORF pair between different contigs, with the contig pair's count and both totals.

    One direction is joined and both are read off it, so the cluster join is half as wide; the count is a window over
    the contig pair rather than an aggregate joined back.
    """
    counted = _half_pairs(passing, cell).withColumn("co", F.count("*").over(Window.partitionBy("ca", "cb")))
    turn = lambda a, b: F.struct(
        F.col(f"c{a}").alias("contig1"), F.col(f"c{b}").alias("contig2"), F.col("co").alias("co_occur_cts"), F.col(f"t{a}").alias("total_orfs_ctg1"), F.col(f"t{b}").alias("total_orfs_ctg2"),
        F.least("ta", "tb").alias("smallest_contig_orfCts"), F.col(f"n{a}").alias("identical_orf_position_contig1"), F.col(f"n{b}").alias("identical_orf_position_contig2"),
    )
    return counted.select(F.explode(F.array(turn("a", "b"), turn("b", "a"))).alias("r")).select("r.*")


def _limit(max_overlap: float):
    return F.lit(float(max_overlap)) * F.col("smallest_contig_orfCts")


def dedup_overlaps(pairs: DataFrame, max_overlap: float) -> DataFrame:
    return pairs.where(F.col("co_occur_cts") < _limit(max_overlap))


def redundant_overlaps(pairs: DataFrame, max_overlap: float) -> DataFrame:
    return pairs.where(F.col("co_occur_cts") >= _limit(max_overlap))


def overlap_status(pairs: DataFrame, max_overlap: float) -> DataFrame:
    """Both sides in one pass; the reference order (redundant first) is a matter of the sink's sort."""
    return pairs.withColumn("status", F.when(F.col("co_occur_cts") >= _limit(max_overlap), "redundant").otherwise("non-redundant"))


def overlap_accounting(orfs: DataFrame, passing: DataFrame, status: DataFrame) -> DataFrame:
    """One row of counters over contigs."""
    seen = status.groupBy(F.col("contig1").alias("contig")).agg(F.max((F.col("status") == "redundant").cast("int")).alias("red"), F.max((F.col("status") != "redundant").cast("int")).alias("dedup"))
    ends = seen.agg(F.count("*").alias("overlapping"), F.coalesce(F.sum("red"), F.lit(0)).alias("redundant"), F.coalesce(F.sum(F.when(F.col("red") == 0, F.col("dedup"))), F.lit(0)).alias("unique"))
    start = orfs.agg(F.countDistinct("contig").alias("started"))
    passed = passing.agg(F.countDistinct("contig").alias("passing"))
    one = start.join(passed).join(ends)  # three tables of one row
    return one.select(
        F.col("started").alias("input_contigs"),
        F.col("passing").alias("passing_contigs"),
        (F.col("started") - F.col("passing")).alias("filtered_contigs"),
        (F.col("passing") - F.col("overlapping")).alias("singlet_contigs"),
        F.col("overlapping").alias("submitted_contigs"),
        F.col("unique").cast("long").alias("nonredundant_contigs"),
        F.col("redundant").cast("long").alias("redundant_contigs"),
        F.col("overlapping").alias("contigs_with_overlaps"),
        F.col("unique").cast("long").alias("dedup_contigs"),
    )


def shared_orf_coords(dedup: DataFrame, coords: DataFrame, fai: DataFrame) -> DataFrame:
    """contig, length, orf, start, end, strand, metadata of shared ORFs. Overlaps are symmetric, so one side names all."""
    one = dedup.select(F.col("contig1").alias("contig"), F.col("identical_orf_position_contig1").alias("n")).distinct()
    orfs = one.select("contig", orf_id(F.col("contig"), F.col("n")).alias("orf"))
    return orfs.join(coords, "orf").join(fai.select("contig", "length"), "contig").select("contig", "length", "orf", "start", "end", "strand", "metadata")


def overlap_orf_coords(shared: DataFrame) -> DataFrame:
    """The shared ORFs' coordinates once for each side of the overlaps."""
    return shared.withColumn("side", F.explode(F.array(F.lit(1), F.lit(2)))).drop("side")


def potential_hgts_bed(shared: DataFrame) -> DataFrame:
    return shared.select("contig", "start", "end", "strand", "orf").distinct()
