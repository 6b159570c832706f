"""Lineages of contigs and regions from those of their genes: weighted votes for the lowest common ancestor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RANKS

#: Names of the seven ranks, and what stands where there is no taxon.
RANK_NAMES = ("domain", "phylum", "class", "order", "family", "genus", "species")
UNKNOWN, ROOT = (0, "no rank", "unclassified"), (1, "no rank", "root")


#: A contig or region of more genes has them dealt out; the genes of one of fewer meet in one task.
CELL = 2000


def _depth(lineage: Column) -> Column:
    """Ranks of a lineage; more than seven raise."""
    n = F.length(lineage) - F.length(F.translate(lineage, ";", "")) + 1
    return F.when(n > len(RANKS), F.raise_error(F.lit("a lineage has more than seven ranks"))).otherwise(n)


def _ancestors(df: DataFrame, *keep: str) -> DataFrame:
    """The rows of df once for each ancestor of their lineage, from the domain (k = 0) down, itself included; once with nulls where there is none."""
    depths = F.when(F.col("lineage") != "", F.sequence(F.lit(0), _depth(F.col("lineage")) - 1))
    each = df.select(*keep, "lineage", F.explode_outer(depths).alias("k"))
    return each.select(*keep, "k", F.expr("substring_index(lineage, ';', k + 1)").alias("path"))


def taxon_numbers(lineages: DataFrame) -> DataFrame:
    """lineage and taxid of every taxon of a table of lineages with a number each, where no database numbers them."""
    distinct = lineages.where("lineage <> ''").groupBy("lineage").agg(F.min("number").alias("number"))
    least = _ancestors(distinct, "number").groupBy("k", "path").agg(F.min("number").alias("least"))
    return least.select(F.col("path").alias("lineage"), (F.col("least") * 8 + F.col("k") + 2).cast("long").alias("taxid"))


def _counted(votes: DataFrame, by: str, majority: float, dealt: bool) -> DataFrame:
    """by, fragments, returned, total, and k, w, n and path of the deepest ancestor with the majority.

    dealt: weights are summed by name and lineage, then by name and ancestor, so a name's genes never meet in one task
    as rows. Otherwise a name's genes are brought together once and stay so.
    """
    known = F.col("lineage") != ""
    rows = votes if dealt else votes.repartition(by)
    lineages = rows.groupBy(by, "lineage").agg(F.sum(F.col("weight").cast("double")).alias("weight"), F.count("*").alias("genes"))
    totals = {"fragments": F.sum("genes"), "returned": F.sum(F.when(known, F.col("genes")).otherwise(0)), "total": F.sum(F.when(known, F.col("weight")))}
    if dealt:
        whole = lineages.groupBy(by).agg(*(c.alias(n) for n, c in totals.items()))
        sums = _ancestors(lineages.where(known), by, "weight", "genes").groupBy(by, "k", "path").agg(F.sum("weight").alias("w"), F.sum("genes").alias("n"))
        sums = sums.join(whole.select(by, "total"), by)
        at = [by]
    else:
        over = Window.partitionBy(by)
        whole, at = None, [by, *totals]
        each = _ancestors(lineages.withColumns({n: c.over(over) for n, c in totals.items()}), *at, "weight", "genes")
        sums = each.groupBy(*at, "k", "path").agg(F.sum("weight").alias("w"), F.sum("genes").alias("n"))
    most = F.when(F.col("k").isNotNull() & (F.col("w") > majority * F.col("total")), F.struct("k", "w", "n", "path"))
    labels = sums.groupBy(*at).agg(F.max(most).alias("label"))
    return (labels if whole is None else whole.join(labels, by, "left")).select(by, *totals, "label.*")


def lineage_vote(votes: DataFrame, taxa: DataFrame, by: str = "name", majority: float = 0.5, sizes: DataFrame | None = None, cell: int = CELL) -> DataFrame:
    """The deepest taxon that more than `majority` of the weight of a contig's or region's genes agrees on.

    votes: a row a gene with `by`, its lineage (null or empty: nothing was found) and weight. taxa: lineage and taxid.
    Returns by, taxid, level, taxa, fragments (genes), returned (those with a lineage), agreed (those under the taxon),
    percent_agreed (their share of the weight, 0 to 1) and lineage. At most one taxon of a rank can have more than half, so no ties
    arise for majority >= 0.5; below it the heavier one, then the one with more genes, then the later in the alphabet wins. Names without any
    lineage are unclassified (taxid 0), those without a majority at any rank belong to the root (taxid 1).

    The genes of a name with more than `cell` of them are dealt out. sizes: `by` and genes of each name, where they
    are known; they only say which names are dealt out.
    """
    sizes = votes.groupBy(by).agg(F.count("*").alias("genes")) if sizes is None else sizes.toDF(by, "genes")
    large = sizes.where(F.col("genes") > cell).select(F.col(by).alias("large")).distinct()
    if large.isEmpty():
        named = _counted(votes, by, majority, False)
    else:
        few, many = (votes.join(large, F.col(by).eqNullSafe(F.col("large")), how) for how in ("left_anti", "left_semi"))
        named = _counted(few, by, majority, False).unionByName(_counted(many, by, majority, True))
    numbered = named.join(taxa.select(F.col("lineage").alias("path"), "taxid"), "path", "left")

    def pick(found: Column, place: int) -> Column:
        return F.when(F.col("returned") == 0, F.lit(UNKNOWN[place])).when(F.col("path").isNull(), F.lit(ROOT[place])).otherwise(found)

    return numbered.select(
        by,
        pick(F.col("taxid"), 0).cast("long").alias("taxid"),
        pick(F.get(F.array(*map(F.lit, RANK_NAMES)), F.col("k")), 1).alias("level"),
        pick(F.regexp_replace(F.substring_index("path", ";", -1), "^[a-z]_", ""), 2).alias("taxa"),
        "fragments",
        "returned",
        F.when(F.col("returned") == 0, 0).otherwise(F.coalesce("n", "returned")).cast("long").alias("agreed"),
        F.when(F.col("returned") == 0, 0.0).otherwise(F.coalesce(F.col("w") / F.col("total"), F.lit(1.0))).alias("percent_agreed"),
        F.col("path").alias("lineage"),
    )
