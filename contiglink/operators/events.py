"""Lineage discordance: two criteria at seven ranks, and putative donors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEVELS, RANKS, Config

TAXON_COLUMNS = ("taxid", "level", "taxa", "fragments", "returned", "agreed", "percent_agreed", *RANKS)


def suffixed(df: DataFrame, suffix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(c) if c in keep else F.col(c).alias(f"{c}_{suffix}") for c in df.columns))


def criteria1_input(metadata: DataFrame, region_taxonomy: DataFrame, contig_taxonomy: DataFrame, config: Config) -> DataFrame:
    """Regions with their own and their contig's taxonomy, where both are known and the region's is supported."""
    regions = region_taxonomy.where((F.col("taxid") > 1) & (F.col("fragments") >= config.min_fragments) & (F.col("returned") >= config.min_returned) & (F.col("agreed") >= config.min_agreed))
    joined = metadata.join(suffixed(regions, "region", ("region",)), F.col("region_title") == F.col("region"))
    return joined.join(suffixed(contig_taxonomy.where("taxid > 1"), "contig", ("contig",)), "contig")


def criteria2_input(overlaps: DataFrame, contig_taxonomy: DataFrame, config: Config) -> DataFrame:
    """Region overlaps with both contigs' taxonomy, where both are known and supported."""
    known = contig_taxonomy.where((F.col("taxid") > 1) & (F.col("fragments") >= config.min_fragments) & (F.col("returned") >= config.min_returned) & (F.col("agreed") >= config.min_agreed))
    side = lambda k: suffixed(known, f"contig{k}", ("contig",)).withColumnRenamed("contig", f"contig{k}")
    return overlaps.join(side(1), "contig1").join(side(2), "contig2")


def level_flags(a: str, b: str, strict: bool = False) -> dict[str, Column]:
    """For each rank, whether two lineages first differ there: both known, the rank above equal (strict: all above)."""
    known = lambda r: F.col(f"{r}_{a}").isNotNull() & F.col(f"{r}_{b}").isNotNull() & (F.col(f"{r}_{a}") != "None") & (F.col(f"{r}_{b}") != "None")
    same = lambda r: F.col(f"{r}_{a}") == F.col(f"{r}_{b}")
    out = {}
    for k, r in enumerate(RANKS):
        above = RANKS[:k] if strict else RANKS[max(0, k - 1) : k]
        out[LEVELS[k]] = F.coalesce(reduce(lambda x, y: x & y, [known(r), ~same(r), *map(same, above)]), F.lit(False))
    return out


def with_levels(df: DataFrame, a: str, b: str, strict: bool = False) -> DataFrame:
    """One boolean column a level; a row may fit several when ranks are not nested."""
    return df.withColumns(level_flags(a, b, strict))


def level_rows(df: DataFrame) -> DataFrame:
    """A row for each level that a row fits, with the level's name."""
    levels = F.filter(F.array(*(F.when(F.col(x), x) for x in LEVELS)), lambda x: x.isNotNull())
    return df.withColumn("hgt_level", F.explode(levels)).drop(*LEVELS)


def undirected(df: DataFrame) -> DataFrame:
    """Criterion-2 rows in one direction: each pair of ORFs once."""
    return df.where(F.struct("contig1", "region_idx_contig1", "orf_region1") <= F.struct("contig2", "region_idx_contig2", "orf_region2"))


def level_table(df: DataFrame, level: str) -> DataFrame:
    """The rows at one level, without the flags."""
    return df.where(level).drop(*LEVELS)


def level_counts(df: DataFrame) -> DataFrame:
    """Rows at each of the seven levels, in one pass."""
    one = df.agg(*(F.count(F.when(F.col(x), 1)).alias(x) for x in LEVELS))
    return one.select(F.explode(F.array(*(F.struct(F.lit(x).alias("hgt_level"), F.col(x).alias("instances")) for x in LEVELS))).alias("r")).select("r.*")


def all_levels(df: DataFrame, unique: bool = False) -> DataFrame:
    """Distinct rows at any level, without the flags. unique: rows are known to be distinct."""
    rows = df.where(reduce(lambda x, y: x | y, map(F.col, LEVELS))).drop(*LEVELS)
    return rows if unique else rows.distinct()


def all_criterion1(metadata: DataFrame, region_taxonomy: DataFrame, contig_taxonomy: DataFrame, config: Config) -> DataFrame:
    """Distinct criterion-1 rows at any level: of distinct regions and taxonomies, as all_criterion2."""
    joined = criteria1_input(metadata.distinct(), region_taxonomy.distinct(), contig_taxonomy.distinct(), config)
    return all_levels(with_levels(joined, "region", "contig", config.strict), unique=True)


def all_criterion2(overlaps: DataFrame, contig_taxonomy: DataFrame, config: Config) -> DataFrame:
    """Distinct criterion-2 rows at any level: of distinct overlaps and taxonomies, whose columns the rows all have, so that the wide rows need no comparison."""
    joined = criteria2_input(overlaps.distinct(), contig_taxonomy.distinct(), config)
    return all_levels(with_levels(joined, "contig1", "contig2", config.strict), unique=True)


def donor_recipient(events: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Donor pairs by level: an overlapping region's contig has the event region's taxon at that rank.

    events: criterion-1 rows with level flags. All ranks are matched in one join on the region.
    """
    e = events.where(reduce(lambda x, y: x | y, map(F.col, LEVELS))).select(F.col("contig").alias("recipient"), F.col("region_idx").alias("recipient_region_idx"), *LEVELS, *(f"{r}_region" for r in RANKS)).distinct()
    o = overlaps.select(F.col("region_idx_contig1").alias("recipient_region_idx"), F.col("contig2").alias("donor"), F.col("region_idx_contig2").alias("donor_region_idx"), *(f"{r}_contig2" for r in RANKS)).distinct()
    hits = F.filter(
        F.array(*(F.when(F.col(x) & (F.col(f"{r}_region") == F.col(f"{r}_contig2")), F.struct(F.lit(x).alias("hgt_level"), F.col(f"{r}_region").alias("shared_taxon"))) for x, r in zip(LEVELS, RANKS))),
        lambda x: x.isNotNull(),
    )
    return e.join(o, "recipient_region_idx").select("recipient", "recipient_region_idx", "donor", "donor_region_idx", F.explode(hits).alias("h")).select("recipient", "recipient_region_idx", "donor", "donor_region_idx", "h.*").distinct()


def all_donor_recipient(donors: DataFrame) -> DataFrame:
    """Donor pairs of all levels with one shared-taxon column a rank; a level fills its own."""
    return donors.select("recipient", "recipient_region_idx", "donor", "donor_region_idx", *(F.when(F.col("hgt_level") == x, F.col("shared_taxon")).alias(f"{r}_shared_taxon") for x, r in zip(LEVELS, RANKS))).distinct()


def donor_level_counts(donors: DataFrame) -> DataFrame:
    one = donors.agg(*(F.count(F.when(F.col("hgt_level") == x, 1)).alias(x) for x in LEVELS))
    return one.select(F.explode(F.array(*(F.struct(F.lit(x).alias("hgt_level"), F.col(x).alias("instances")) for x in LEVELS))).alias("r")).select("r.*")
