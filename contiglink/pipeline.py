"""The whole analysis from files to files, step by step or in parts.

    from contiglink.pipeline import run
    run(spark, {"clusters": ..., "coords": ..., "fai": ..., "fasta": ..., "contig_taxonomy": ..., "region_taxonomy": ...}, out)

What is written depends on the inputs given. `clusters` (or `genes`, to be clustered), `coords` and `fai` give the overlap tables; these, or
`overlaps` with `merged_bed` or `bed`, and `fai` the region tables; `fasta` adds the region sequences; the two
taxonomies add the event tables, from computed regions or from `region_metadata` and `region_overlaps`. A table is a
folder of parts under `out`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import LEVELS, RANKS, Config
from .operators import clustering, events, gene_clusters, graph, overlaps, regions, reports
from .sources import fasta, inputs, single, tables
from .sources.staging import Scratch, staged


class Analysis:
    """The relations of an analysis, made when asked for. A relation that is given is taken as it is.

    Steps that several others use are written to the shared folder; close() removes them.
    """

    def __init__(self, config: Config = Config(), **given: DataFrame):
        self.config, self.scratch = config, Scratch()
        self.__dict__.update(given)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        return self.scratch.staged(df, label)

    def close(self) -> None:
        self.scratch.clear()

    orfs = cached_property(lambda self: overlaps.parse_orfs(self.clusters))
    passing = cached_property(lambda self: self.keep(overlaps.passing_orfs(self.orfs, self.config.minimum_orfs), "passing"))
    pairs = cached_property(lambda self: self.keep(overlaps.pair_overlaps(self.passing), "pairs"))
    overlaps = cached_property(lambda self: overlaps.dedup_overlaps(self.pairs, self.config.max_overlap))
    redundant = cached_property(lambda self: overlaps.redundant_overlaps(self.pairs, self.config.max_overlap))
    status = cached_property(lambda self: overlaps.overlap_status(self.pairs, self.config.max_overlap))
    contig_clusters = cached_property(lambda self: clustering.contig_clusters(self.redundant))
    shared = cached_property(lambda self: self.keep(overlaps.shared_orf_coords(self.overlaps, self.coords, self.fai), "shared-orfs"))
    orf_coords = cached_property(lambda self: overlaps.overlap_orf_coords(self.shared))
    bed = cached_property(lambda self: overlaps.potential_hgts_bed(self.shared))
    merged = cached_property(lambda self: self.keep(regions.merge_intervals(self.bed, self.config.merge_distance), "merged"))
    metadata = cached_property(lambda self: self.keep(regions.region_metadata(self.merged, self.fai, self.config.edge_padding, self.config.min_region_len), "regions"))
    region_overlaps = cached_property(lambda self: self.keep(regions.region_overlaps(self.metadata, self.overlaps), "region-overlaps"))
    criteria1 = cached_property(lambda self: self.keep(self.plan1, "criterion1"))
    criteria2 = cached_property(lambda self: self.keep(self.plan2, "criterion2"))
    levels1 = cached_property(lambda self: events.with_levels(self.criteria1, "region", "contig", self.config.strict))
    levels2 = cached_property(lambda self: events.with_levels(self.criteria2, "contig1", "contig2", self.config.strict))
    donors = cached_property(lambda self: self.keep(events.donor_recipient(self.few1, self.rows2), "donors"))
    all_hgt1 = cached_property(lambda self: events.all_criterion1(self.metadata, self.region_taxonomy, self.contig_taxonomy, self.config))
    all_hgt2 = cached_property(lambda self: events.all_criterion2(self.region_overlaps, self.contig_taxonomy, self.config))
    linked = cached_property(lambda self: self.keep(reports.linked_regions(self.all_hgt2), "linked-regions"))
    components = cached_property(lambda self: self.keep(reports.hgt_components(self.linked), "components"))
    groups = cached_property(lambda self: self.keep(reports.hgt_groups(self.components, self.metadata, self.contig_taxonomy, self.region_overlaps), "groups"))
    order_edges = cached_property(lambda self: self.keep(graph.order_graph_edges(self.few1), "order-graph"))

    # rows of both criteria for steps that read a few columns of them: as written, if they are already, else joined without the others
    plan1 = cached_property(lambda self: events.criteria1_input(self.metadata, self.region_taxonomy, self.contig_taxonomy, self.config))
    plan2 = cached_property(lambda self: events.criteria2_input(self.region_overlaps, self.contig_taxonomy, self.config))
    rows1 = property(lambda self: self.criteria1 if "criteria1" in self.__dict__ else self.plan1)
    rows2 = property(lambda self: self.criteria2 if "criteria2" in self.__dict__ else self.plan2)
    few1 = property(lambda self: events.with_levels(self.rows1, "region", "contig", self.config.strict))
    few2 = property(lambda self: events.with_levels(self.rows2, "contig1", "contig2", self.config.strict))


@dataclass
class Output:
    """A table to write: its rows, whether with a header, and the order that is asked for."""

    rows: DataFrame
    header: bool = True
    order: tuple = ()
    kind: str = "tsv"


def overlap_tables(a: Analysis) -> dict[str, Output]:
    return {
        "deduplicated_overlaps.tsv": Output(a.overlaps),
        "redundant_overlaps.tsv": Output(a.redundant),
        "overlap_out.tsv": Output(a.status, order=(F.desc(F.col("status") == "redundant"),)),
        "contig_clusters.tsv": Output(a.contig_clusters, header=False),
        "deduplicated_overlap_orfs_coords.tsv": Output(a.orf_coords),
        "potential_hgts.bed": Output(a.bed, header=False),
        "overlap_log.txt": Output(overlaps.overlap_accounting(a.orfs, a.passing, a.status), kind="log"),
        "clustering_log.txt": Output(clustering.cluster_accounting(a.redundant, a.contig_clusters), kind="log"),
    }


def region_tables(a: Analysis, index: DataFrame | None = None) -> dict[str, Output]:
    """index: of the contigs' FASTA files, through which the regions' sequences are read."""
    bed = a.metadata.select("contig", "start", "stop", "region_title")
    out = {
        "merged_potential_hgts.bed": Output(a.merged, header=False, order=("contig", "start")),
        "region_metadata.tsv": Output(a.metadata),
        "region_overlaps.tsv": Output(a.region_overlaps),
        "filtered_overlaps.tsv": Output(regions.filter_reciprocals(a.region_overlaps)),
        "potential_hgt_regions.bed": Output(bed, header=False),
    }
    if index is not None:
        out["potential_hgt_regions.fasta"] = Output(fasta.fasta_ranges(regions.region_slop(a.metadata, a.config.slop), index), kind="fasta")
    return out


def event_tables(a: Analysis) -> dict[str, Output]:
    a.criteria1, a.criteria2  # written first, as the tables of seven levels read them
    out = {"allHGT1.tsv": Output(a.all_hgt1), "allHGT2.tsv": Output(a.all_hgt2), "allDR.tsv": Output(events.all_donor_recipient(a.donors))}
    for level, rank in zip(LEVELS, RANKS):
        out[f"{level}1.tsv"] = Output(events.level_table(a.levels1, level))
        out[f"{level}2.tsv"] = Output(events.level_table(a.levels2, level))
        out[f"{level}1_DR.tsv"] = Output(a.donors.where(F.col("hgt_level") == level).drop("hgt_level").withColumnRenamed("shared_taxon", f"{rank}_shared_taxon"))
    out["hgt_groups.tsv"] = Output(a.groups, order=("hgt_group_id", "region_idx"))
    out["hgt_report.tsv"] = Output(reports.group_report(a.groups), order=(F.desc("hgt_group_size"), "hgt_group_id"))
    out["event_log.txt"] = Output(reports.event_counts(a.all_hgt1, a.linked, a.donors, a.components), kind="log")
    if not a.order_edges.isEmpty():
        out["oHGT1.graph_stats.tsv"] = Output(graph.graph_stats(a.order_edges))
    return out


def write(outputs: dict[str, Output], folder: str, one_file: bool = False) -> list[str]:
    """one_file: tables that ask for an order become one file each instead of a folder of parts."""
    for name, o in outputs.items():
        path = f"{folder.rstrip('/')}/{name}"
        o.kind = "single" if one_file and o.order and o.kind == "tsv" else o.kind
        if o.kind == "log":
            tables.write_log(o.rows, path)
        elif o.kind == "fasta":
            fasta.write_parts(o.rows, path)
        elif o.kind == "single":
            single.write_single(o.rows, path, o.header, list(o.order))
        else:
            tables.write_tsv(o.rows, path, o.header, list(o.order))
    return list(outputs)


READERS = {
    "clusters": tables.read_clusters,
    "coords": tables.read_coords,
    "fai": tables.read_fai,
    "overlaps": tables.read_overlaps,
    "bed": tables.read_bed,
    "merged_bed": tables.read_merged_bed,
    "fasta": fasta.index_fasta_file,
    "genes": tables.read_fasta,
    "region_metadata": tables.read_region_metadata,
    "region_overlaps": tables.read_region_overlaps,
    "contig_taxonomy": tables.read_contig_taxonomy,
    "region_taxonomy": tables.read_region_taxonomy,
}


def run(spark: SparkSession, paths: dict[str, str], out: str, config: Config = Config(), one_file: bool = False) -> list[str]:
    """Check and read the files given, write every table they allow for to folders under out, and return these' names.

    Gene clusters are made of `genes`, the genes' FASTA files, where `clusters` are not given.
    """
    inputs.resolve(spark, paths)
    given = {name: READERS[name](spark, path) for name, path in paths.items()}
    index, genes = given.pop("fasta", None), given.pop("genes", None)
    if index is not None:
        index = staged(index, "fasta-index")
        given.setdefault("fai", index.select("contig", "length"))
    if genes is not None and "clusters" not in given:
        given["clusters"] = gene_clusters.cluster_genes(genes, config.min_seq_id, config.min_cover)
    given = {{"merged_bed": "merged", "region_metadata": "metadata"}.get(k, k): v for k, v in given.items()}
    a, done = Analysis(config, **given), []
    if {"clusters", "coords", "fai"} <= set(given):
        done += write(overlap_tables(a), out, one_file)
    if "fai" in given and ({"clusters", "coords"} <= set(given) or "overlaps" in given and {"merged", "bed"} & set(given)):
        done += write(region_tables(a, index), out, one_file)
    if {"contig_taxonomy", "region_taxonomy"} <= set(given) and (done or {"metadata", "region_overlaps"} <= set(given)):
        done += write(event_tables(a), out, one_file)
    a.close()
    if not done:
        raise ValueError(f"nothing can be made of {sorted(paths)} alone")
    return done
