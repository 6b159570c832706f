"""Registered queries: every operator of the analysis on the relations derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LEVELS, RANKS, Config
from ..functions.names import clean_region_name, orf_id, ranks_of
from ..operators import alignment, annotate, clustering, events, gene_clusters, graph, orfs, overlaps, regions, reports, taxonomy
from .. import schemas
from ..sources import fasta, tables
from ..pipeline import Analysis
from ..sources.staging import fresh_path, shuffles_end
from .fixtures import with_fixtures
from .oracle import oracle_sql  # noqa: F401  (part of this module's interface)

SHARED = ["fx_orf"]
SCORING = alignment.Scoring(alphabet=16)
#: Letters of a fixture's sequences that lie on disk as FASTA files at once.
SLICE = 2_000_000_000
#: Letters of a chunk: the test tables' sequences are short, and most of them should run over several.
CHUNK = 1000
#: 0.3 puts rows on both sides of the duplicate threshold in the test tables.
CONFIG = Config(max_overlap=0.3)


class Relations(Analysis):
    """The analysis on relations derived from the test tables, which are written as files and read as such."""

    def __init__(self, spark: SparkSession, sf_dir: str, config: Config = CONFIG):
        super().__init__(config)
        self.spark, self.sf_dir = spark, sf_dir
        self.made: dict[str, str] = {}

    def fixture(self, name: str) -> DataFrame:
        """A fixture; those that most others are made of are written once."""
        for shared in SHARED[: SHARED.index(name) if name in SHARED else None]:
            if shared not in self.made:
                with shuffles_end(self.spark):
                    self.fixture(shared).write.parquet(path := fresh_path(self.spark, shared))
                self.scratch.paths.append(path)
                self.made[shared] = f"parquet.`{path}`"
        return self.spark.sql(f"with {with_fixtures(lambda n: f'parquet.`{self.sf_dir}/{n}.parquet`', self.made)} select * from {name}")

    def file(self, name: str, *columns) -> str:
        """A fixture as a TSV file."""
        return self.written(self.fixture(name).select(*columns or "*"), name)

    def written(self, df: DataFrame, label: str, header: bool = False) -> str:
        with shuffles_end(self.spark):
            tables.write_tsv(df, path := fresh_path(self.spark, label), header=header, compression="gzip")
        self.scratch.paths.append(path)
        return path

    def reread(self, read: Callable, df: DataFrame, label: str) -> DataFrame:
        """A relation as it comes back from its file, which is not needed any more then."""
        out = self.keep(read(self.spark, path := self.written(df, f"{label}-file")), label)
        self.scratch.drop(path)
        return out

    clusters = cached_property(lambda self: tables.read_clusters(self.spark, self.file("fx_clusters")))
    coords = cached_property(lambda self: tables.read_coords(self.spark, self.file("fx_coords", "orf", "start_bp", "end_bp", "strand", "metadata")))
    fai = cached_property(lambda self: tables.read_fai(self.spark, self.file("fx_fai", "contig", "length", *(F.lit(0).alias(x) for x in ("offset", "linebases", "linewidth")))))
    gene_taxonomy = cached_property(lambda self: self.keep(self.fixture("fx_gene_taxonomy"), "gene-taxonomy"))
    taxa = cached_property(lambda self: self.keep(taxonomy.taxon_numbers(self.gene_taxonomy), "taxa"))
    contig_vote = cached_property(lambda self: self.keep(taxonomy.lineage_vote(self.gene_taxonomy, self.taxa, "contig"), "contig-vote"))
    contig_taxonomy = cached_property(lambda self: self.reread(tables.read_contig_taxonomy, self.contig_vote, "contig-taxonomy"))
    hits = cached_property(lambda self: self.fixture("fx_hits"))

    def indexed(self, sequences: DataFrame, label: str) -> DataFrame:
        """The index of sequences, written as FASTA files with 60 letters a line."""
        lines = sequences.withColumn("sequence", F.regexp_replace("sequence", "(.{60})", "$1\n"))
        with shuffles_end(self.spark):
            tables.write_fasta(lines, path := fresh_path(self.spark, label))
        self.scratch.paths.append(path)
        return self.keep(fasta.index_fasta_file(self.spark, path), "sequence-index")

    def of_sequences(self, read: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
        """What is read through the index of fx_sequences. Their files are written, indexed, read and removed for so many contigs at a time that they stay within SLICE letters."""
        if "fx_fai" not in self.made:
            self.made["fx_fai"] = f"parquet.`{self.scratch.staged_path(self.fixture('fx_fai'), 'fx_fai')}`"
        letters = self.fixture("fx_fai").agg(F.sum("length")).first()[0] or 0
        slices, out = int(-(-letters // SLICE)) or 1, []
        for k in range(slices):
            own = self.fixture("fx_sequences").where(F.pmod(F.xxhash64("name"), F.lit(slices)) == k)
            before = len(self.scratch.paths)
            index = self.indexed(own, "fx_sequences")
            files = self.scratch.paths[before:]
            out.append(self.keep(read(index), label))
            for path in files:
                self.scratch.drop(path)
        return reduce(DataFrame.unionByName, out)

    genome_index = cached_property(lambda self: self.indexed(self.fixture("fx_genome"), "fx_genome"))
    genes = cached_property(lambda self: self.keep(self.fixture("fx_gene_sequences"), "genes"))
    candidates = cached_property(lambda self: gene_clusters.kmer_candidates(self.genes, self.config.min_seq_id, self.config.min_cover))

    @cached_property
    def region_vote(self) -> DataFrame:
        """The vote of a region's own genes."""
        genes = self.gene_taxonomy.select("orf", "lineage", "weight")
        return self.keep(taxonomy.lineage_vote(regions.region_orfs(self.metadata).join(genes, "orf"), self.taxa, "region_idx", sizes=self.metadata.select("region_idx", "orf_cts")), "region-vote")

    @cached_property
    def region_taxonomy(self) -> DataFrame:
        """As extraction names regions and the aligner's table is read."""
        title = F.concat("region_title", F.lit("::"), "contig", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string"))
        named = self.region_vote.join(self.metadata.select("region_idx", title.alias("region")), "region_idx").select("region", *self.region_vote.columns[1:])
        return self.reread(tables.read_region_taxonomy, named, "region-taxonomy")


_relations: dict[tuple[str, str], Relations] = {}


def relations(spark: SparkSession, sf_dir: str) -> Relations:
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _relations:
        _relations[key] = Relations(spark, sf_dir)
    return _relations[key]


def _level_view(df: DataFrame, a: str, b: str, names: list[str]) -> DataFrame:
    return events.level_rows(df).select(*names, *(f"{r}_{s}" for s in (a, b) for r in RANKS), "hgt_level")


def _hits(r: Relations, which: str) -> DataFrame:
    return annotate.best_hits(r.hits, *getattr(r.config, which))


#: name -> relation of the analysis
VIEWS: dict[str, Callable[[Relations], DataFrame]] = {
    "scan_clusters": lambda r: r.clusters,
    "scan_coords": lambda r: r.coords,
    "scan_fai": lambda r: r.fai,
    "orf_parse": lambda r: r.orfs,
    "orf_id_build": lambda r: r.orfs.select(orf_id(F.col("contig"), F.col("orf_n")).alias("orf")),
    "cluster_rep_members": lambda r: clustering.cluster_rep_members(r.clusters),
    "contig_orf_counts": lambda r: overlaps.contig_orf_counts(r.orfs, r.config.minimum_orfs),
    "allvall": lambda r: overlaps.all_pairs(r.passing).select("cluster_rep", "contig1", "contig2", "orf_n1", "orf_n2"),
    "pair_overlaps": lambda r: r.pairs,
    "dedup_overlaps": lambda r: r.overlaps,
    "redundant_overlaps": lambda r: r.redundant,
    "overlap_status": lambda r: r.status,
    "overlap_accounting": lambda r: overlaps.overlap_accounting(r.orfs, r.passing, r.status),
    "contig_clusters": lambda r: r.contig_clusters,
    "cluster_accounting": lambda r: clustering.cluster_accounting(r.redundant, r.contig_clusters),
    "overlap_orf_coords": lambda r: r.orf_coords,
    "potential_hgts_bed": lambda r: r.bed,
    "merge_intervals": lambda r: r.merged,
    "region_metadata": lambda r: r.metadata,
    "region_orfs": lambda r: regions.region_orfs(r.metadata),
    "region_overlaps": lambda r: r.region_overlaps,
    "filter_reciprocals": lambda r: regions.filter_reciprocals(r.region_overlaps),
    "region_slop": lambda r: regions.region_slop(r.metadata, r.config.slop),
    "extract_regions": lambda r: r.of_sequences(lambda index: fasta.fasta_ranges(regions.region_slop(r.metadata, r.config.slop), index).select("name", "part", F.length("sequence").alias("letters"), F.md5("sequence").alias("sequence_md5")), "extracted"),
    "fasta_index_file": lambda r: r.of_sequences(lambda index: index.select("contig", "length", "linebases", "linewidth"), "index"),
    "orf_scan": lambda r: orfs.orf_scan(fasta.fasta_ranges(orfs.chunks_of(r.genome_index, CHUNK), r.genome_index), r.genome_index, chunk=CHUNK),
    "kmer_candidates": lambda r: r.candidates,
    "gene_clusters": lambda r: gene_clusters.greedy_clusters(r.genes, r.candidates, r.config.min_seq_id, r.config.min_cover),
    "aligned_hits": lambda r: annotate.best_hits(alignment.seeded_alignment(r.genes, r.fixture("fx_subjects"), SCORING, k=8), 90, 80, 50).withColumns({"bitscore": F.round("bitscore", 6), "evalue": F.round("evalue", 12)}),
    "scan_overlaps": lambda r: tables.read_overlaps(r.spark, r.written(r.overlaps, "overlaps", header=True)),
    "scan_merged_bed": lambda r: tables.read_merged_bed(r.spark, r.written(r.merged, "merged-bed")),
    "scan_region_metadata": lambda r: tables.read_region_metadata(r.spark, r.written(r.metadata.select(*(x.split()[0] for x in schemas.REGION_METADATA.split(", "))), "metadata", header=True)),
    "scan_region_overlaps": lambda r: tables.read_region_overlaps(r.spark, r.written(r.region_overlaps, "region-overlaps", header=True)),
    "extract_regions_whole": lambda r: regions.extract_regions(r.fixture("fx_cuts_whole"), r.fixture("fx_fasta")),
    "fasta_index": lambda r: tables.fasta_index(r.fixture("fx_fasta")),
    "orf_header_parse": lambda r: tables.parse_orf_headers(r.fixture("fx_headers")),
    "parse_lineage": lambda r: r.fixture("fx_contig_taxonomy").select("contig", *(c.alias(n) for n, c in ranks_of(F.col("lineage")).items())),
    "scan_taxonomy": lambda r: tables.read_contig_taxonomy(r.spark, r.file("fx_contig_taxonomy")),
    "lineage_vote": lambda r: r.contig_vote,
    "region_lineage_vote": lambda r: r.region_vote,
    "region_name_clean": lambda r: r.metadata.select("region_idx", clean_region_name(F.concat("region_title", F.lit("::"), "contig", F.lit(":"), F.col("start").cast("string"))).alias("region")),
    "criteria1_input": lambda r: r.criteria1,
    "criteria2_input": lambda r: r.criteria2,
    "hgt1_levels": lambda r: _level_view(r.few1, "region", "contig", ["region_idx", "contig"]),
    "hgt2_levels": lambda r: _level_view(r.few2, "contig1", "contig2", ["orf_region1", "orf_region2"]),
    "hgt1_level_counts": lambda r: events.level_counts(r.few1),
    "hgt2_level_counts": lambda r: events.level_counts(r.few2),
    "all_hgt1": lambda r: r.all_hgt1,
    "all_hgt2": lambda r: r.all_hgt2,
    "donor_recipient": lambda r: r.donors,
    "donor_level_counts": lambda r: events.donor_level_counts(r.donors),
    "all_donor_recipient": lambda r: events.all_donor_recipient(r.donors),
    "hgt_components": lambda r: r.components,
    "hgt_groups": lambda r: r.groups,
    "group_report": lambda r: reports.group_report(r.groups),
    "order_graph_edges": lambda r: r.order_edges,
    "graph_degrees": lambda r: graph.graph_degrees(r.order_edges),
    "order_graph_pagerank": lambda r: graph.pagerank(r.order_edges).select("node", F.round("page_rank", 6).alias("page_rank")),
    "order_graph_stats": lambda r: graph.graph_stats(r.order_edges).withColumn("page_rank", F.round("page_rank", 6)),
    "hgt2_undirected_level_counts": lambda r: events.level_counts(events.undirected(r.few2)),
    "event_counts": lambda r: reports.event_counts(r.all_hgt1, r.linked, r.donors, r.components),
    "annot_ripdb": lambda r: _hits(r, "rip"),
    "annot_card": lambda r: _hits(r, "arg"),
    "annot_mobileog": lambda r: _hits(r, "mge"),
}
assert len(LEVELS) == len(RANKS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, view=view: view(relations(spark, sf_dir))) for name, view in VIEWS.items()}
