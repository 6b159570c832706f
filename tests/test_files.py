"""The analysis from files to files, and the readers."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from contiglink import pipeline, schemas
from contiglink.config import LEVELS, RANKS
from contiglink.operators import annotate, clustering, events, overlaps, reports
from contiglink.plans.queries import CONFIG, Relations
from contiglink.sources import fasta, tables


def bag(df):
    return collections.Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_files_to_files(spark, sf, tmp_path):
    r = Relations(spark, sf)
    lineage = F.concat_ws(";", *(F.coalesce(F.concat(F.lit(f"{x}_"), x), F.lit("")) for x in RANKS))
    taxonomy = lambda df, key: df.select(key, *(c for c in events.TAXON_COLUMNS if c not in RANKS), F.when(F.col("d").isNotNull(), F.regexp_replace(lineage, ";+$", "")).alias("lineage"))
    inputs = {"clusters": r.clusters, "coords": r.coords, "fai": r.fai.select("contig", "length", *(F.lit(0).alias(x) for x in "abc")), "contig_taxonomy": taxonomy(r.contig_taxonomy, "contig"), "region_taxonomy": taxonomy(r.region_taxonomy, "region")}
    for name, df in inputs.items():
        tables.write_tsv(df, str(tmp_path / name), header=False)
    out = tmp_path / "out"
    done = pipeline.run(spark, {n: str(tmp_path / n) for n in inputs}, str(out), CONFIG)
    assert len(done) == 8 + 5 + 26 + 2 and {f"{x}{k}.tsv" for x in LEVELS for k in ("1", "2", "1_DR")} <= set(done)
    assert bag(tables.read_overlaps(spark, str(out / "deduplicated_overlaps.tsv"))) == bag(r.overlaps)
    assert bag(tables.read_merged_bed(spark, str(out / "merged_potential_hgts.bed"))) == bag(r.merged)
    assert bag(tables.read_region_metadata(spark, str(out / "region_metadata.tsv"))) == bag(r.metadata)
    assert bag(tables.read_region_overlaps(spark, str(out / "region_overlaps.tsv"))) == bag(r.region_overlaps)
    read = lambda name: spark.read.csv(str(out / name), sep="\t", header=True)
    assert read("allHGT2.tsv").count() == r.all_hgt2.count() and read("allHGT1.tsv").count() == r.all_hgt1.count() > 0
    assert {x: read(f"{x}2.tsv").count() for x in LEVELS} == {x.hgt_level: x.instances for x in events.level_counts(r.levels2).collect()}
    groups = [(int(x.hgt_group_id), x.region_idx) for p in sorted((out / "hgt_groups.tsv").glob("part-*.csv")) for x in spark.read.csv(str(p), sep="\t", header=True).coalesce(1).collect()]
    assert groups == sorted(groups) and len(groups) == r.groups.count()
    report = read("hgt_report.tsv").collect()
    assert [int(x.hgt_group_size) for x in report] == sorted((int(x.hgt_group_size) for x in report), reverse=True)
    assert set(read("oHGT1.graph_stats.tsv").columns) == {"node", "page_rank", "indegree", "outdegree"}
    # the parts alone, from the tables between
    again = pipeline.run(spark, {"overlaps": str(out / "deduplicated_overlaps.tsv"), "bed": str(out / "potential_hgts.bed"), "fai": str(tmp_path / "fai")}, str(tmp_path / "b"), CONFIG)
    assert len(again) == 5 and bag(tables.read_region_overlaps(spark, str(tmp_path / "b/region_overlaps.tsv"))) == bag(r.region_overlaps)
    with pytest.raises(ValueError):
        pipeline.run(spark, {"fai": str(tmp_path / "fai")}, str(tmp_path / "c"))


def test_ragged_rows(spark, tmp_path):
    (tmp_path / "t").write_text("a\t0\n" + "b\t7\tspecies\tX\t1\t2\t3\t0.5\td_A;p_B\n")
    got = {r.contig: r for r in tables.read_contig_taxonomy(spark, str(tmp_path / "t")).collect()}
    assert got["a"].taxid == 0 and got["a"].agreed is None and got["a"].d is None and (got["b"].d, got["b"].p, got["b"].agreed) == ("A", "B", 3)
    for bad in ("c\t1\t2\n", "c\tx\n"):
        (tmp_path / "bad").write_text("a\t5\n" + bad)
        with pytest.raises(Exception):
            tables.read_tsv(spark, str(tmp_path / "bad"), "contig string, length long").collect()
    (tmp_path / "bed").write_text("c\t1\t9\t2\tc_1,c_2\n")
    assert tables.read_merged_bed(spark, str(tmp_path / "bed")).first().orfs_encompassed == "c_1,c_2"
    (tmp_path / "hits").write_text("q\ts\t99\t50\t1e-9\nq\tt\t99\t60\t1e-9\n")
    assert [r.stitle for r in annotate.best_hits(tables.read_best_hits(spark, str(tmp_path / "hits")), 20, 80, 80).collect()] == ["t"]


def test_fasta_index_places(spark, tmp_path):
    r, data, want = random.Random(3), b"", {}
    for k in range(60):
        n, width = r.randrange(1, 300), r.randrange(10, 80)
        seq = "".join(r.choice("ACGT") for _ in range(n))
        lines = [seq[i : i + width] for i in range(0, n, width)]
        data += f">c{k} some words\n".encode()
        want[f"c{k}"] = (n, len(data), len(lines[0]), len(lines[0]) + 1)
        data += "".join(x + "\n" for x in lines).encode()
    (tmp_path / "x.fasta").write_bytes(data)
    for piece in (fasta.PIECE, 3000, 97):
        got = {x.contig: (x.length, x.offset, x.linebases, x.linewidth) for x in fasta.index_fasta_file(spark, str(tmp_path / "x.fasta"), piece).collect()}
        assert got == want, piece
    assert tables.count_records(spark, str(tmp_path / "x.fasta")) == 60


def test_large_clusters_are_paired_in_cells(spark):
    df = spark.range(400).select(F.lit("r").alias("cluster_rep"), F.concat(F.lit("c"), (F.col("id") % 130).cast("string")).alias("contig"), F.col("id").alias("orf_n"), F.lit(5).cast("long").alias("total_orfs"))
    assert bag(overlaps.pair_overlaps(df, cell=30)) == bag(overlaps.pair_overlaps(df)) and overlaps.pair_overlaps(df, cell=30).count() == sum(1 for a, b in itertools.permutations(range(400), 2) if a % 130 != b % 130)


def test_cluster_of_20000_genes(spark):
    df = spark.range(20_000).select(F.lit("r").alias("cluster_rep"), (F.col("id") % 20_000).cast("string").alias("contig"), F.col("id").alias("orf_n"), F.lit(5).cast("long").alias("total_orfs"))
    parts = F.ceil(F.lit(20_000 / overlaps.CELL)).cast("int")
    own = F.pmod(F.xxhash64("contig", "orf_n"), parts)
    assert df.groupBy(own).count().agg(F.max("count")).first()[0] < 2 * overlaps.CELL  # a cell's sides


def by_sets(rows):
    """The representatives of duplicate-level contigs, by sets. rows: (contig1, contig2, n1, n2), both ways."""
    ones = lambda rs, f: {a for a, b, m, n in rs if f(m, n)}
    strict = ones(rows, lambda m, n: m > n) - ones(rows, lambda m, n: m <= n)
    done = {x for a, b, *_ in rows if a in strict for x in (a, b)}
    rest = [r for r in rows if r[0] not in done and r[1] not in done]
    tied = {x for a, b, m, n in rest if m == n for x in (a, b)}
    both = [r for r in rest if r[0] in tied and r[1] in tied]
    tops = {a for a, b, *_ in both if a >= b} - {a for a, b, *_ in both if a < b}
    final = {(a, b) for a, b, *_ in rows if a in strict | tops}
    named = {x for p in final for x in p}
    left = [r for r in rest if r[1] not in named]
    more = [(a, b) for a, b, m, n in left if m > n and a not in ones(left, lambda m, n: m < n)]
    return collections.Counter([(x, x) for x in {a for a, _ in [*more, *final]}] + more + list(final))


def test_representatives_equal_the_sets(spark):
    r, seen = random.Random(11), 0
    cols = "contig1 string, contig2 string, total_orfs_ctg1 long, total_orfs_ctg2 long"
    # leftovers by hand: B and C tie and C takes B; A is larger than B alone, so no one's, until C's group is set; E outranks nobody but D
    hand = [("A", "B", 5, 4), ("B", "C", 4, 4), ("C", "A", 4, 6), ("D", "E", 3, 3)]
    for case in [hand] + [[(f"k{a}", f"k{b}", 0, 0) for a, b in {tuple(sorted(r.sample(range(9), 2))) for _ in range(8)}] for _ in range(6)]:
        size = {f"k{k}": r.randrange(2, 5) for k in range(9)}
        rows = [x for a, b, m, n in case for m, n in [(size.get(a, m), size.get(b, n))] for x in ((a, b, m, n), (b, a, n, m))]
        rows += rows[:2]  # two ORF pairs
        got = collections.Counter(map(tuple, clustering.contig_clusters(spark.createDataFrame(rows, cols)).collect()))
        assert got == by_sets(rows), rows
        seen += len(got)
    assert seen > 20


def test_groups_without_contigs_in_the_metadata(spark):
    comp = spark.createDataFrame([("a", "a"), ("b", "a"), ("z", "z")], "region_idx string, hgt_group_root string")
    meta = spark.createDataFrame([("a", 5)], "region_idx string, region_len long")
    over = spark.createDataFrame([("k", "m", "a", "b"), ("m", "k", "b", "a")], "contig1 string, contig2 string, region_idx_contig1 string, region_idx_contig2 string")
    tax = spark.createDataFrame([("k", 5, *"dpcofgs"), ("k", 2, *"DPCOFGS")], "contig string, taxid long, " + ", ".join(f"{x} string" for x in RANKS))
    got = {x.region_idx: (x.contig, x.d, x.hgt_group_id) for x in reports.hgt_groups(comp, meta, tax, over).collect()}
    assert got == {"a": ("k", "D", 1), "b": ("m", None, 1), "z": (None, None, 2)}


def test_group_ids_across_tasks(spark):
    comp = spark.range(3000).select(F.col("id").cast("string").alias("region_idx"), (F.col("id") % 700 % 313).cast("string").alias("hgt_group_root"))
    want = sorted(collections.Counter(str(k % 700 % 313) for k in range(3000)).items(), key=lambda x: (-x[1], x[0]))
    got = {x.hgt_group_root: x.hgt_group_id for x in reports.group_ids(comp.repartition(7)).collect()}
    assert got == {root: k + 1 for k, (root, _) in enumerate(want)}


def test_schemas_name_the_columns(spark, sf):
    r = Relations(spark, sf)
    for schema, df in ((schemas.OVERLAPS, r.overlaps), (schemas.MERGED_BED, r.merged), (schemas.REGION_METADATA, r.metadata), (schemas.REGION_OVERLAPS, r.region_overlaps), (schemas.BED, r.bed)):
        assert [x.split()[0] for x in schema.split(", ")] == df.columns
