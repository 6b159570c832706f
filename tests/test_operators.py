"""Hand-computed cases and properties of the analysis."""

import pytest
from pyspark.sql import functions as F

from contiglink.config import RANKS, Config
from contiglink.functions.names import clean_region_name, contig_of, orf_id, ordinal_of, ranks_of
from contiglink.operators import annotate, clustering, events, graph, overlaps, regions, reports
from contiglink.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def clusters(spark, pairs):
    return spark.createDataFrame(pairs, "cluster_rep string, cluster_member string")


def pairs_of(spark, members, minimum=1):
    return overlaps.pair_overlaps(overlaps.passing_orfs(overlaps.parse_orfs(clusters(spark, members)), minimum))


def test_names(spark):
    df = spark.createDataFrame([("a_b_12",), ("x",)], "s string")
    assert rows(df.select(contig_of(F.col("s")))) == [("",), ("a_b",)]
    assert df.where("s <> 'x'").select(ordinal_of(F.col("s")).alias("n")).first().n == 12
    with pytest.raises(Exception):
        df.select(ordinal_of(F.col("s"))).collect()
    assert spark.range(1).select(orf_id(F.lit("c"), F.lit(3))).first()[0] == "c_3"
    assert spark.range(1).select(clean_region_name(F.lit("r_1::c:1-2"))).first()[0] == "r_1"


def test_lineage(spark):
    df = spark.createDataFrame([("d_X;g_Bacillus_A",), (None,), (";".join("abcdefg"),)], "lineage string").select(*(c.alias(r) for r, c in ranks_of(F.col("lineage")).items()))
    assert rows(df) == sorted([("X", "BacilluA") + (None,) * 5, (None,) * 7, tuple("abcdefg")], key=repr)
    with pytest.raises(Exception):
        spark.createDataFrame([(";".join("abcdefgh"),)], "lineage string").select(*ranks_of(F.col("lineage")).values()).collect()


def test_paralogs_multiply(spark):
    members = [("r", f"A_{k}") for k in (1, 2)] + [("r", f"B_{k}") for k in (1, 2, 3)]
    got = pairs_of(spark, members)
    assert {r.co_occur_cts for r in got.collect()} == {6} and got.count() == 12
    assert {(r.total_orfs_ctg1, r.total_orfs_ctg2, r.smallest_contig_orfCts) for r in got.collect()} == {(2, 3, 2), (3, 2, 2)}


def test_threshold_is_strict_and_sides_partition(spark):
    got = pairs_of(spark, [("r", "A_1"), ("r", "B_1"), ("q", "A_2"), ("z", "B_2")])  # 1 of 2
    assert overlaps.dedup_overlaps(got, 0.5).count() == 0 and overlaps.redundant_overlaps(got, 0.5).count() == 2
    assert overlaps.dedup_overlaps(got, 0.6).count() == 2 and overlaps.overlap_status(got, 0.6).where("status = 'non-redundant'").count() == 2
    assert pairs_of(spark, []).count() == 0


def bed(spark, spans, contig="c"):
    return spark.createDataFrame([(contig, a, b, 1, f"{contig}_{k}") for k, (a, b) in enumerate(spans)], "contig string, start long, end long, strand int, orf string")


def test_interval_merge(spark):
    merge = lambda spans: [(r.start, r.stop, r.orf_cts) for r in regions.merge_intervals(bed(spark, spans), 5).orderBy("start").collect()]
    assert merge([(1, 10), (15, 20)]) == [(1, 20, 2)]
    assert merge([(1, 10), (16, 20)]) == [(1, 10, 1), (16, 20, 1)]
    assert merge([(1, 100), (5, 10), (104, 110)]) == [(1, 110, 3)]
    assert merge([]) == []


def test_region_classes(spark):
    merged = spark.createDataFrame([("c", 1, 100, 1, "c_1"), ("gone", 1, 2, 1, "g_1"), ("d", 30, 50, 1, "d_1"), ("d", 5, 8, 1, "d_2")], "contig string, start long, stop long, orf_cts long, orfs_encompassed string")
    fai = spark.createDataFrame([("c", 100), ("d", 90)], "contig string, length long")
    got = {r.region_idx: r for r in regions.region_metadata(merged, fai, 10).collect()}
    assert {k: v.region_type for k, v in got.items()} == {"c_region_1": "_end_edge_", "d_region_1": "_start_edge_", "d_region_2": "_internal_"}
    assert got["d_region_2"].region_title == "d_region_2_internal_length=20"
    slop = {r.region_title: (r.start, r.stop) for r in regions.region_slop(regions.region_metadata(merged, fai, 10), 50).collect()}
    assert slop["d_region_2_internal_length=20"] == (0, 90)


def test_reciprocals_keep_all_rows_of_one_direction(spark):
    df = spark.createDataFrame([("B", "A", "B_r", "A_r", "1", "2", 1), ("A", "B", "A_r", "B_r", "2", "1", 0), ("A", "B", "A_r", "B_r", "3", "1", 2)], "contig1 string, contig2 string, region_idx_contig1 string, region_idx_contig2 string, orf_region1 string, orf_region2 string, n int")
    assert [r.contig1 for r in regions.filter_reciprocals(df).collect()] == ["A", "A"]
    assert [r.contig1 for r in regions.filter_reciprocals(df, ["n"]).collect()] == ["A", "A"]
    assert [r.contig1 for r in regions.filter_reciprocals(df.withColumn("n", -F.col("n")), ["n"]).collect()] == ["A", "A"]


def test_extraction(spark):
    fasta = spark.createDataFrame([("c", "ACGTACGT")], "name string, sequence string")
    cuts = spark.createDataFrame([("c", 2, 5, "t"), ("c", 5, 9, "late")], "contig string, start long, stop long, region_title string")
    assert rows(regions.extract_regions(cuts, fasta)) == [("t::c:2-5", "GTA")]


def level_frame(spark, pairs):
    names = [f"{r}_{s}" for s in ("a", "b") for r in RANKS]
    pad = lambda x: tuple(x) + (None,) * (7 - len(x))
    return events.with_levels(spark.createDataFrame([pad(a) + pad(b) for a, b in pairs], ", ".join(f"{n} string" for n in names)), "a", "b")


def test_levels(spark):
    got = level_frame(spark, [(("x", "p", "c"), ("y", "p", "d")), (("x", "None", "c"), ("x", "q", "d")), (("x",), ("x",))]).collect()
    assert [[k for k in ("dHGT", "pHGT", "cHGT") if r[k]] for r in got] == [["dHGT", "cHGT"], [], []]
    assert events.all_levels(level_frame(spark, [(("x", "p", "c"), ("y", "p", "d"))] * 2)).count() == 1
    strict = events.level_flags("a", "b", strict=True)
    assert not level_frame(spark, [(("x", "p", "c"), ("y", "p", "d"))]).select(strict["cHGT"].alias("k")).first().k


def test_components_match_union_find(spark):
    import random

    r = random.Random(4)
    edges = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(45)] + [(f"p{k}", f"p{k + 1}") for k in range(40)] + [("s", "s")]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    df = spark.createDataFrame(edges, "a string, b string")
    got = {x.node: x.component for x in graph.connected_components(df, "a", "b").collect()}
    assert got == {x: root(x) for x in up}
    assert graph.connected_components(df.limit(0), "a", "b").count() == 0


def test_groups_and_report(spark):
    comp = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d")], "region_idx string, hgt_group_root string")
    meta = spark.createDataFrame([("a", "k", 5, "_internal_"), ("b", "k", 7, "_end_edge_")], "region_idx string, contig string, region_len long, region_type string")
    tax = spark.createDataFrame([("k", 5, *"dpcofgs")], "contig string, taxid long, " + ", ".join(f"{r} string" for r in RANKS))
    groups = reports.hgt_groups(comp, meta, tax)
    assert {(r.region_idx, r.hgt_group_id, r.hgt_group_size) for r in groups.collect()} == {("a", 1, 3), ("b", 1, 3), ("c", 1, 3), ("d", 2, 2), ("e", 2, 2)}
    one, two = reports.group_report(groups).orderBy("hgt_group_id").collect()
    assert one.region_types == "_end_edge_:1,_internal_:1" and one.total_region_len == 12 and one.num_distinct_species == 1 and two.region_types == ""


def test_cluster_representatives(spark):
    cols = "contig1 string, contig2 string, total_orfs_ctg1 long, total_orfs_ctg2 long"
    both = lambda *e: spark.createDataFrame([x for a, b, m, n in e for x in ((a, b, m, n), (b, a, n, m))], cols)
    assert rows(clustering.contig_clusters(both(("A", "B", 5, 3)))) == [("A", "A"), ("A", "B")]
    assert rows(clustering.contig_clusters(both(("A", "B", 4, 4)))) == [("B", "A"), ("B", "B")]
    assert clustering.contig_clusters(both(("A", "B", 4, 4)).limit(0)).count() == 0


def test_pagerank_sums_to_one(spark):
    edges = spark.createDataFrame([("a", "b"), ("c", "b")], "donor_order string, recipient_order string")
    got = {r.node: r.page_rank for r in graph.pagerank(edges).collect()}
    assert abs(sum(got.values()) - 1) < 1e-6 and got["b"] > got["a"] == got["c"]
    assert {tuple(r) for r in graph.graph_degrees(edges).collect()} == {("a", 0, 1), ("b", 2, 0), ("c", 0, 1)}


def test_best_hits(spark):
    hits = spark.createDataFrame([("q", "s1", 95.0, 10.0, 0.1, 90.0, 90.0), ("q", "s2", 95.0, 12.0, 0.1, 90.0, 90.0), ("q", "s3", 10.0, 99.0, 0.1, 90.0, 90.0)], "qtitle string, stitle string, pident double, bitscore double, evalue double, qcov double, scov double")
    assert [r.stitle for r in annotate.best_hits(hits, *Config().arg).collect()] == ["s2"]


def test_files(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a one two\nACG\nT\n>b\nGG\n")
    assert rows(tables.read_fasta(spark, str(tmp_path / "x.fasta"))) == [("a", "one two", "ACGT"), ("b", "", "GG")]
    (tmp_path / "h.txt").write_text(">c_1 # 2 # 9 # -1 # ID=1_1;partial=00\nACGT\n")
    assert rows(tables.parse_orf_headers(spark.read.text(str(tmp_path / "h.txt")))) == [("c_1", 2, 9, -1, "ID=1_1;partial=00")]
    (tmp_path / "t.tsv").write_text("c\t5\tspecies\tX\t1\t1\t1\t0.5\td_A;p_None\nd\t0\tNA\tNA\t0\t0\t0\t0\tNone\n")
    got = {r.contig: r for r in tables.read_contig_taxonomy(spark, str(tmp_path / "t.tsv")).collect()}
    assert got["c"].p == "None" and got["d"].d is None and got["d"].level is None
    tables.write_tsv(tables.read_contig_taxonomy(spark, str(tmp_path / "t.tsv")).select("contig", "taxid"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).count() == 2
