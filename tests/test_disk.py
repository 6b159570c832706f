"""What steps leave on disk, and which steps are written at all."""

import os

import pytest
from pyspark.sql import functions as F

from contiglink.config import Config
from contiglink.operators import events
from contiglink.plans import queries
from contiglink.plans.queries import Relations
from contiglink.sources import staging


@pytest.fixture(scope="module")
def relations(spark, sf):
    r = Relations(spark, sf)
    yield r
    r.close()


def shuffle_bytes(spark):
    """Bytes of the shuffle files that this session's tasks have left."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).length() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_"))


def test_shuffle_files_go_with_their_step(spark):
    before = shuffle_bytes(spark)
    df = spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).agg(F.count("*").alias("n"))
    out = staging.staged(df, "some")
    assert out.count() == 200_000 and spark.conf.get(staging.CLEAN) == "false"
    assert shuffle_bytes(spark) - before < 200_000


def test_donors_and_counts_write_no_wide_rows(relations):
    r = relations
    donors = {tuple(x) for x in r.donors.collect()}
    counts = events.level_counts(r.few2).collect()
    links = r.linked.agg(F.sum("rows")).first()[0]
    assert donors and not [p for p in r.scratch.paths if "criterion" in p]
    assert counts == events.level_counts(r.levels2).collect() and links == events.all_levels(r.levels2).count()
    assert donors == {tuple(x) for x in events.donor_recipient(r.levels1, r.criteria2).collect()}
    assert {tuple(x) for x in r.all_hgt1.collect()} == {tuple(x) for x in events.all_levels(r.levels1).collect()}
    assert [p for p in r.scratch.paths if "criterion2" in p] and not [p for p in r.scratch.paths if "taxonomy-file" in p]


def test_repeated_rows_of_criterion_one(relations):
    """Repeated taxonomies make one row, as a comparison of whole rows did."""
    r = relations
    once = events.all_criterion1(r.metadata, r.region_taxonomy, r.contig_taxonomy, Config())
    twice = events.all_criterion1(r.metadata.union(r.metadata), r.region_taxonomy, r.contig_taxonomy.union(r.contig_taxonomy), Config())
    assert twice.count() == once.count() > 0


def test_sequences_in_slices(spark, relations, monkeypatch):
    """Slices give the rows of one pass, and no slice's files stay."""
    r = relations
    views = [queries.VIEWS[x] for x in ("fasta_index_file", "extract_regions")]
    whole = [sorted(map(tuple, v(r).collect())) for v in views]
    written = []
    write = queries.tables.write_fasta
    monkeypatch.setattr(queries.tables, "write_fasta", lambda df, path: (write(df, path), written.append(path)))
    monkeypatch.setattr(queries, "SLICE", r.fixture("fx_fai").agg(F.sum("length")).first()[0] // 3 + 1)
    assert [sorted(map(tuple, v(r).collect())) for v in views] == whole and whole[0] and whole[1]
    assert len(written) == 6 and not any(os.path.exists(p.removeprefix("file://")) for p in written)
