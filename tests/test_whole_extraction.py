"""The extraction over whole texts."""

from pyspark.sql import functions as F

from contiglink.plans import queries as core


def test_all_characters_are_extracted(spark, sf):
    got = core.queries()["extract_regions_whole"](spark, sf).agg(F.sum(F.length("sequence"))).first()[0]
    texts = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null")
    # ids that repeat would meet each other's texts
    assert texts.select("doc_id").distinct().count() == texts.count()
    assert got == texts.agg(F.sum(F.length("text"))).first()[0]
