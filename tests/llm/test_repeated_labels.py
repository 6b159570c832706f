"""The classifier's sample holds one row an id, whatever the type of the ids and however often one repeats."""

from pyspark.sql import functions as F

from contiglink.llm import nb_svm


def test_repeated_and_text_ids(spark):
    texts = [("river stone cloud the of " if k % 4 else "buy now click offer $$$ ") * (3 + k % 5) for k in range(200)]
    rows = spark.createDataFrame([(f"d{k}", t) for k, t in enumerate(texts)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{k}", int(k % 4 > 0), 0) for k in range(200)], "doc_id string, quality int, toxic int")
    want = {r.doc_id: r.score for r in nb_svm.quality_scores(rows, labels).collect()}
    assert min(want[f"d{k}"] for k in range(1, 200, 4)) > max(want[f"d{k}"] for k in range(0, 200, 4))
    hot = rows.unionByName(rows.where("doc_id = 'd1'").crossJoin(spark.range(400)).drop("id"))
    got = nb_svm.quality_scores(hot, labels).collect()
    assert len(got) == 600 and {r.doc_id: r.score for r in got} == want
    other = hot.unionByName(rows.where("doc_id = 'd2'").withColumn("text", F.lit(None).cast("string")))
    assert nb_svm.keep_good(other, labels).where("doc_id = 'd1'").count() == 401
