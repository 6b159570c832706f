"""The pipeline's near_dedup stage counts 5-word shingles."""

import brute


def test_stage_takes_five_words(spark, sf):
    import corpus_pipeline as p

    words = [f"w{k}" for k in range(84)]
    edited = words[:30] + ["x"] + words[31:60] + ["y"] + words[61:]
    # 8 of 81 shingles of 4 words break (similarity 73 / 89), 10 of 80 of 5 words (70 / 90)
    rows = [(0, " ".join(words)), (1, " ".join(edited)), (2, " ".join(words[:-1]) + " z"), (3, "else " * 30)]
    assert brute.near(rows)[1] == 0 and brute.near(rows, k=5) == {0: 0, 1: 1, 2: 0, 3: 3}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in p.near_dedup(spark, df, sf).collect()} == {0, 1, 3}


def test_stage_equals_all_pairs(spark, sf):
    import corpus_pipeline as p

    df = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute.near([(r.doc_id, r.text) for r in df.collect()], k=5)
    assert {r.doc_id for r in p.near_dedup(spark, df, sf).collect()} == {i for i in want if want[i] == i}
