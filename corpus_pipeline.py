"""A training-data pipeline over `documents`: five stages, each written as Parquet and read again.

quality (NB-SVM; rejected documents go) -> near_dedup (one document of each group by 5-word shingles stays) -> decontamination
(documents with a benchmark passage go) -> pii (spans are replaced by their kind's name, n_chars follows) ->
tokens (BPE ids of each text, with digests of the ids and of the decoded text).

All stages but the last return the columns of documents, and the tables may be empty or hold rows that repeat or have
nulls: a null doc_id is scored and deduplicated like any other (of a group the least id stays, nulls last; of rows
that repeat one stays); null texts count as empty, which the classifier judges by its coarse features, nothing
links or hits, and end as no ids. Long texts are read whole by every stage. Other columns are carried along up to
the last stage, which returns doc_id, n_tokens, ids and the two digests alone. A table without rows ends as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contiglink.llm import bpe, fm_index, minhash, nb_svm, pii
from contiglink.llm.common import small_batches, staged, table


#: words a shingle of the near_dedup stage (op8_minhash has 4)
SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return nb_svm.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return fm_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pii.redact_column(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", personal_data), ("tokens", tokens)]
#: None: a fitted classifier and tagger are not SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
