"""The registered queries: one a training-data operator, on whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, fm_index, main_text, minhash, nb_svm, oracle, pii, quality_rules, runs, sharding, token_files, url_filter, warc, whitening
from .common import small_batches, table as read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return read_table(spark, sf_dir, name)


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ids=False, digests=True)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_of(table(spark, sf_dir, "documents"), shards=24)


def op4_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.train(docs))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op9_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nb_svm.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op11_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), words=runs.with_planted_run)


def op13_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
