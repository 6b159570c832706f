"""The classifier is fitted by a task, so that its sample never lies in the driver, and is the same model as on the driver."""

import random

import numpy as np
import pyarrow as pa

from contiglink.llm import nb_svm


def tables(spark, n=60):
    r = random.Random(6)
    texts = [(k, " ".join(r.choice("abcdefgh") * (k % 2 + 1) for _ in range(30))) for k in range(n)]
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id long, quality int"), texts


def test_same_model_without_the_driver(spark, monkeypatch):
    docs, labels, texts = tables(spark)
    used = {x.doc_id for x in labels.where(~nb_svm.held_out("doc_id")).collect()}
    rows = [(k, b) for k, t in texts if k in used for bounds, buckets in nb_svm.features(pa.array([t])) for b in [buckets]]
    order = np.random.default_rng(3).permutation(len(rows))
    share = sum(k % 2 for k in used) / len(used)
    want, ratio = nb_svm.fit([(rows[i][1].astype(np.int32), rows[i][0] % 2) for i in order], share)

    def never(*_):
        raise AssertionError("fitted on the driver")

    monkeypatch.setattr(nb_svm, "dual_descent", never)  # the workers import the module anew
    got, ratio2 = nb_svm.train(docs, labels)
    assert np.array_equal(got.weights, want.weights) and np.array_equal(ratio, ratio2)
    assert (got.bias, got.slope, got.offset, got.constant) == (want.bias, want.slope, want.offset, None)


def test_one_class_or_none(spark):
    docs, labels, _ = tables(spark)
    assert nb_svm.train(docs, labels.where("quality = 1"))[0].constant == 1
    assert nb_svm.train(docs, labels.limit(0))[0].constant == 0.5
