"""Naive Bayes support vectors against plain versions of their parts; the sample's bounds."""

import math
import random

import brute
import numpy as np
from pyspark.sql import functions as F

from contiglink.llm import nb_svm


def samples(r, n=120):
    """Sets of buckets that tell the label, but not always."""
    out = []
    for _ in range(n):
        q = r.randrange(2)
        out.append((np.array(sorted({r.randrange(60) + (50 * q if r.random() < 0.4 else 0) for _ in range(r.randrange(1, 12))}), np.int32), q))
    return out


def test_ratios_and_margins():
    r = random.Random(3)
    rows = samples(r)
    model, ratio = nb_svm.fit(rows, 0.4)
    want, none = brute.log_ratios([(x.tolist(), q) for x, q in rows], nb_svm.SMOOTH, 1 << nb_svm.BITS)
    assert all(math.isclose(ratio[b], v, rel_tol=1e-9) for b, v in want.items()) and math.isclose(ratio[200_000], none, rel_tol=1e-9)
    # the solution is at most 2 % from the least objective, by the dual's lower bound
    plain = [{b: want[b] / math.sqrt(sum(want[c] ** 2 for c in x.tolist())) for b in x.tolist()} for x, _ in rows]
    y = [1 if q else -1 for _, q in rows]
    w, bias = nb_svm.dual_descent([(np.array(list(x)), np.array(list(x.values()))) for x in plain], np.array(y, float), 1 << nb_svm.BITS)
    weights = {b: w[b] for b in want}
    top = brute.hinge_objective(plain, y, weights, bias, nb_svm.COST)
    alpha = alphas(plain, y, nb_svm.COST)
    v = {}
    for a, x, t in zip(alpha, plain, y):
        for f, z in x.items():
            v[f] = v.get(f, 0.0) + a * t * z
    least = sum(alpha) - (sum(z * z for z in v.values()) + sum(a * t for a, t in zip(alpha, y)) ** 2) / 2
    assert least - 1e-9 <= top <= least * 1.02
    assert np.allclose(model.weights, w * ratio)


def alphas(rows, y, cost):
    """Dual variables after many plain passes of coordinate ascent, bias as one more feature."""
    alpha = [0.0] * len(rows)
    w, bias = {}, 0.0
    for _ in range(400):
        for i, (x, t) in enumerate(zip(rows, y)):
            slack = 1 - t * (sum(v * w.get(f, 0.0) for f, v in x.items()) + bias)
            new = min(cost, max(0.0, alpha[i] + slack / (sum(v * v for v in x.values()) + 1)))
            for f, v in x.items():
                w[f] = w.get(f, 0.0) + (new - alpha[i]) * t * v
            bias += (new - alpha[i]) * t
            alpha[i] = new
    return alpha


def test_calibration():
    r = np.random.default_rng(4)
    labels = r.integers(0, 2, 400)
    margin = r.normal(size=400) + labels
    slope, offset = nb_svm.logistic(margin, labels, 0.3)
    weight = np.where(labels == 1, 0.3 / labels.mean(), 0.7 / (1 - labels.mean()))

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        return float((weight * -np.log(np.where(labels == 1, p, 1 - p))).sum() + 5e-4 * (a * a + b * b))

    best = loss(slope, offset)
    assert all(best <= loss(slope + a, offset + b) for a in (-0.01, 0, 0.01) for b in (-0.01, 0, 0.01))


def test_the_sample_is_bounded_in_bytes(spark):
    rows = [(k, ("good river stone " if k % 2 else "BUY $$$ now ") * (400 if k % 5 == 0 else 4)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, quality int")
    whole, few = nb_svm.train(docs, labels), nb_svm.train(docs, labels, most_bytes=30_000)
    assert not np.array_equal(whole[1], few[1]) and len(few[0].weights)
    one = nb_svm.quality_scores(docs, labels.where("quality = 1"))  # one class: its share
    assert one.agg(F.min("score"), F.max("score")).first()[:] == (1.0, 1.0)
