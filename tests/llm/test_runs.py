"""Periodic runs against every period at every place."""

import collections
import hashlib
import random
import zlib

import numpy as np

from contiglink.llm import runs


def brute(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted((r for r in out if not any(q < r[2] and s <= r[0] and s + n >= r[0] + r[1] for s, n, q in out)), key=lambda r: (r[0], r[2]))


def repetitive(r, n, letters):
    w = [r.randrange(letters) for _ in range(n)]
    for _ in range(r.randrange(3)):
        if n > 4:
            a = r.randrange(n)
            p, e = 1 + r.randrange(max(1, (n - a) // 2)), r.randrange(a, n)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_of():
    r = random.Random(5)
    for _ in range(1500):
        w = repetitive(r, r.randrange(70), r.choice([1, 2, 2, 3, 4, 8]))
        codes = np.array(w, np.int64)
        for least in (2, 4, 5, 12):
            assert runs.runs_of(codes, least) == brute(w, least), (w, least)


def test_long_sequences():
    n = 100_000
    assert runs.runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert runs.runs_of(np.tile(np.arange(7), 3000)[:-3]) == [(0, 20997, 7)]
    assert runs.runs_of(np.arange(n)) == []
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert runs.runs_of(np.array(b), 2) == brute(b, 2)


def test_positions():
    r = random.Random(1)
    xs = r.sample(range(10**6), 9000)
    p = runs.Positions(xs[0])
    for x in xs[1:]:
        p.add(x)
    order = sorted(xs)
    assert list(p) == order
    for k in (0, 1, 500, 4000, 8998, 8999):
        assert p.around(order[k]) == (order[k - 1] if k else -1, order[k + 1] if k < 8999 else -1)


def expected(key, text):
    w = (text or "").encode().split()
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w, 12)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % x for x in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_operator(spark):
    r = random.Random(9)
    texts = [None, "", " \n\t", "one", "a b\x1cc " * 20, "x " * 3000, "Äb c\x0bd " * 7]
    texts += [" ".join(f"w{x}" for x in repetitive(r, r.randrange(150), r.choice([2, 5, 40]))) for _ in range(120)]
    rows = [(k if k != 4 else None, t, "de", 3, 1.0) for k, t in enumerate(texts)] + [(9, texts[9], "en", 4, 2.0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, length int, runs double")
    got = runs.periodic_runs(df, words=runs.with_planted_run)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(expected(k, t) for k, t, *_ in rows)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    full = runs.periodic_runs(df, runs=True, texts=True).where("doc_id = 5").first()
    assert full.n_runs == 1 and full.runs[0].asDict() == {"start": 0, "length": 3000, "period": 1} and full.collapsed == "x"
    assert runs.periodic_runs(df.where("false")).count() == 0
