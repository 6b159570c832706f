"""Near duplicates where words could be mistaken for each other, groups are large, and ids are null or repeat."""

import hashlib

import brute
import numpy as np
import pyarrow as pa
from test_llm import docs, sample

from contiglink.llm import fm_index, minhash
from contiglink.llm.hashing import blocks


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_in_polynomial_hashes(spark):
    import corpus_pipeline

    (t, u), (v, w) = thue_morse(1024), thue_morse(2048)
    texts = [f"one two three four {t}", f"one two three four {u}", f"one two three four {v}", f"one two three four {w}", f"{t} five", "six seven"]
    df = docs(spark, texts)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == brute.near(list(enumerate(texts))) == {i: i for i in range(6)}
    items = [(1, u), (2, f"{t} five"), (3, w)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(list(enumerate(texts)), items)
    got = {r.doc_id: r for r in fm_index.decontaminate(df, bench).collect()}
    assert all((got[i].n_hit, got[i].n_items) == (want[i][1], len(want[i][2])) for i in want) and want[0][1] == 0 < want[1][1]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == set(range(6))
    assert {r.doc_id for r in fm_index.drop_contaminated(df, bench).collect()} == {0, 2, 5}


def test_pairs_are_verified_on_words():
    texts = [t or "" for t in sample(120, 4)]
    left, right = texts[:60], texts[60:120]
    left[:5] = right[:5]
    for k in (4, 5):
        want = [bool(len(a) and len(brute.shingles(x, k)) and len(x.split()) >= k and len(y.split()) >= k) and 100 * len(brute.shingles(x, k) & brute.shingles(y, k)) >= 80 * len(brute.shingles(x, k) | brute.shingles(y, k)) for x, y, a in ((x, y, x) for x, y in zip(left, right))]
        assert minhash.exact_pairs(pa.array(left + right), 80, k).tolist() == want and any(want)


def test_digest_is_of_the_words():
    texts = ["A b\n c", " a  B c ", "a bc", "ab c", "", "  ", "a", "b c", None]
    for _, buf, offsets in blocks(pa.array(texts)):
        got = minhash.digests(buf, offsets)
    assert got[0] == got[1] == hashlib.blake2b(b"a b c", digest_size=16).digest() and len(set(got[2:4] + got[6:8])) == 4 and got[4] == got[5] == got[8]


def test_shared_block_and_hot_cells(spark, monkeypatch):
    """Texts of which most is one shared block: each alone below the similarity, some linked past it; with tiny cells and hot keys."""
    monkeypatch.setattr(minhash, "CELL", 3)
    monkeypatch.setattr(minhash, "LEAST", 0)
    monkeypatch.setattr("contiglink.operators.hot.LEAST", 0)
    monkeypatch.setattr("contiglink.operators.hot.hot_lookup.__defaults__", (None, 0))
    r = np.random.default_rng(3)
    block = [f"s{k}" for k in range(85)]
    texts = []
    for k in range(40):
        own = [f"o{k if k % 4 else k - k % 8}-{j}" for j in range(15)]
        texts.append(" ".join(block + own if k % 2 else own + block))
    texts += [" ".join(block)] * 30 + [" ".join(block[:80] + [f"x{r.integers(9)}"]) for _ in range(30)]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == brute.near(list(enumerate(texts)))


def test_one_row_of_a_group_stays(spark):
    texts = ["a b c d e f g h"] * 6 + ["other words in this one here"] * 2 + [None, None, ""]
    ids = [None, None, 7, 7, 9, 3, None, None, None, 1, 1]
    got = sorted(((r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs(spark, texts, ids)).collect()), key=repr)
    assert got == sorted([(3, texts[0]), (None, texts[6]), (None, None), (1, None), (1, "")], key=repr)
    df = docs(spark, texts, ids).withColumnRenamed("shard", "row")
    assert minhash.drop_near_duplicates(df).columns == df.columns and minhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_with_different_texts(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), "x y z " * 9, " ".join(words[:-2] + ["q"]), "x y z " * 9, "far away from all of the others here"]
    ids = [5, 5, 8, 2, 5]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs(spark, texts, ids)).collect()}
    assert got == {(5, 2), (8, 2), (2, 2)} and brute.near(list(zip(ids, texts))) == {5: 2, 8: 2, 2: 2}
