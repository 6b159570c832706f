"""Benchmark rows without an id are searched too."""

import hashlib

import brute
from test_llm import EDGE, docs, sample

from contiglink.llm import fm_index


def test_null_items_hit_but_are_not_named(spark):
    texts = sample(40)
    items = [(1, " ".join(texts[0].split()[:30])), (None, texts[5]), (2, texts[5] + " more words"), (None, "Xyz, tiny Item"), (None, None)]
    more = texts + EDGE + ["before xyz TINY item after", f"{texts[1]} {texts[5]}"]
    df, bench = docs(spark, more), spark.createDataFrame(items, "item_id long, text string")
    for some in (bench, bench.where("item_id is null")):
        want = brute.contamination(list(enumerate(more)), [tuple(r) for r in some.collect()])
        for size in (1 << 23, 50):
            got = {r.doc_id: r for r in fm_index.decontaminate(df, some, slice_bytes=size).collect()}
            for i, (n, hit, found) in want.items():
                named = [x for x in found if x != "None"]
                assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, hit, len(named), hit > 0)
                assert got[i].items_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert want[len(more) - 2][1] == 3
        assert {r.doc_id for r in fm_index.drop_contaminated(df, some).collect()} == {i for i in want if not want[i][1]}


def test_items_that_end_in_nul_and_long_ids(spark):
    text = "a long enough phrase of benchmark words stands in here for all to see"
    names = ["a\0", "b", "", "x" * 5000, "ä\0\0"]
    bench = spark.createDataFrame([(x, text) for x in names], "item_id string, text string")
    got = fm_index.decontaminate(docs(spark, [f"before {text} after", "clean"]), bench).orderBy("doc_id").collect()
    assert got[0].n_items == 5 and got[0].items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    assert not got[1].contaminated


def test_slices_are_bounded_in_bytes(spark):
    items = spark.createDataFrame([(k, f"word{k} " * 50) for k in range(200)], "item_id long, text string").coalesce(1)
    files, longest = fm_index.write_phrases(items, fm_index.fresh_path(spark, "phrases"), slice_bytes=4000)
    assert len(files) >= 200 * 350 // 4000 and longest == 10
    assert fm_index.write_phrases(items.limit(0), fm_index.fresh_path(spark, "phrases")) == ([], 1)
