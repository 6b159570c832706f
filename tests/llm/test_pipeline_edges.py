"""The pipeline from end to end on odd tables; its last stage against the tokenizers library."""

import hashlib
import random

import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as p

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, score double, component string"


def folder(spark, tmp_path, docs, labels, items):
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_odd_rows(spark, tmp_path):
    r = random.Random(2)
    good = lambda n: " ".join(r.choice(["river", "stone", "cloud", "the", "of", "green", "hill"]) + r.choice("abcdef") for _ in range(n))
    phrase = " ".join(f"bench{k}" for k in range(12))
    texts = [good(r.randrange(30, 80)) for _ in range(60)]
    texts[3] = texts[2]
    texts[5] = f"{texts[5]} {phrase} end"
    texts[7] = f"write to someone@example.org now {texts[7]}"
    texts[9] = "x " * 20_000
    rows = [(k, t, "en", None, len(t), 7, 0.5, "c") for k, t in enumerate(texts)]
    rows += [(None, good(50), None, "s", 1, 7, 0.5, "c"), (None, texts[2], None, None, None, None, None, None), (12, texts[12], "en", None, 3, 7, 0.5, "c"), (70, None, None, None, None, 1, 1.0, "d"), (71, "", None, None, 0, 1, 1.0, "d")]
    sf = folder(spark, tmp_path, rows, [(k, 1, 0) for k in range(60)], [(1, phrase), (None, None)])
    docs = p.table(spark, sf, "documents")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        docs = p.staged(out, "edge")
    kept = docs.collect()
    ids = [x.doc_id for x in kept]
    assert 5 not in ids and ids.count(12) == 1 and {2, 3} & set(ids) == {2} and len(ids) == len(rows) - 4
    assert all(x.row in (7, 1) and "@" not in (x.text or "") for x in kept if x.doc_id is not None)
    near = brute.near([(x.doc_id, x.text) for x in kept], k=5)
    assert all(k == v for k, v in near.items())
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((str(x.doc_id), lib.encode(x.text or "", add_special_tokens=False).ids) for x in kept)
    got = p.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted((str(x.doc_id), x.ids) for x in got) == want
    assert {x.ids_sha256 for x in got} == {hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() for _, i in want}


def test_no_rows(spark, tmp_path):
    sf = folder(spark, tmp_path, [], [], [])
    assert p.run(spark, sf).count() == 0
