"""The training-data operators against plain Python, on small tables with nulls, ties, repeats and long texts."""

import base64
import collections
import hashlib
import random
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contiglink.llm import bpe, fm_index, minhash, nb_svm, pii, quality_rules, sharding, token_files, url_filter, warc
from contiglink.llm.hashing import blocks, word_hashes, words

VOCAB = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"  # clashing extra columns
EDGE = [None, "", "   \n\t", "one", "It's Äpfel <|endoftext|>x don'T\x1cS ΟΔΟΣ", "x" * 3000, "word " * 2000]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(VOCAB)


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None, 1.0, 9) for i, t in zip(ids, texts)], DOCS)


def sample(n=150, seed=1):
    """Invented texts with exact and near copies."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeinrst") for _ in range(r.randrange(1, 6))) for _ in range(400)]
    out = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.5:
            w = (r.choice(out) or "").split()
            for _ in range(r.randrange(1, 4)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w))
        else:
            out.append(" ".join(r.choice(vocab) for _ in range(r.randrange(1, 120))))
    return out


def test_bpe_equals_library(spark, lib):
    texts = EDGE + sample(40)
    got = bpe.encode_texts(docs(spark, texts), VOCAB, decoded=True, digests=True).collect()
    for row in got:
        want = lib.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        back = lib.decode(want, skip_special_tokens=False)
        assert row.ids == want and row.n_tokens == len(want) and row.decoded == back
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest() and row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert len(got) == len(texts) and bpe.encode_texts(docs(spark, []), VOCAB).count() == 0


def test_bpe_scan_and_heap_agree():
    b, r = bpe.WordBpe(VOCAB), random.Random(3)
    for _ in range(300):
        w = "".join(r.choice("thenraiso") for _ in range(r.randrange(2, bpe.SHORT)))
        assert b.parts(w) == b._long_parts(w + "</w>", [*range(len(w)), len(w) + 4])


def test_elias_fano():
    r = random.Random(2)
    for values in ([], [0], [7], [0] * 600, sorted(r.randrange(10**12) for _ in range(3000)), list(range(1000))):
        e, size = token_files.EliasFano.frombytes(memoryview(token_files.EliasFano.of(np.array(values)).tobytes()))
        assert e.slice(0, len(values)).tolist() == values and [e[i] for i in range(len(values))] == values
        for _ in range(50):
            i, j = sorted((r.randrange(len(values) + 1), r.randrange(len(values) + 2)))
            assert e.slice(i, j).tolist() == values[i:j]


def test_token_files(spark, lib):
    texts, ids = EDGE + sample(60), [None, None, *range(5, 70), 5, 5][: len(EDGE) + 60]
    manifest = token_files.write_token_files(docs(spark, texts, ids), VOCAB, 1, token_files.fresh_path(spark, "t"), file_ids=500)
    got = token_files.read_token_files(manifest, ids=True).orderBy("start").collect()
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    at = 0
    assert len(got) == len(texts) and manifest.count() > 5
    for row, (i, t) in zip(got, order):
        want = lib.encode(t or "", add_special_tokens=False).ids + [1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (i, at, len(want), want) and row.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)
    f = token_files.TokenFile(token_files.read_file(manifest.orderBy("part", "piece").first().file))
    assert f.doc_id(0) is None and f.ids(len(f) - 1)[-1] == 1
    assert token_files.token_files(docs(spark, []), VOCAB).count() == 0


def test_token_files_of_one_id_and_many_blocks(spark):
    texts = [f"word{i} a b" for i in range(900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    manifest = token_files.write_token_files(docs(spark, texts, [None] * 600 + [7] * 300), VOCAB, 1, token_files.fresh_path(spark, "t"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.select("part").distinct().count() > 3
    f = token_files.TokenFile(token_files.read_file(manifest.orderBy("part").first().file))
    assert [f.span(i) for i in range(len(f))] == list(zip(f.bounds(0, len(f))[:-1], f.bounds(0, len(f))[1:]))
    got = token_files.read_token_files(manifest, read_docs=7).orderBy("start").collect()
    assert [x.doc_id for x in got] == [None] * 600 + [7] * 300
    assert [x.start for x in got] == np.cumsum([0, *(x.n_tokens for x in got)])[:-1].tolist()


def test_token_files_of_many_small_tasks(spark, lib):
    """However many tiny files there are, one task writes the manifest and few read; a file's ids are not copied to write them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    texts = [None, "", " "] * 50 + [f"Word{i}, a b" for i in range(300)]
    manifest = token_files.write_token_files(docs(spark, texts), VOCAB, 1, token_files.fresh_path(spark, "t"))
    table = token_files.read_token_files(manifest, ids=True)
    assert manifest.count() > 20 and len(manifest.inputFiles()) == 1 and table.rdd.getNumPartitions() == 1
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(table.collect(), key=lambda x: x.doc_id)
    assert [x.ids for x in got] == [lib.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert [x.start for x in got] == np.cumsum([0, *(x.n_tokens for x in got)])[:-1].tolist()
    ids = [np.arange(5, dtype="<u2"), np.zeros(0, "<u2"), np.arange(3, dtype="<u2")]
    parts = token_files.pack([None, 4, 9], [2, 5, 1], ids, 2)
    assert all(np.shares_memory(np.frombuffer(x, "<u2"), y) for x, y in zip(parts[-3:], ids) if len(y))
    f = token_files.TokenFile(b"".join(parts))
    assert f.doc_ids(0, 3) == [None, 4, 9] and [f.ids(i).tolist() for i in range(3)] == [[0, 1], [2, 3, 4, 0, 1], [2]]


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_sharding(spark):
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    assert sharding.jump(keys, 24).tolist() == [jump_one(int(k), 24) for k in keys]
    texts, ids = EDGE + sample(200), [None, 3, 3, *range(10, 10 + len(EDGE) + 197)]
    got = sharding.shards_of(docs(spark, texts, ids), 24, block_rows=3).collect()
    assert len(got) == len(texts) and all(r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24 and r.law == "key" for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    size = {r.doc_id: (r.size, r.text_crc32) for r in got}
    assert all(size[i] == (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts) if i not in (None, 3))
    assert sharding.shards_of(docs(spark, []), 24).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def spans_by_pattern(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) < 256 for x in m[0].split(".")), "card": lambda: 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]():
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    for letters in ("ab.@-+1", "0123456789. -", "+12() .-a", "a@b.c@d", "4 1-"):
        for _ in range(1500):
            t = "".join(r.choice(letters) for _ in range(r.choice([5, 12, 40])))
            assert pii.base_spans(t) == spans_by_pattern(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000) == []


def test_windows_cover_triggers_and_margins():
    r = random.Random(6)
    for _ in range(200):
        t = "".join(r.choice("a" * 40 + "1") for _ in range(500))
        starts = pii.windows_of(t)
        for m in re.finditer("1", t):
            assert all(any(a <= i < a + pii.TRAIN_WINDOW for a in starts) for i in range(max(0, m.start() - pii.MARGIN), min(len(t), m.start() + pii.MARGIN)))


def test_tagger_gradient():
    t, r = pii.Tagger(numbers=np.float64), np.random.default_rng(0)
    x, y = r.integers(0, pii.SYMBOLS, (2, 6)), r.integers(0, pii.TAGS, (2, 6))
    _, grad = t._loss(x, y)
    for name in ("embed", "wf", "ub", "cb", "out", "move", "start"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        up, down = {}, {}
        for step, out in ((1e-5, up), (-1e-5, down)):
            t.p[name][at] += step
            out["loss"] = t._loss(x, y)[0]
            t.p[name][at] -= step
        assert abs((up["loss"] - down["loss"]) / 2e-5 / 2 - grad[name][at]) < 1e-5, name


def test_personal_data(spark):
    r = random.Random(8)
    mails = [f"some words {''.join(r.choice('abc') for _ in range(4))}.{k}@mail{k % 9}.example.com and +1 ({100 + k}) 555-{1000 + k} end" for k in range(60)]
    texts = EDGE + ["nothing here"] + mails
    df = docs(spark, texts)
    tagger = pii.train(df, most=100)
    got = {x.doc_id: x for x in pii.find_personal_data(df, tagger).collect()}
    for i, t in enumerate(texts):
        base = spans_by_pattern(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest() and got[i].n_email == sum(k == "email" for k, *_ in base)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i].spans.split(","))
    found = sum(len(set(tagger.spans(t, 0.5)) & set(spans_by_pattern(t))) for t in mails)
    assert found > 0.8 * 2 * len(mails)
    clean = {x.doc_id: x.text for x in pii.redact_column(df, tagger).collect()}
    assert clean[len(EDGE)] == "nothing here" and "@" not in clean[len(texts) - 1] and "[EMAIL]" in clean[len(texts) - 1] and clean[0] is None
    empty = docs(spark, [])
    assert pii.train(empty) is None and pii.find_personal_data(empty, None).count() == 0


def test_quality_rules(spark):
    rep = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = EDGE + [f"{rep} {rep} x y z w v u", "a\nb\na\n\n \n \nb", "#$% &|<> *** x", " ".join(map(str, range(40)))] + sample(60)
    labels = spark.createDataFrame([(i, 1 if i % 3 else 0, 0) for i in range(0, len(texts), 2)] + [(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.judge(docs(spark, texts), labels).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.rule_counts(t), i
        assert not (r.kept and r.base_failed)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept != r.base_failed for r in quality_rules.judge(docs(spark, texts), none).collect())
    assert quality_rules.judge(docs(spark, []), labels).count() == 0


def test_cutoffs_are_certified(spark):
    good = ["plain words " * 20 + f"{k}" for k in range(400)]
    rows = [(i, 50, 0, 0, 0, 0, 0, 10, False, 0.0, 0.0, 0.0, 0.0, 0) for i in range(len(good))]
    m = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_capitals long, n_lines long, base_failed boolean, symbols double, dup_lines double, repeats double, capitals double, stratum int")
    labels = spark.createDataFrame([(i, 1) for i in range(len(good))], "doc_id long, quality int")
    m = m.withColumn("badness", F.col("symbols"))
    cut = quality_rules.certified(m, labels)
    assert cut == dict.fromkeys(range(4), 0.02) and not quality_rules.certified(m.limit(20), labels)
    # a repeated row is one trial
    assert not quality_rules.certified(m.limit(20).crossJoin(spark.range(30)), labels)
    from math import comb

    assert abs(quality_rules.binomial_tail(3, 40, 0.1) - sum(comb(40, k) * 0.1**k * 0.9 ** (40 - k) for k in range(4))) < 1e-12


def glob_regex(p):
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", p)) + r"\Z")


def test_globs_equal_regex():
    r = random.Random(9)
    patterns = ["".join(r.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(r.randrange(1, 9))) for _ in range(60)]
    patterns = [re.sub(r"\*{2,}", "**", p) for p in patterns]
    texts = ["".join(r.choice("ab/") for _ in range(r.randrange(0, 12))) for _ in range(300)] + [""]
    g = url_filter.Globs(patterns)
    assert g.width > 1
    for first, buf, offsets in blocks(pa.array(texts)):
        hit = g.match(buf, offsets)
        for i in range(len(offsets) - 1):
            assert hit[i].tolist() == [bool(glob_regex(p).match(texts[first + i])) for p in patterns]


def test_url_verdicts(spark):
    cases = [("http://A.example.org/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"), ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"), ("ftp://x.org?q", "x.org", "", None, "allow"), ("http://a.com/fr/x", "a.com", "/fr/x", "com/fr/", "allow"), ("http://acom/fr/", "acom", "/fr/", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://cheap-pills.net/", "cheap-pills.net", "/", None, "block"), ("a://b://c.de/x", "b:", "//c.de/x", None, "allow"), ("http://org/" + "p" * 5000, "org", "/" + "p" * 5000, "org/", "allow"), ("http://u@Ads.shop.net.:80//x", "u@ads.shop.net.:80", "//x", None, "block"), ("http://a.net/c%61sino/", "a.net", "/c%61sino/", None, "block"), ("http://a.net/x.zip", "a.net", "/x.zip", None, "block")]
    df = spark.createDataFrame([(k, c[0], "h", "x") for k, c in enumerate(cases)], "page_id long, url string, html string, rule string")
    got = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    for k, c in enumerate(cases):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == c[1:], c
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_word_hashes():
    texts = ["ab cd", "ab", None, " cd  ab", "", "ab"]
    seen = collections.defaultdict(set)
    for _, buf, offsets in blocks(pa.array(texts)):
        s, e, at = words(buf, offsets)
        hashes, first = word_hashes(buf, offsets)
        assert first.tolist() == at.tolist()
        for x, y, h in zip(s, e, hashes.tolist()):
            seen[bytes(buf[x:y])].add(h)
        assert np.diff(at).tolist() == [2, 1, 0, 2, 0, 1]
    assert {k: len(v) for k, v in seen.items()} == {b"ab": 1, b"cd": 1} and seen[b"ab"] != seen[b"cd"]


def test_suffix_array():
    r = np.random.default_rng(4)
    for n in (2, 30, 400):
        t = r.integers(0, 3, n)
        t[0] = t[-1] = 0
        key = []
        for i in range(n):
            key.append([(0, i + k) if c == 0 else (1, int(c)) for k, c in enumerate(t[i:])])
        assert fm_index.suffix_array(t).tolist() == sorted(range(n), key=lambda i: key[i])


def test_decontamination(spark):
    texts = sample(60)
    items = [(1, " ".join(texts[0].split()[:30])), (2, texts[5]), (3, "Xyz, tiny Item"), (4, None), (5, "..."), (10, texts[5]), (2, "other"), (None, "a b c")]
    more = texts + EDGE + ["before xyz TINY item after", (texts[5] + " ") * 3, f"{texts[1]} {texts[5]}. {texts[2]}"]
    df, bench = docs(spark, more), spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(list(enumerate(more)), [x for x in items if x[0] is not None])
    for size in (1 << 23, 50):
        got = {r.doc_id: r for r in fm_index.decontaminate(df, bench, slice_bytes=size).collect()}
        for i in range(len(more)):
            n, hit, found = want[i]
            assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, hit, len(found), hit > 0) and got[i].items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert sum(s.end - s.start for s in got[i].spans) == hit
    kept = {r.doc_id for r in fm_index.drop_contaminated(df, bench).collect()}
    assert kept == {i for i in want if not want[i][1]}
    assert fm_index.decontaminate(df, bench.limit(0)).where("contaminated").count() == 0 and fm_index.decontaminate(df.limit(0), bench).count() == 0


def test_near_duplicates(spark):
    texts = sample(220) + EDGE
    rows = list(enumerate(texts)) + [(7, texts[9]), (7, texts[7]), (None, texts[0])]
    got = minhash.near_duplicates(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    want = brute.near(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])
    assert {r.n_shingles for r in got if r.doc_id == 3} == {len(brute.shingles(texts[3]))}
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_links_past_the_pivot(spark):
    """A chain of edits: neighbours are linked, most are not linked with the smallest id."""
    r, w = random.Random(12), [f"w{k}" for k in range(100)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(w))
        w[r.randrange(100)] = f"v{r.randrange(10**9)}"
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs(spark, texts)).collect()}
    assert got == brute.near(list(enumerate(texts)))


def test_sketches_fill_and_estimate():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 500).astype(np.uint64))
    b = np.concatenate([a[:400], np.unique(r.integers(0, 2**63, 100).astype(np.uint64))])
    s = minhash.sketches(np.array([0, len(a), len(a) + len(b), len(a) + len(b) + 3]), np.concatenate([a, b, a[:3]]), 240)
    assert (s != ~np.uint64(0)).all() and abs((s[0] == s[1]).mean() - 400 / 600) < 0.12


def test_classifier(spark):
    r = random.Random(2)
    good = lambda: " ".join(r.choice(["the", "of", "and", "river", "stone", "cloud"]) for _ in range(40))
    bad = lambda: " ".join(r.choice(["BUY!!", "now$$$", "the", "of", "click|"]) for _ in range(40))
    texts = [good() if k % 4 else bad() for k in range(300)] + EDGE
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(300)] + [(5, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    df = docs(spark, texts)
    got = {x.doc_id: x for x in nb_svm.quality_scores(df, labels).collect()}
    assert len(got) == len(texts) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, x in got.items())
    held = [i for i in range(300) if got[i].held_out]
    assert np.mean([got[i].predicted == int(i % 4 > 0) for i in held]) > 0.97
    assert {x.doc_id for x in nb_svm.keep_good(df, labels).collect()} == {i for i, x in got.items() if x.predicted}
    none = labels.limit(0)
    assert {x.score for x in nb_svm.quality_scores(df, none).collect()} == {0.5} and nb_svm.quality_scores(docs(spark, []), labels).count() == 0


def test_archives(spark):
    pages = [(k, f"http://x/{k}\n", ("same" if k % 3 == 0 else f"<p>Ä{k}</p>\r\n\r\nWARC/1.1") * (1 + 400 * (k % 7 == 0))) for k in range(120)] + [(200, None, None), (201, "u", ""), (201, "u", ""), (None, "n", "same"), (None, "z", "only")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, file string")
    index = warc.write_archives(df, warc.fresh_path(spark, "w"), bundle_bytes=20_000)
    got = warc.read_archives(index, payloads=True).collect()
    body = lambda h: (h or "").encode()
    top = {}
    for i, _, h in pages:
        top[body(h)] = max(x for x in (i, top.get(body(h)), -1) if x is not None)
    want = []
    for i, u, h in pages:
        m = top[body(h)] if top[body(h)] >= 0 else None
        kind = "response" if i == m else "revisit"
        want.append((i, len(body(h)), base64.b32encode(hashlib.sha1(body(h)).digest()).decode(), kind, m if kind == "revisit" else None, u, body(h) if kind == "response" else None))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url, None if r.payload is None else bytes(r.payload))) for r in got)
    at = index.where("page_id = 119").first()
    assert warc.read_record(at.file, at.frame, at.offset, at.size)[0]["X-Page-ID"] == "119"
    # a minimal reader of its own: plain Zstandard frames in a row, records by their length alone
    ids, kinds, named = [], collections.Counter(), []
    for file in {r.file for r in index.collect()}:
        data = zstandard.ZstdDecompressor().stream_reader(open(file.removeprefix("file://"), "rb"), read_across_frames=True).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines)
            n = int(fields["Content-Length"])
            assert version == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n" and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"]) and fields["Content-Type"]
            assert fields["WARC-Type"] == "warcinfo" or re.fullmatch(r"[!-~]+", fields["WARC-Target-URI"]) and rest.startswith(b"HTTP/1.1 200")
            ids.append(fields["WARC-Record-ID"])
            kinds[fields["WARC-Type"]] += 1
            named += [fields["WARC-Refers-To"]] if "WARC-Refers-To" in fields else []
            data = rest[n + 4 :]
    assert len(set(ids)) == len(ids) and set(named) <= set(ids) and kinds["warcinfo"] == index.select("file").distinct().count() and sum(kinds.values()) == len(pages) + kinds["warcinfo"]
    assert warc.read_archives(warc.write_archives(df, warc.fresh_path(spark, "w"), least=10**6)).where("record_type = 'revisit'").count() == 0
    assert warc.archive(df.limit(0)).count() == 0


def test_archives_of_rows_in_several_files(spark):
    rows = [(k, f"http://x/{k}", "same" if k % 4 == 0 else f"page {k}") for k in range(200)] + [(7, "http://x/7", "page 7")] * 30
    folder = warc.fresh_path(spark, "files")
    for k in range(3):
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).write.mode("append").parquet(folder)
    df = spark.read.parquet(folder).repartition(7)
    kinds = warc.kinds(df, 0, "page_id", "html", share=10)
    assert kinds.withColumn("task", F.spark_partition_id()).groupBy("page_id", "share").agg(F.countDistinct("task").alias("n")).where("n > 1").count() == 0
    assert kinds.where("page_id = 7").select("share").distinct().count() > 3
    index = warc.write_archives(df, warc.fresh_path(spark, "w"))
    ids, named = [], set()
    for r in index.collect():
        head = warc.read_record(r.file, r.frame, r.offset, r.size)[0]
        ids.append(head["WARC-Record-ID"])
        named |= {head.get("WARC-Refers-To")} - {None}
    assert len(ids) == 690 == len(set(ids)) and len(named) == 1 and named <= set(ids)
    assert warc.read_archives(index).where("record_type = 'revisit'").count() == 49 * 3


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    start = spark.read.parquet(f"{sf}/documents.parquet")
    df = start
    for name, stage in p.STAGES:
        before = {r.doc_id: r.text for r in df.collect()}
        out = stage(spark, df, sf)
        after = {r.doc_id: r for r in out.collect()}
        if name == "near_dedup":
            want = brute.near(list(before.items()), k=5)
            assert set(after) == {i for i in before if want[i] == i}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            want = brute.contamination(list(before.items()), items)
            assert set(after) == {i for i in before if not want[i][1]}
        if name == "pii":
            assert set(after) == set(before) and all(not spans_by_pattern(r.text) and r.n_chars == len(r.text) for r in after.values())
        if name != "tokens":
            assert out.columns == start.columns
        assert set(after) <= set(before) and len(after) > 0.5 * len(before)
        df = p.staged(out, "test-stage")
    assert {r.doc_id for r in p.run(spark, sf).select("doc_id").collect()} == {r.doc_id for r in df.select("doc_id").collect()}
