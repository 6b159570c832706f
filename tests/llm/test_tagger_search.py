"""The Viterbi search of windows that aren't surely outside, and the reader's work; texts begin in training as for the reader."""

import numpy as np
from test_llm import docs

from contiglink.llm import pii


def plain_paths(reader, s):
    """Every tag from every tag, and the whole way back."""
    v = [s[0] + reader.start]
    for k in range(1, len(s)):
        v.append((v[-1][:, None] + reader.move[:, :, None]).max(0) + s[k])
    out = [v[-1].argmax(0)]
    for k in range(len(s) - 2, -1, -1):
        out.append((v[k] + reader.move[:, out[-1]]).argmax(0))
    return np.stack(out[::-1])


def test_paths_equal_a_plain_search():
    rng, reader = np.random.default_rng(1), pii.Reader(pii.Tagger())
    for shift, n in ((0, 300), (2, 300), (4, 300), (8, 300), (8, 7), (40, 300)):
        s = rng.standard_normal((50, pii.TAGS, n)).astype(np.float32) * 2
        s[:, 0] += shift  # some, most or all windows stay outside
        assert (reader.paths(s) == plain_paths(reader, s)).all(), shift


def test_kept_arrays_do_not_leak():
    rng, kept = np.random.default_rng(2), pii.Reader(pii.Tagger())
    for n in (5, 9, 5, 5):
        x = rng.integers(0, pii.SYMBOLS, (pii.WINDOW, n))
        assert (kept.scores(x) == pii.Reader(pii.Tagger()).scores(x)).all()


def test_texts_begin_in_their_window(spark, monkeypatch):
    """No training window of the corpus begins before its text, as none of the reader's does."""
    seen = []
    monkeypatch.setattr(pii, "fitted", lambda spark, x, y, epochs: seen.append((x, y)) or pii.Tagger())
    texts = [f"a.{k}x@mail{k}.example.com and {'more ' * (k % 30)}+1 (100) 555-{1000 + k}" for k in range(60)]
    pii.train(docs(spark, texts), most=500)
    x, y = (v[:-5000] for v in seen[0])  # made windows come last
    own = x[(y == 1 + 2 * pii.KINDS.index("email")).any(1)][:60]
    assert len(own) and (own[:, 0] != pii.PAD).all()


def test_windows_left_out_stay_outside():
    """Whatever the transitions, no window with a span is left out; with moderate ones over half of the others aren't searched."""
    rng = np.random.default_rng(3)
    for wild in (0.5, 2):
        clean = left = 0
        for shift in (1, 2, 3, 4, 6, 8):
            reader = pii.Reader(pii.Tagger())
            reader.move = np.where(pii.FORBIDDEN, -1e4, rng.standard_normal(reader.move.shape) * wild).astype(np.float32)
            reader.start = (rng.standard_normal(reader.start.shape) * wild).astype(np.float32)
            s = rng.standard_normal((40, pii.TAGS, 400)).astype(np.float32)
            s[:, 0] = 0
            s[:, 1:] -= shift
            stays, plain = reader.outside(s), plain_paths(reader, s)
            assert not plain[:, stays].any(), shift
            assert (reader.paths(s) == plain).all(), shift
            clean, left = clean + (~plain.any(0)).sum(), left + stays.sum()
        assert 0 < clean < 2400 and (wild > 1 or left > 0.5 * clean), (wild, clean, left)


def test_text_ends_read_as_whole_windows():
    """Texts of one window together: tags as by a window filled up behind each text's end."""
    t, r = pii.Tagger(), np.random.default_rng(4)
    t.p = {k: v * (3 if k in ("embed", "out") else 1) for k, v in t.p.items()}
    texts = ["".join(r.choice(list("ab .@1é٣"), n)) for n in (1, 2, 7, 33, 60, 100, pii.WINDOW - 9, pii.WINDOW - 1, pii.WINDOW)]
    best, _, bounds = pii.Reader(t).tags(texts)
    want = [t.best(pii.window_codes(pii.codes(x), [0], pii.WINDOW))[0, : len(x)] for x in texts]
    assert (best == np.concatenate(want)).mean() > 0.99  # but for ties in 32 bits
    for k, text in enumerate(texts):  # whatever is read together
        assert (best[bounds[k] : bounds[k + 1]] == pii.Reader(t).tags([text])[0]).mean() > 0.99


def test_every_place_is_read_about_once(monkeypatch):
    """Both ways over all places of the texts, again where windows overlap, and little behind ends; clean windows aren't searched."""
    read, searched = [], []
    step, search = pii.Reader.step, pii.Reader.search
    monkeypatch.setattr(pii.Reader, "step", lambda self, gates, into, *room: read.append(into.shape[1]) or step(self, gates, into, *room))
    monkeypatch.setattr(pii.Reader, "search", lambda self, s: searched.append(s.shape[2]) or search(self, s))
    tagger = pii.Tagger()
    tagger.p["bias"][0] = 30  # nothing but outside
    texts = ["lorem ipsum " * (k + 1) for k in range(300)]
    places = sum(map(len, texts))
    assert pii.Reader(tagger).spans(texts) == [[]] * 300
    assert 2 * places <= sum(read) <= 2 * (places * pii.WINDOW / pii.STEP + pii.AFTER * len(texts)) and sum(searched) == 0, (places, sum(read), searched)
