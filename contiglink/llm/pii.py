"""Personal data: exact base patterns, and spans added by a character BiLSTM with CRF transitions.

Base spans follow four patterns, leftmost and not overlapping per kind; a match that fails its check (address parts
up to 255, Luhn, digit counts) is dropped. They are found by scanners that take linear time on any text.

The tagger reads every text whole: windows of WINDOW characters, STEP apart, cover it from its first to its last
character; what a last window has behind the text's end is outside, but for AFTER places. Each window is decoded by
Viterbi search over a bidirectional LSTM's scores and CRF transitions, of which those into the inside of a span from
anywhere else are forbidden; a bound on all paths tells the windows that can only stay outside, which are not
searched. The windows' paths are reconciled over the whole text: between two windows the path changes over at the
place of their overlap, nearest its middle, where both have the same tag. A span's score is the log odds of its path
against one without it; spans below the log odds of SURE are dropped, as are those that a base span overlaps (base ones
stay) and those that fail the checks of their kind, which also take digits of other scripts, spelled-out digits and a
spelled-out `@`.

The tagger is trained in numpy on labelled spans of two sorts: at most `most` different windows of the corpus around
digits and `@`, labelled by the base spans, and MADE made ones, in which invented data (plain, obfuscated, spelled
out, with other separators) or harmless numbers stand between text of the corpus. Text without digits and `@` is
added unlabelled. Digits of other scripts read as ASCII's. The weights are of fixed size and travel with the tasks.
Without any text of WINDOW characters and any digit nothing is added. Null texts count as empty. Repeated rows give
repeated results; an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import blocks

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP = 128, 96  # of the reader
AFTER = 8  # places behind a text's end that are scored
TRAIN_WINDOW, TRAIN_STEP, MARGIN = 64, 32, 20
MOST, MADE = 1000, 4000
SURE = 0.8
EMBED, HIDDEN, EPOCHS, BATCH, RATE = 12, 16, 16, 100, 0.02
STEPS = 300  # at least so many, however few windows there are
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: No way from the row's tag to the column's: an inside follows its own begin or inside.
FORBIDDEN = np.array([[y > 0 and y % 2 == 0 and x not in (y - 1, y) for y in range(TAGS)] for x in range(TAGS)])

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # matches at every digit, so long digit runs take linear time
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TRIGGER = np.zeros(256, bool)
TRIGGER[48:58] = TRIGGER[64] = True
TRIGGERS = re.compile(r"[0-9@]")

#: spelled-out digits, `@` and dots, in the languages of the texts
DIGIT_WORDS = (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"), ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"), ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
)
AT_WORDS, DOT_WORDS = ("at", "arroba", "arobase", "AT"), ("dot", "punto", "point", "punkt", "DOT")
AROUND = ((" ", " "), (" (", ") "), (" [", "] "), ("[", "]"), ("(", ")"))
#: marks between the parts of made data: each ASCII mark by itself, and one for all of other scripts
JOINTS = ("-", ".", "/", "_", ":", ",", ";", "|", "*", "+", "~", "=", "#", "\u00b7")
DIGITS = re.compile(r"\d|(?<!\w)(?:" + "|".join(sorted({w for ws in DIGIT_WORDS for w in ws})) + r")(?!\w)", re.I)
DOT_WORD = re.compile(r"(?<!\w)(?:" + "|".join(DOT_WORDS) + r")(?!\w)", re.I)
AT_SIGN = re.compile(r"[@\uFF20\uFE6B]|(?<!\w)(?:" + "|".join(AT_WORDS) + r")(?!\w)", re.I)

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in CHAIN.finditer(text):
        at, parts = chain.start(), chain[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in four):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    return [(kind, a, b) for kind, find in zip(KINDS, (emails, addresses, cards, phones)) for a, b in find(text)]


def _classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, 128, np.uint8)
    for c in range(128, sys.maxunicode + 1):
        if (d := unicodedata.decimal(chr(c), None)) is not None:
            out[c] = 48 + d
    out[:128] = np.arange(128)
    out[[0xFF20, 0xFE6B]] = 64
    return out


_class_table: list[np.ndarray] = []


def codes(text: str) -> np.ndarray:
    """Character classes of a text: letters, digits and marks of ASCII each have one, digits and `@` of other scripts
    that of ASCII's; others share one."""
    if not _class_table:
        _class_table.append(_classes())
    return _class_table[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int64)


PAD, SYMBOLS = 129, 130
NEVER = -1e4  # the score of what can't be


def windows_of(text: str) -> list[int]:
    """Starts of the windows that cover all triggers and the margins, for training."""
    out: list[int] = []
    covered = -1
    for m in TRIGGERS.finditer(text):
        at = m.start()
        if at + MARGIN < covered:
            continue
        begin = at - MARGIN if at - MARGIN > covered - (TRAIN_WINDOW - TRAIN_STEP) else (out[-1] + TRAIN_STEP if out else at - MARGIN)
        while begin + TRAIN_WINDOW < at + MARGIN:
            out.append(begin)
            begin += TRAIN_STEP
        out.append(begin)
        covered = begin + TRAIN_WINDOW
    return out


def windows_over(size: int) -> np.ndarray:
    """Starts of the windows that cover a whole text."""
    return np.arange(max(1, -(-(size - WINDOW) // STEP) + 1) if size else 0) * STEP


def window_codes(x: np.ndarray, starts: list[int], size: int = TRAIN_WINDOW) -> np.ndarray:
    at = np.asarray(starts)[:, None] + np.arange(size)
    return np.where((at >= 0) & (at < len(x)), x[np.clip(at, 0, len(x) - 1)], PAD)


def tags_of(size: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for kind, a, b in spans:
        if not out[a:b].any():
            k = 1 + 2 * KINDS.index(kind)
            out[a:b] = k + 1
            out[a] = k
    return out


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), the cells' activation; gates have it moved to 0..1."""
    return x / (1 + np.abs(x))


class Tagger:
    """BiLSTM-CRF over windows, in numpy."""

    def __init__(self, seed: int = 5, numbers: type = np.float32):
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.p = {"embed": f(SYMBOLS, EMBED), "out": f(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}
        for d in ("f", "b"):
            self.p |= {f"w{d}": f(EMBED, 4 * HIDDEN), f"u{d}": f(HIDDEN, 4 * HIDDEN), f"c{d}": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])}
        self.p = {k: v.astype(numbers) for k, v in self.p.items()}

    def _lstm(self, e: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        n, t, _ = e.shape
        h, c, out, kept = *(np.zeros(x, e.dtype) for x in ((n, HIDDEN), (n, HIDDEN), (n, t, HIDDEN))), []
        x = e @ self.p[f"w{d}"] + self.p[f"c{d}"]
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = x[:, k] + h @ self.p[f"u{d}"]
            i, f, o = np.split((1 + squash(z[:, : 3 * HIDDEN])) / 2, 3, 1)
            g = squash(z[:, 3 * HIDDEN :])
            was, h0 = c, h
            c = f * c + i * g
            tc = squash(c)
            h = o * tc
            out[:, k] = h
            kept.append((k, i, f, o, g, was, tc, h0))
        return out, kept

    def _lstm_back(self, e: np.ndarray, d: str, dh_all: np.ndarray, kept: list, grad: dict) -> np.ndarray:
        n = len(e)
        dh, dc, dx = (np.zeros(x, e.dtype) for x in ((n, HIDDEN), (n, HIDDEN), (*e.shape[:2], 4 * HIDDEN)))
        du = np.zeros_like(self.p[f"u{d}"])
        slope = lambda y: (1 - np.abs(y)) ** 2  # noqa: E731  (of squash, by its value)
        gate = lambda y: slope(2 * y - 1) / 2
        for k, i, f, o, g, was, tc, h0 in reversed(kept):
            dh = dh + dh_all[:, k]
            dc = dc + dh * o * slope(tc)
            dz = np.concatenate([dc * g * gate(i), dc * was * gate(f), dh * tc * gate(o), dc * i * slope(g)], 1)
            dx[:, k] = dz
            du += h0.T @ dz
            dh, dc = dz @ self.p[f"u{d}"].T, dc * f
        flat = dx.reshape(-1, 4 * HIDDEN)
        grad[f"u{d}"], grad[f"c{d}"], grad[f"w{d}"] = du, flat.sum(0), e.reshape(-1, EMBED).T @ flat
        return dx @ self.p[f"w{d}"].T

    def _scores(self, x: np.ndarray):
        e = self.p["embed"][x]
        (hf, kf), (hb, kb) = self._lstm(e, "f"), self._lstm(e, "b")
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["out"] + self.p["bias"], (e, h, kf, kb)

    def _chain(self, s: np.ndarray):
        """Log forward and backward sums and the log of the total."""
        n, t, _ = s.shape
        fwd, bwd = np.zeros_like(s), np.zeros_like(s)
        fwd[:, 0] = s[:, 0] + self.p["start"]
        for k in range(1, t):
            a = fwd[:, k - 1, :, None] + self.p["move"]
            m = a.max(1)
            fwd[:, k] = s[:, k] + m + np.log(np.exp(a - m[:, None]).sum(1))
        for k in range(t - 2, -1, -1):
            a = self.p["move"] + (s[:, k + 1] + bwd[:, k + 1])[:, None]
            m = a.max(2)
            bwd[:, k] = m + np.log(np.exp(a - m[:, :, None]).sum(2))
        m = fwd[:, -1].max(1)
        return fwd, bwd, m + np.log(np.exp(fwd[:, -1] - m[:, None]).sum(1))

    def best(self, x: np.ndarray) -> np.ndarray:
        """The best path of each window."""
        s, _ = self._scores(x)
        move = np.where(FORBIDDEN, NEVER, self.p["move"])
        v, back = s[:, 0] + self.p["start"], []
        for k in range(1, x.shape[1]):
            a = v[:, :, None] + move
            back.append(a.argmax(1))
            v = a.max(1) + s[:, k]
        path = [v.argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(x)), path[-1]])
        return np.stack(path[::-1], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> list[float]:
        """Adam on the negative log-likelihood, its rate falling to a tenth; the mean loss of each epoch."""
        rng, first, second, step, losses = np.random.default_rng(11), {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0, []
        steps = epochs * -(-len(x) // BATCH)
        for _ in range(epochs):
            order, total = rng.permutation(len(x)), 0.0
            for cut in range(0, len(x), BATCH):
                loss, grad = self._loss(x[order[cut : cut + BATCH]], y[order[cut : cut + BATCH]])
                total += loss
                step += 1
                rate = RATE * (1 - 0.9 * step / steps)
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            losses.append(total / len(x))
        return losses

    def _loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        n, t = x.shape
        s, (e, h, kf, kb) = self._scores(x)
        fwd, bwd, total = self._chain(s)
        rows, cols = np.arange(n)[:, None], np.arange(t)
        gold = s[rows, cols, y].sum(1) + self.p["start"][y[:, 0]] + self.p["move"][y[:, :-1], y[:, 1:]].sum(1)
        ds = np.exp(fwd + bwd - total[:, None, None])
        grad = {"start": ds[:, 0].sum(0) / n}
        pair = fwd[:, :-1, :, None] + self.p["move"] + (s[:, 1:] + bwd[:, 1:])[:, :, None] - total[:, None, None, None]
        grad["move"] = np.exp(pair).sum((0, 1)) / n
        grad["move"] -= (np.bincount((y[:, :-1] * TAGS + y[:, 1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS) / n).astype(s.dtype)
        grad["start"] -= (np.bincount(y[:, 0], minlength=TAGS) / n).astype(s.dtype)
        ds[rows, cols, y] -= 1
        ds /= n
        grad["out"], grad["bias"] = h.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, TAGS), ds.sum((0, 1))
        dh = ds @ self.p["out"].T
        de = self._lstm_back(e, "f", dh[:, :, :HIDDEN], kf, grad) + self._lstm_back(e, "b", dh[:, :, HIDDEN:], kb, grad)
        grad["embed"] = np.stack([np.bincount(x.ravel(), de[..., j].ravel(), SYMBOLS) for j in range(EMBED)], 1).astype(de.dtype)
        return float((total - gold).sum()), grad

    def spans(self, text: str, sure: float = SURE) -> list[Span]:
        """Spans of a whole text."""
        return Reader(self).spans([text], sure)[0]


class Reader:
    """A tagger's best paths over many windows, with 32-bit numbers."""

    MOST = 1024  # windows at once
    CHARS = 1 << 22  # of texts at once; a longer text is read alone
    NEAR = 0.01  # windows whose bound is so near are searched, whatever is lost to rounding

    def __init__(self, tagger: Tagger):
        p = tagger.p
        # gates are kept doubled (1 + squash), so states are too
        self.embed = np.ascontiguousarray(np.concatenate([p["embed"].T, np.ones((1, SYMBOLS))]), np.float32)
        self.gates = [np.ascontiguousarray(np.concatenate([p[f"u{d}"] / 2, p[f"w{d}"], p[f"c{d}"][None]]).T, np.float32) for d in "fb"]
        self.out = np.ascontiguousarray((p["out"].T - p["out"].T[0]) / 2, np.float32)  # above the score of outside
        self.bias = (p["bias"] - p["bias"][0]).astype(np.float32)[:, None]
        self.kept: dict[str, np.ndarray] = {}
        self.after = self.after_text()
        self.move, self.start = np.where(FORBIDDEN, NEVER, p["move"]).astype(np.float32), p["start"].astype(np.float32)[:, None]

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array kept from call to call, which would otherwise be mapped and cleared anew for every call."""
        if name not in self.kept or self.kept[name].shape != shape:
            self.kept[name] = np.empty(shape, np.float32)
        return self.kept[name]

    def step(self, gates: np.ndarray, into: np.ndarray, c: np.ndarray, z: np.ndarray, size: np.ndarray, tc: np.ndarray) -> None:
        """The cells' next states, in place; the last three are room."""
        i, f, o, g = (z[k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        np.matmul(gates, into, out=z)
        np.abs(z, out=size)
        size += 1
        z /= size
        z[: 3 * HIDDEN] += 1
        c *= f
        i *= g
        c += i
        c *= 0.5
        np.abs(c, out=tc)
        tc += 1
        np.divide(c, tc, out=tc)
        np.multiply(o, tc, out=into[:HIDDEN])

    def after_text(self) -> np.ndarray:
        """The states (h, c) of the way back after 0 to WINDOW places behind a text's end."""
        into, c, out = np.zeros((HIDDEN + EMBED + 1, 1), np.float32), np.zeros((HIDDEN, 1), np.float32), np.zeros((2, HIDDEN, WINDOW + 1), np.float32)
        into[HIDDEN:, 0] = self.embed[:, PAD]
        room = [np.empty((k * HIDDEN, 1), np.float32) for k in (4, 4, 1)]
        for k in range(1, WINDOW + 1):
            self.step(self.gates[1], into, c, *room)
            out[0, :, k], out[1, :, k] = into[:HIDDEN, 0], c[:, 0]
        return out

    def scores(self, x: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """(place, tag, window) for the codes (place, window), above the score of outside; holds until the next call.
        With falling sizes of the windows, the rest of a window is behind its text's end and outside; its way back
        begins with the state after that rest."""
        t, n = x.shape
        live = np.full(t, n) if sizes is None else np.searchsorted(-sizes, -np.arange(t))  # windows at each place
        states, scores = self.room("states", t, 2 * HIDDEN, n), self.room("scores", t, TAGS, n)
        room = [np.empty((k * HIDDEN, n), np.float32) for k in (4, 4, 1)]
        for d, gates in enumerate(self.gates):
            into, c = np.zeros((HIDDEN + EMBED + 1, n), np.float32), np.zeros((HIDDEN, n), np.float32)
            if d and sizes is not None:
                into[:HIDDEN], c[:] = self.after[:, :, WINDOW - sizes]
            for k in range(t) if d == 0 else range(t - 1, -1, -1):
                m = int(live[k])
                np.take(self.embed, x[k, :m], axis=1, mode="clip", out=into[HIDDEN:, :m])
                self.step(gates, into[:, :m], c[:, :m], *(v[:, :m] for v in room))
                states[k, d * HIDDEN : (d + 1) * HIDDEN, :m] = into[:HIDDEN, :m]
        ends = np.flatnonzero(live < n)
        for k in ends:
            states[k, :, live[k] :] = 0
        np.matmul(self.out, states, out=scores)
        scores += self.bias
        for k in ends:
            scores[k, 1:, live[k] :] = NEVER
        return scores

    def outside(self, s: np.ndarray) -> np.ndarray:
        """Whether a window's best path is surely outside all along, for scores above that of outside: no bound on the
        paths that end in a tag makes up for the way back outside. While that holds, the path outside is the best way to
        outside; begins follow it or the greatest bound of all tags."""
        move, begin, inside = self.move - self.move[0, 0], range(1, TAGS, 2), range(2, TAGS, 2)
        back = move[1:, 0, None]  # bounds are kept with the way back
        enter = move[0, begin][:, None] + back[0::2]
        follow = (move[1:, begin] - back - move[0, begin]).max()  # from a tag rather than from outside
        go_in, go_on = move[begin, inside][:, None] + back[1::2] - back[0::2], move.diagonal()[2::2][:, None]
        n = s.shape[2]
        begun, going, other = (np.empty((len(KINDS), n), np.float32) for _ in range(3))
        was = s[0, 1:] + (self.start[1:] - self.start[0] + back)
        begun[:], going[:] = was[0::2], was[1::2]
        top = was.max(0)
        most = top.copy()
        for k in range(1, len(s)):
            top += follow
            np.maximum(top, 0, out=top)
            going += go_on
            np.add(begun, go_in, out=other)
            np.maximum(going, other, out=going)
            going += s[k, 2::2]
            np.add(s[k, 1::2], enter, out=begun)
            begun += top
            np.maximum(begun, going, out=other)
            np.max(other, 0, out=top)
            np.maximum(most, top, out=most)
        last = np.maximum(begun - back[0::2], going - back[1::2]).max(0)
        return (most < -self.NEAR) & (last < -self.NEAR)

    def paths(self, s: np.ndarray) -> np.ndarray:
        """The best path (place, window) for any scores, by Viterbi search in the windows that aren't surely outside."""
        out = np.zeros((len(s), s.shape[2]), np.uint8)
        rest = np.flatnonzero(~self.outside(s - s[:, :1]))
        out[:, rest] = self.search(s[:, :, rest])
        return out

    def search(self, s: np.ndarray) -> np.ndarray:
        """Viterbi search. An inside follows its own begin or inside only."""
        t, _, n = s.shape
        v = np.empty(s.shape, np.float32)
        v[0] = s[0] + self.start
        free = [0, *range(1, TAGS, 2)]  # outside and the begins, which follow any tag
        into, begun, going = self.move[:, free][:, :, None], self.move[range(1, TAGS, 2), range(2, TAGS, 2)][:, None], self.move.diagonal()[2::2][:, None]
        ways, top, other = np.empty((TAGS, len(free), n), np.float32), np.empty((len(free), n), np.float32), np.empty((len(KINDS), n), np.float32)
        for k in range(1, t):
            was, now = v[k - 1], v[k]
            np.add(was[:, None], into, out=ways)
            np.max(ways, 0, out=top)
            now[0], now[1::2] = top[0], top[1:]
            np.add(was[1::2], begun, out=other)
            np.add(was[2::2], going, out=now[2::2])
            np.maximum(now[2::2], other, out=now[2::2])
            now += s[k]
        out = np.empty((t, n), np.uint8)
        out[-1] = v[-1].argmax(0)
        for k in range(t - 2, -1, -1):
            out[k] = (v[k] + self.move[:, out[k + 1]]).argmax(0)
        return out

    def tags(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts in a row: each character's tag, its score above that of none, and the texts' bounds."""
        x = codes("".join(texts)).astype(np.uint8)
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(t) for t in texts], dtype=np.int64)])
        own = [windows_over(len(t)) for t in texts]
        count = np.array([len(w) for w in own])
        start = np.concatenate(own) + np.repeat(bounds[:-1], count)
        end = np.repeat(bounds[1:], count)
        path, gain = np.zeros((WINDOW, len(start)), np.uint8), np.zeros((WINDOW, len(start)), np.float32)
        size = np.minimum(end - start + AFTER, WINDOW)
        order = np.argsort(-size, kind="stable")
        padded = np.concatenate([x, np.full(WINDOW, PAD, np.uint8)])
        found: list[tuple[np.ndarray, np.ndarray]] = []  # windows to be searched, and their scores
        for cut in range(0, len(start), self.MOST):
            own = order[cut : cut + self.MOST]
            at = start[own] + np.arange(size[own[0]])[:, None]
            s = self.scores(np.where(at < end[own], padded[at], PAD), size[own])
            rest = np.flatnonzero(~self.outside(s))
            some = np.full((WINDOW, TAGS, len(rest)), NEVER, np.float32)
            some[:, 0] = 0
            some[: len(s)] = s[:, :, rest]
            found.append((own[rest], some))
            if sum(len(w) for w, _ in found) < self.MOST and cut + self.MOST < len(start):
                continue
            own, s = np.concatenate([w for w, _ in found]), np.concatenate([some for _, some in found], 2)
            found, now = [], self.search(s)
            k, w = np.nonzero(now)
            path[k, own[w]], gain[k, own[w]] = now[k, w], s[k, now[k, w], w]
        # the place in its window from which on, and up to which, a window's path holds
        low, high = np.zeros(len(start), np.int64), np.full(len(start), WINDOW)
        overlap = WINDOW - STEP
        from_middle = np.argsort(np.abs(np.arange(overlap) - overlap // 2), kind="stable")
        meets = np.flatnonzero(end[1:] == end[:-1]) if len(start) else np.zeros(0, np.int64)
        same = path[STEP:, meets] == path[:overlap, meets + 1]
        turn = from_middle[same[from_middle].argmax(0)]
        low[meets + 1], high[meets] = turn, STEP + turn
        best, above = np.zeros(len(x), np.uint8), np.zeros(len(x), np.float32)
        k, w = np.nonzero(path)
        fits = (k >= low[w]) & (k < high[w]) & (start[w] + k < end[w])
        k, w = k[fits], w[fits]
        best[start[w] + k], above[start[w] + k] = path[k, w], gain[k, w]
        return best, above, bounds

    def spans(self, texts: list[str], sure: float = SURE) -> list[list[Span]]:
        """Spans of each text."""
        out: list[list[Span]] = []
        while len(out) < len(texts):
            first = last = len(out)
            size = 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= self.CHARS):
                size += len(texts[last])
                last += 1
            out += self._spans(texts[first:last], math.log(sure / (1 - sure))) if size else [[] for _ in range(last - first)]
        return out

    def _spans(self, texts: list[str], least: float) -> list[list[Span]]:
        best, above, bounds = self.tags(texts)
        out: list[list[Span]] = [[] for _ in texts]
        marks = np.flatnonzero(best)
        at = 0
        while at < len(marks):
            a = int(marks[at])
            doc = int(np.searchsorted(bounds, a, side="right")) - 1
            tag, b = int(best[a]), a + 1
            while b < bounds[doc + 1] and best[b] == tag + tag % 2:
                b += 1
            if tag % 2:  # a span begins here
                way = [0, tag, *[tag + 1] * (b - a - 1), 0]
                score = float(above[a:b].sum()) + float(sum(self.move[x, y] - self.move[0, 0] for x, y in zip(way, way[1:])))
                if score >= least:
                    out[doc].append((KINDS[tag // 2], a - int(bounds[doc]), b - int(bounds[doc])))
            at = int(np.searchsorted(marks, b))
        return out


DIGIT_OF = {w: str(k) for ws in DIGIT_WORDS for k, w in enumerate(ws)}


def figures(text: str) -> str:
    """The text with spelled-out digits and dots, and digits of other scripts, as characters."""
    text = DIGITS.sub(lambda m: DIGIT_OF.get(m[0].lower()) or str(unicodedata.decimal(m[0], "")), text)
    return DOT_WORD.sub(".", text)


def plausible(span: Span, text: str) -> bool:
    """The checks of a kind for added spans: whole tokens at both ends, and as of the base patterns numbers, parts, and Luhn."""
    kind, a, b = span
    if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()):
        return False
    plain = figures(text[a:b])
    digits = "".join(c for c in plain if "0" <= c <= "9")
    if kind == "email":
        return AT_SIGN.search(text[a:b]) is not None and "." in plain
    if kind == "ip":
        between = re.findall(r"(?<=[0-9])[^0-9]+(?=[0-9])", plain)
        alike = len(between) == 3 and len(set(between)) == 1  # one separator, whatever it is
        parts = re.findall("[0-9]+", plain) if alike else re.sub(r"[^0-9.]", "", plain).strip(".").split(".")
        return len(parts) == 4 and all(p and len(p) < 4 and int(p) < 256 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and digits != plain


def all_spans(texts: list[str], has: list[bool], reader: Reader | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text; those without triggers have no base spans."""
    found = reader.spans(texts) if reader else [[] for _ in texts]
    for text, some, tagged in zip(texts, has, found):
        base = base_spans(text) if some else []
        yield base, [s for s in tagged if plausible(s, text) and not any(a < s[2] and s[1] < b for _, a, b in base)]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def texts_with_triggers(col: pa.Array) -> list[bool]:
    out: list[bool] = []
    for _, buf, offsets in blocks(col):
        seen = np.concatenate([np.zeros(1, np.int64), np.cumsum(TRIGGER[buf])])[offsets]
        out += (seen[1:] > seen[:-1]).tolist()
    return out


def spelled(kind: str, span: str, rng: random.Random) -> str:
    """A span with its `@`, dots or digits spelled out."""
    if kind == "email":
        around = rng.choice(AROUND)
        at, dot = (rng.choice(ws).join(around) for ws in (AT_WORDS, DOT_WORDS))
        return span.replace("@", at).replace(".", dot)
    words, dot = rng.choice(DIGIT_WORDS), f" {rng.choice(DOT_WORDS)} "
    out = "".join(f" {words[int(c)]} " if c.isdigit() else dot if c == "." and kind == "ip" else "plus " if c == "+" else " " for c in span)
    return " ".join(out.split())


def joint(rng: random.Random) -> str:
    """What stands between parts: a space, a mark, a mark between spaces or in brackets."""
    if rng.random() < 0.15:
        return " "
    mark = rng.choice(JOINTS)
    return rng.choice((mark, mark, mark, f" {mark} ", f" {mark}", f"{mark} ", f"[{mark}]", f"({mark})"))


def grouped(digits: str, rng: random.Random) -> list[str]:
    """Digits in groups of one size, or of sizes drawn for each."""
    out, size = [], rng.choice((0, 2, 3, 4, 4, 4, 4, 5, 6, 8))
    while digits:
        n = size or rng.randrange(2, 8)
        out.append(digits[:n])
        digits = digits[n:]
    return out


def invented(kind: str, rng: random.Random) -> str:
    """Data of a kind in a form composed of drawn parts, marks and brackets; the base patterns know some of these."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzaeiou") for _ in range(rng.randrange(2, 10)))
    if kind == "email":
        local = rng.choice(["", name() + rng.choice("._-")]) + name() + rng.choice(["", number(2), "." + number(2)])
        plain = f"{local}@{name()}{rng.choice(['', '.' + name(), number(1)])}.{rng.choice(['com', 'org', 'net', 'example', 'de', 'fr'])}"
        way = rng.random()
        if way < 0.4:
            return spelled(kind, plain, rng)
        if way < 0.7:  # words or signs between marks of any sort
            mark, end = rng.choice(JOINTS), rng.choice(("", " "))
            at, dot = rng.choice((*AT_WORDS, "@")), rng.choice((*DOT_WORDS, "."))
            return plain.replace("@", f"{end}{mark}{at}{mark}{end}").replace(".", rng.choice((".", f"{end}{mark}{dot}{mark}{end}")))
        return plain.replace("@", rng.choice(["@", " @ ", "(@)", "[@]", " @", "@ "])).replace(".", rng.choice([".", ".", " . ", "[.]", "(.)"]))
    if kind == "ip":
        plain = ".".join(str(rng.randrange(256)) for _ in range(4))
        return spelled(kind, plain, rng) if rng.random() < 0.2 else plain.replace(".", rng.choice([".", joint(rng)]))
    if kind == "card":
        head = number(rng.choice((15, 15, 15, 16, 17, 18)))
        digits = head + next(d for d in "0123456789" if luhn(head + d))
        if rng.random() < 0.15:
            return spelled(kind, digits, rng)
        return joint(rng).join(grouped(digits, rng))
    a, b, d = number(rng.choice((2, 3, 3, 4))), number(3), number(rng.choice((3, 4, 4)))
    before = rng.choice(("", "", "+{c}", "00{c}", "0", "(+{c})", "[{c}]")).format(c=rng.randrange(1, 99))
    area = rng.choice(("{a}", "{a}", "({a})", "[{a}]", "(0){a}")).format(a=a)
    mark = joint(rng)
    plain = rng.choice((mark, " ", "")).join(x for x in (before, area) if x) + rng.choice((mark, " ")) + b + rng.choice((mark, mark, "")) + d
    return spelled(kind, plain, rng) if rng.random() < 0.15 else plain


def harmless(rng: random.Random) -> str:
    """Numbers and signs that are no personal data."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        lambda: number(rng.randrange(1, 8)), lambda: f"{number(1)}.{number(1)}", lambda: f"{number(1)}.{number(1)}.{number(2)}", lambda: f"{number(4)}-{number(2)}-{number(2)}",
        lambda: f"{number(2)}:{number(2)}:{number(2)}", lambda: f"{number(3)},{number(3)}.{number(2)}", lambda: f"@{rng.choice(['home', 'user', 'all'])}", lambda: number(rng.randrange(20, 30)),
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 32, 40]))), lambda: f"{rng.choice(AT_WORDS)} {rng.choice(DIGIT_WORDS[0])}", lambda: f"{number(3)}.{number(3)}", lambda: f"v{number(1)}.{number(2)}",
        lambda: joint(rng).join((number(4), number(2), number(2))), lambda: joint(rng).join(number(rng.randrange(1, 4)) for _ in range(rng.choice((2, 3, 5, 6)))), lambda: f"{rng.randrange(24)}:{number(2)} {rng.choice(AT_WORDS)} {number(2)}",
        lambda: joint(rng).join(str(rng.randrange(256, 1000)) for _ in range(4)),
    ])()


def made_windows(plain: list[np.ndarray], most: int, seed: int = 3) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """`most` windows and tags of invented data, and a fourth as many of harmless numbers, between unlabelled text."""
    rng, xs, ys = random.Random(seed), [], []
    for k in range(most + most // 4):
        kind = KINDS[k % len(KINDS)] if k < most else None
        new = codes(invented(kind, rng) if kind else harmless(rng))
        left, right = (rng.choice(plain) if plain else np.full(TRAIN_WINDOW, PAD) for _ in range(2))
        seq = np.concatenate([left, [32], new, [rng.choice([32, 32, 46, 44, 10])], right])
        tag = np.zeros(len(seq), np.int64)
        if kind:
            first = 1 + 2 * KINDS.index(kind)
            tag[TRAIN_WINDOW + 1 : TRAIN_WINDOW + 1 + len(new)] = first + 1
            tag[TRAIN_WINDOW + 1] = first
        start = rng.randrange(8, TRAIN_WINDOW + 1 + max(1, len(new) - TRAIN_WINDOW // 2))
        if start + TRAIN_WINDOW <= len(seq):
            xs.append(seq[start : start + TRAIN_WINDOW])
            ys.append(tag[start : start + TRAIN_WINDOW])
    return xs, ys


def plain_windows(docs: DataFrame, most: int, text_col: str) -> list[np.ndarray]:
    """At most `most` windows of text without digits and `@`, at most one a text, at a place drawn from its hash."""
    text = F.col(text_col)
    at = F.pmod(F.xxhash64(text), F.length(text) - TRAIN_WINDOW + 1).cast("int") + 1
    some = docs.where(F.length(text) >= TRAIN_WINDOW).select(F.substring(text, at, F.lit(TRAIN_WINDOW)).alias("w")).where(~F.col("w").rlike(r"[\p{Nd}@\x{FF20}\x{FE6B}]"))
    return [codes(r.w) for r in some.distinct().orderBy(F.xxhash64("w"), "w").limit(most).collect()]


def train(docs: DataFrame, most: int = MOST, text_col: str = "text") -> Tagger | None:
    """A tagger for the texts, from a bounded sample of windows whose base spans are the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for text, has in zip(batch.column(0), texts_with_triggers(batch.column(0))):
                if not has:
                    continue
                text = text.as_py()
                x, y = codes(text), tags_of(len(text), base_spans(text))
                starts = sorted({max(0, at) for at in windows_of(text)})  # a text begins in its window as for the reader
                at = np.asarray(starts)[:, None] + np.arange(TRAIN_WINDOW)
                tags = np.where((at >= 0) & (at < len(x)), y[np.clip(at, 0, len(x) - 1)], 0)
                xs += [r.tobytes() for r in window_codes(x, starts).astype(np.uint8)]
                ys += [r.tobytes() for r in tags.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    found = docs.select(F.col(text_col)).mapInArrow(run, "x binary, y binary").distinct()
    rows = found.orderBy(F.xxhash64("x"), "x", "y").limit(most).collect()  # at most `most` rows of 128 bytes
    plain = plain_windows(docs, most // 2, text_col)
    if not rows and not plain:
        return None
    pairs = [[np.frombuffer(bytes(r[k]), np.uint8).astype(np.int64) for r in rows] for k in (0, 1)]
    more, tags = made_windows(plain, MADE)
    x, y = np.stack([*pairs[0], *more, *plain]), np.stack([*pairs[1], *tags, *(np.zeros(TRAIN_WINDOW, np.int64) for _ in plain)])
    return fitted(docs.sparkSession, x, y, max(EPOCHS, -(-STEPS // -(-len(x) // BATCH))))


def fitted(spark: SparkSession, x: np.ndarray, y: np.ndarray, epochs: int) -> Tagger:
    """A tagger trained by one task on windows bounded in number, so that it runs again if its executor is lost, and with
    the threads that the session gives a task."""
    codes, tags = x.astype(np.uint8), y.astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            tagger = Tagger()
            tagger.fit(codes.astype(np.int64), tags.astype(np.int64), epochs)
            yield pa.RecordBatch.from_arrays([pa.array(tagger.p), pa.array([v.astype(np.float32).tobytes() for v in tagger.p.values()])], ["name", "weights"])

    tagger = Tagger()
    for row in spark.range(0, 1, 1, 1).mapInArrow(run, "name string, weights binary").collect():
        tagger.p[row.name] = np.frombuffer(bytes(row.weights), np.float32).reshape(tagger.p[row.name].shape)
    return tagger


def find_personal_data(docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base counts by kind, base_sha256, spans and n_added of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)  # of fixed size
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value) if sent.value else None
        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for base, more in all_spans(texts, texts_with_triggers(batch.column(1)), reader):
                if not base and not more:
                    rows.append((0, 0, 0, 0, nothing, "", 0))
                    continue
                spans = ordered(base + more)
                rows.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(more)))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span, or group of overlapping spans, replaced by its first kind's name in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_column(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """docs with the personal data of a text column replaced; other columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value) if sent.value else None
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            was = batch.column(k).to_pylist()
            found = all_spans([t or "" for t in was], texts_with_triggers(batch.column(k)), reader)
            texts = [None if t is None else redact(t, base + more) for t, (base, more) in zip(was, found)]
            cols = list(batch.columns)
            cols[k] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
