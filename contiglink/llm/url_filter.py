"""URL filters by a bit-parallel wildcard automaton.

Glob patterns are packed, one bit a state, into words of 64 bits. Reading one byte of a URL moves the states of all
patterns at once: shift, mask by the byte's transitions, and keep the states whose wildcard accepts the byte. URLs
of an Arrow batch advance together, as many as fit STATE_BYTES. In a pattern `*` stands for any bytes but `/`, `**`
for any bytes, `?` for one byte but `/`; the rest is literal. Patterns are matched against host + path as a whole.

Rules are matched on host and path as they are. Where none fits, block patterns are matched on the canonical URL:
user name, port, and dots at the host's end go, escapes are decoded, and repeated slashes count as one. Only URLs
that have any of these are rewritten one by one. SUSPECT is a small list; `patterns_of` reads thousands from a table,
at most PATTERN_BYTES together. Patterns are dealt into automata of at most AUTOMATON_BITS states, which judge a batch
one after the other, so a URL's state stays small however many there are.

Host and path are cut from the URL with DataFrame functions. Null URLs, and those without `://`, have an empty
host and path, fit no rule and get the default verdict. Empty paths fit no rule, as each rule's path starts with
`/`. Repeated rows give repeated results; only the id and the URL are read; an empty table gives an empty result.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import blocks

U = np.uint64
#: (verdict, rule): a host that stands for itself and its subdomains, and the start of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: What the method blocks where no rule fits.
SUSPECT = (
    *(f"**{word}**" for word in ("casino", "poker", "jackpot", "roulette", "betting", "lottery", "viagra", "cialis", "cheap-pills", "pharmacy-online", "payday-loan", "spam-farm", "porn", "xxx-", "escort", "warez", "torrent", "keygen", "crack-", "free-download", "replica-watch")),
    *(f"**.{end}" for end in ("exe", "msi", "apk", "dmg", "iso", "zip", "rar", "7z", "tar.gz", "jpg", "jpeg", "png", "gif", "mp3", "mp4", "avi")),
    *(f"{host}.*/**" for host in ("ad", "ads", "adserver", "tracker", "click", "*.doubleclick", "*.adservice")),
    *(f"**/{part}/**" for part in ("wp-admin", "wp-login*", "cgi-bin", "phpmyadmin", "login", "signin", "cart", "checkout")),
    "*.onion/**", "*xxx*/**", "?*.?*.?*.?*.?*.?*.?*/**",
)
STATE_BYTES = 16 << 20
AUTOMATON_BITS = 8192
PATTERN_BYTES = 8 << 20


class Globs:
    """All patterns as one automaton."""

    def __init__(self, patterns: list[str]):
        steps: list[list[object]] = []
        for p in patterns:
            out, data = [], p.encode("utf-8")
            i = 0
            while i < len(data):
                if data[i : i + 2] == b"**":
                    out.append("**")
                    i += 2
                    continue
                out.append({ord("*"): "*", ord("?"): "?"}.get(data[i], data[i]))
                i += 1
            steps.append(out)
        size = sum(1 + sum(s not in ("*", "**") for s in x) for x in steps)
        self.width = max(1, -(-size // 64))
        self.move, self.stay = np.zeros((256, self.width), U), np.zeros((256, self.width), U)
        self.start = np.zeros(self.width, U)
        self.final: list[tuple[int, int]] = []
        no_slash = np.arange(256) != ord("/")
        bit = 0
        for x in steps:
            self._set(self.start, bit)
            for s in x:
                if s == "**":
                    self._set(self.stay, bit)
                elif s == "*":
                    self._set(self.stay, bit, no_slash)
                else:
                    bit += 1
                    self._set(self.move, bit, no_slash if s == "?" else np.arange(256) == s)
            self.final.append((bit >> 6, bit & 63))
            bit += 1

    @staticmethod
    def _set(masks: np.ndarray, bit: int, where=slice(None)) -> None:
        if masks.ndim == 1:
            masks[bit >> 6] |= U(1 << (bit & 63))
        else:
            masks[where, bit >> 6] |= U(1 << (bit & 63))

    def match(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text (row) and pattern (column), whether the pattern matches the whole text."""
        rows = max(1, STATE_BYTES // (8 * self.width))
        parts = [self._match(buf, offsets[k : k + rows + 1]) for k in range(0, len(offsets) - 1, rows)]
        return np.concatenate([np.zeros((0, len(self.final)), bool), *parts])

    def _match(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        at, left = offsets[:-1][order], -size[order]
        d = np.tile(self.start, (len(size), 1))
        for p in range(int(size.max(initial=0))):
            n = int(np.searchsorted(left, -p, side="left"))  # those longer than p
            c, now = buf[at[:n] + p], d[:n]
            up = now << U(1)
            up[:, 1:] |= now[:, :-1] >> U(63)
            d[:n] = (up & self.move[c]) | (now & self.stay[c])
        out = np.zeros((len(size), len(self.final)), bool)
        word, bit = (np.array(x) for x in zip(*self.final)) if self.final else (np.zeros(0, np.int64),) * 2
        out[order] = (d[:, word] >> bit.astype(U)) & U(1) == 1
        return out


def rule_globs(rule: str) -> list[str]:
    """The patterns of a host-and-path rule: the host itself and its subdomains."""
    host, _, path = rule.partition("/")
    return [f"{host}/{path}**", f"*.{host}/{path}**"]


def with_host_path(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url_col), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.select(F.col(id_col), F.translate(F.regexp_extract(url, parts, 1), upper, lower).alias("host"), F.regexp_extract(url, parts, 2).alias("path"))


def patterns_of(table: DataFrame, column: str = "pattern", most_bytes: int = PATTERN_BYTES) -> tuple[str, ...]:
    """The distinct patterns of a table; a table with more than most_bytes of them raises before any is fetched."""
    found = table.select(F.col(column).alias("p")).where(F.col(column).isNotNull()).distinct()
    size = found.agg(F.sum(F.octet_length("p"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of patterns: at most {most_bytes} travel to every task")
    return tuple(r[0] for r in found.orderBy("p").collect())


def automata(patterns: tuple[str, ...] | list[str], bits: int = AUTOMATON_BITS) -> list[Globs]:
    """The patterns in automata of at most so many states; a longer pattern has one of its own."""
    out, some, used = [], [], 0
    for p in patterns:
        own = 1 + len(p.replace("*", "").encode("utf-8"))
        if some and used + own > bits:
            out.append(Globs(some))
            some, used = [], 0
        some.append(p)
        used += own
    return out + [Globs(some)] if some else out


#: what canonical() may have to change
_ODD = r"[@:%]|//|^[^/]*\.(/|$)"


def canonical(host: str, path: str) -> str:
    host = host.rpartition("@")[2]
    name, colon, port = host.rpartition(":")
    host = (name if colon and (port.isascii() and port.isdigit() or not port) else host).rstrip(".")
    path = urllib.parse.unquote(path, errors="replace") if "%" in path else path
    while "//" in path:
        path = path.replace("//", "/")
    return host + path


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, suspect: tuple[str, ...] = SUSPECT, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, the longest fitting rule or null, and the verdict: the rule's, else block if a suspect pattern fits, else the default."""
    ranked = sorted(rules, key=lambda r: len(r[1]))
    patterns = [g for _, r in ranked for g in rule_globs(r)]
    names = pa.array([r for _, r in ranked], pa.string())
    verdicts = pa.array([v for v, _ in ranked], pa.string())

    def hits(globs: Globs, texts: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros((0, len(globs.final)), bool), *(globs.match(buf, offsets) for _, buf, offsets in blocks(texts))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rule, by_pattern = Globs(patterns), automata(suspect)
        for batch in batches:
            whole = pc.binary_join_element_wise(batch.column(1), batch.column(2), "")
            fits = hits(by_rule, whole)
            longest = pa.array(len(ranked) - 1 - fits[:, ::-1].argmax(1) // 2 if ranked else np.zeros(batch.num_rows, np.int64), mask=~fits.any(1))
            odd = pc.match_substring_regex(whole, _ODD)
            at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            fixed = [canonical(batch.column(1)[k].as_py(), batch.column(2)[k].as_py()) for k in at.tolist()]
            plain = pc.replace_with_mask(whole, odd, pa.array(fixed, pa.string()))
            blocked = np.zeros(batch.num_rows, bool)
            for globs in by_pattern:
                blocked |= hits(globs, plain).any(1)
            other = pc.if_else(pa.array(blocked), "block", default)
            yield pa.RecordBatch.from_arrays([*batch.columns, names.take(longest), pc.coalesce(verdicts.take(longest), other)], [*batch.schema.names, "rule", "verdict"])

    kind = pages.schema[id_col].dataType.simpleString()
    return with_host_path(pages, id_col, url_col).mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
