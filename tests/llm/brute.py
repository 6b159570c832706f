"""Plain Python versions of the operators, for small tables."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rule_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = collections.Counter(wins)
    hit = {i + j for i, x in enumerate(wins) if n[x] > 1 for j in range(8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near(rows, percent=80, k=4):
    """{id: component} by all pairs."""
    sets = collections.defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t, k))
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    index = collections.defaultdict(set)
    for i, own in sets.items():
        for s in own:
            for x in s:
                index[x].add(i)
    for i, own in sets.items():
        near_ids = set().union(*(index[x] for s in own for x in s)) if any(own) else set()
        for j in near_ids:
            if j < i and root(i) != root(j):
                if any(s and o and 100 * len(s & o) >= percent * len(s | o) for s in own for o in sets[j]):
                    a, b = sorted((root(i), root(j)))
                    up[b] = a
    return {i: root(i) for i in sets}


BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    """{doc: (n_words, n_hit, sorted items)}"""
    wins = collections.defaultdict(set)
    sizes = set()
    for i, t in items:
        w = BENCH.findall((t or "").translate(LOW))
        for x in [tuple(w[k : k + 10]) for k in range(len(w) - 9)] if len(w) >= 10 else [tuple(w)] if w else []:
            wins[x].add(i)
            sizes.add(len(x))
    out = {}
    for d, t in docs:
        w = BENCH.findall((t or "").translate(LOW))
        hit, got = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit.update(range(k, k + n))
                    got |= wins[x]
        out[d] = len(w), len(hit), sorted(map(str, got))
    return out


def log_ratios(samples, smooth, dim):
    """{bucket: log ratio} of (buckets, label) samples, and that of buckets in none."""
    import math

    n = [collections.Counter(b for x, q in samples if q == k for b in x) for k in (0, 1)]
    total = [sum(c.values()) + smooth * dim for c in n]
    ratio = lambda b: math.log((n[1][b] + smooth) / total[1]) - math.log((n[0][b] + smooth) / total[0])
    return {b: ratio(b) for b in {*n[0], *n[1]}}, ratio(-1)


def hinge_objective(rows, y, w, bias, cost):
    """Half the squared norm (bias included) plus cost times the hinge losses; rows: {feature: value}."""
    slack = sum(max(0.0, 1 - t * (sum(v * w.get(f, 0.0) for f, v in x.items()) + bias)) for x, t in zip(rows, y))
    return (sum(v * v for v in w.values()) + bias * bias) / 2 + cost * slack
