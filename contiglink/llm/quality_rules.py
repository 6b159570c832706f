"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Counts of each whole text (words are maximal stretches without ASCII white space) give four ratios, of which the
largest is the text's badness. A cutoff on badness may reject good documents, so it is certified on labelled ones: with
n good documents of a stratum of which k lie above it, it is admissible if a false-rejection rate of `risk` would show
k or fewer with a probability of at most `delta` over the number of strata (the exact binomial tail, Bonferroni over
strata). Within a stratum the cutoffs are tested in fixed sequence from loose to tight up to the first failure, which
needs no further correction; the last admissible one holds. So with a probability of 1 - delta no stratum loses more
than `risk` of the good documents that pass the base rules (those that fail them are not in the count).

Strata are classes of text length: the finest of `LEVELS` in which every class has labels enough to certify
anything. Without that nothing is rejected but by the base rules.

The cutoff counts are one row a stratum; only these reach the driver. Null texts have no words. Empty texts have
none either and fail the base rules. Labels may repeat or be null: a document counts as good if all its non-null
labels are 1, and once, by its worst row, if its id repeats. Repeated rows give repeated results; an empty table gives
an empty one, empty labels no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
RISK = 0.03
DELTA = 0.05
#: Upper ends, in words, of the strata but the last.
STRATA = (100, 300, 1000)
#: Strata by how many neighbouring classes are taken together.
LEVELS = (1, 2, 4)
#: Cutoffs in the order of their tests, loose to tight.
GRID = tuple(round(0.02 * k, 2) for k in range(100, 0, -1))
RATIOS = ("symbols", "dup_lines", "repeats", "capitals")


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words inside windows that occur twice or more: repeated windows meet when sorted; their starts are then swept.

    Windows are sorted by their hashes, and those that meet are compared by their words.
    """
    ranked = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    window = lambda i: F.slice(words, i + 1, WINDOW)

    def meet(a: Column) -> Column:
        both = lambda y, x: F.when(x["w"] == y["w"], window(x["i"]) == window(y["i"])).otherwise(False)
        pairs = F.zip_with(F.slice(a, 2, F.size(a) - 1), F.slice(a, 1, F.size(a) - 1), lambda y, x: F.when(both(y, x), F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(pairs)))

    def sweep(s: Column) -> Column:
        return F.when(F.size(s) == 0, 0).otherwise(WINDOW + _sum(F.zip_with(F.slice(s, 2, F.size(s) - 1), F.slice(s, 1, F.size(s) - 1), lambda y, x: F.least(y - x, F.lit(WINDOW)))))

    def bind(value: Column, body) -> Column:  # computes value once
        return F.transform(F.array(value), body)[0]

    return bind(ranked, lambda a: bind(meet(a), sweep))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, base_failed of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col), text.alias("text")).select(
        id_col,
        "text",
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "").alias("lines"),
    )
    windows = F.when(F.size("words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<long>"))
    df = df.select(
        id_col,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        "words",
        windows.alias("windows"),
    )
    repeats = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), 0).otherwise(_repeat_words(F.col("words"), F.col("windows")))
    df = df.withColumn("n_repeat_words", repeats.cast("long")).drop("windows", "words")
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def ratios(measured: DataFrame) -> DataFrame:
    share = lambda n, of: F.col(n) / F.greatest(F.col(of), F.lit(1))
    stratum = F.lit(len(STRATA))
    for k in reversed(range(len(STRATA))):
        stratum = F.when(F.col("n_words") < STRATA[k], k).otherwise(stratum)
    return measured.withColumns({"symbols": share("n_symbols", "n_words"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "capitals": share("n_capitals", "word_chars"), "stratum": stratum.cast("int")}).withColumn("badness", F.greatest(*RATIOS))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p)."""
    if k >= n:
        return 1.0  # also without any trial
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    total, term = 0.0, 0.0
    for i in range(k, -1, -1):
        term = math.exp(log(i))
        total += term
        if i < n * p and term < total * 1e-17:
            break
    return min(1.0, total)


def certified(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, id_col: str = "doc_id") -> dict[int, float]:
    """stratum -> tightest admissible cutoff, for the strata that have one."""
    good = labels.groupBy(id_col).agg(F.min("quality").alias("quality")).where("quality = 1").select(id_col)
    held = measured.where(~F.col("base_failed")).join(good, id_col, "left_semi")
    held = held.groupBy(id_col).agg(F.max("badness").alias("badness"), F.min("stratum").alias("stratum"))
    above = [F.count(F.when(F.col("badness") > c, 1)).alias(f"above_{k}") for k, c in enumerate(GRID)]
    rows = {r.stratum: r for r in held.groupBy("stratum").agg(F.count("*").alias("n"), *above).collect()}  # one row a stratum
    for width in LEVELS:
        parts = [range(k, k + width) for k in range(0, len(STRATA) + 1, width)]
        count = lambda part, name: sum(rows[k][name] for k in part if k in rows)
        if any(binomial_tail(0, count(p, "n"), risk) > delta / len(parts) for p in parts):
            continue
        out = {}
        for part in parts:
            for k, c in enumerate(GRID):
                if binomial_tail(count(part, f"above_{k}"), count(part, "n"), risk) > delta / len(parts):
                    break
                out |= dict.fromkeys(part, c)
        return out
    return {}


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the counts, base_failed, kept, and the stratum."""
    measured = ratios(staged(counts(docs, id_col, text_col), "quality-counts"))
    cutoffs = certified(measured, labels, risk, delta, id_col)
    rejected = F.lit(False)
    for stratum, c in sorted(cutoffs.items()):
        rejected = rejected | ((F.col("stratum") == stratum) & (F.col("badness") > c))
    return measured.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"), "stratum", "n_capitals")
