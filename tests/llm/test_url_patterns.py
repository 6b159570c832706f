"""Patterns from a table, in several automata, against regular expressions."""

import random
import re

import pytest

from contiglink.llm import url_filter


def regex(glob):
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob)), re.S)


def test_thousands_of_patterns(spark, monkeypatch):
    r = random.Random(6)
    name = lambda n: "".join(r.choice("abcde") for _ in range(n))
    patterns = sorted({r.choice(["**{}**", "*.{}/**", "{}.?/*", "**/{}/**"]).format(name(r.randrange(3, 7))) for _ in range(3000)} | {"x" * 300})
    table = spark.createDataFrame([(p, 1) for p in patterns * 2] + [(None, 1)], "pattern string, page_id int").repartition(5)
    got = url_filter.patterns_of(table)
    assert list(got) == patterns and len(url_filter.automata(got, 500)) > 20
    with pytest.raises(ValueError):
        url_filter.patterns_of(table, most_bytes=100)
    monkeypatch.setattr(url_filter.automata, "__defaults__", (500,))
    urls = [f"http://{r.choice(['', 'u@'])}{name(6)}.{name(2)}{r.choice(['', ':80', '.'])}/{name(9)}{r.choice(['', '//', '/%61%62c/'])}{name(3)}" for _ in range(300)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    plain = [regex(p) for p in patterns]
    for x in url_filter.judge_urls(pages, rules=(), suspect=got).collect():
        want = any(p.fullmatch(url_filter.canonical(x.host, x.path)) for p in plain)
        assert x.verdict == ("block" if want else "allow") and x.rule is None
