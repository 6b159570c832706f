"""Main text: pages of invented sites whose articles are known, and odd pages."""

import random

import pytest

from contiglink.llm import main_text as m


def words(r, n):
    return " ".join("".join(r.choice("aeiounrst") for _ in range(r.randrange(2, 8))) for _ in range(n))


def plain(r, k, body):
    """A site without telling names: position, constancy and links are all there is to go by."""
    return (
        "<html><body><div><div><a href=/>Home</a> <a href=/b>News of the day</a></div><div>Daily Paper, the best of all papers in town</div></div>"
        f"<div><div><h1>{body[0]}</h1>{''.join(f'<p>{b}</p>' for b in body[1:])}</div><div><a href=/{k}>{words(r, 4)}</a></div></div><div><p>All rights reserved by the paper</p></div></body></html>"
    )


def named(r, k, body):
    return (
        f"<!doctype html><html><head><title>{body[0]}</title><script>var x='<p>no</p>';</script></head><body class='has-sidebar'><header><h1>Site {k}</h1></header>"
        f"<nav><ul><li><a href=x>{words(r, 2)}</a></ul></nav><div class='cookie-notice'>{words(r, 9)}</div><main><article><header><h2>{body[0]}</h2><span class=byline>by {words(r, 2)}</span></header>"
        f"{''.join(f'<p>{b}' for b in body[1:])}<aside>{words(r, 9)}</aside><div class=ad>{words(r, 20)}</div><form><p>Your name</p></form></article>"
        f"<section id='comments'><h2>Comments</h2>{''.join(f'<div><p>{words(r, 30)}</p></div>' for _ in range(r.randrange(4)))}</section></main><footer><p>{words(r, 12)}</footer></body></html>"
    )


def site(r, make, pages, copies=0):
    """(html, text) of a site's pages; the first body is repeated so often."""
    bodies = [[words(r, r.randrange(3, 9)) for _ in range(r.randrange(2, 9))] for _ in range(pages)] + []
    bodies += [bodies[0]] * copies
    return [(make(r, k, b), "\n".join(b)) for k, b in enumerate(bodies)]


def run(spark, rows):
    """rows: (id, url, html)"""
    df = spark.createDataFrame([(*x, "x", 1) for x in rows], "page_id long, url string, html string, text string, n_chars int")
    return m.main_text(df.repartition(5))


@pytest.mark.parametrize("broadcast", [True, False])
def test_sites(spark, monkeypatch, broadcast):
    r = random.Random(3)
    monkeypatch.setattr(m, "BROADCAST_BYTES", 1 << 20 if broadcast else 0)
    monkeypatch.setattr(m, "HELD_SLOTS", 300)
    monkeypatch.setattr(m, "FAN_IN", 2)
    sites = {"a.example": site(r, plain, 30), "b.example": site(r, named, 25), "c.example": site(r, named, 2, copies=40), "d.example": site(r, named, 1)}
    rows, want = [], {}
    for host, pages in sites.items():
        for page, text in pages:
            want[len(rows)] = text
            rows.append((len(rows), f"https://{host.upper()}/{len(rows)}?q", page))
    got = run(spark, rows).collect()
    assert {g.page_id: g.text for g in got} == want and all(g.n_chars == len(g.text) and g.url == rows[g.page_id][1] for g in got)


def test_odd_pages(spark):
    cases = [
        (None, ""), ("", ""), ("   ", ""), ("just &lt;text&gt; &amp here &bogus; &#65;", "just <text> & here &bogus; A"), ("<p>a<p>b&nbsp; c<br>d", "a\nb c d"),
        ("<article><p>one<div>two</article><p>three", "one\ntwo"), ("<!-- <p>x --><p>y</p><!-- open <p>z", "y"), ("<div " * 300, "<div " * 300), ("<script>never closed <p>x", ""),
        ("<div>" * 3000 + "deep <p>text" + "</div>" * 2990, "deep\ntext"), ("</div></p></nav>stray", "stray"), ("<p class='ad'>x</p><p id=\"A>b\">y <b class=advert>z</b> w</p>", "y w"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p hidden>x</p><p style='display: none'>y</p><p>z</p>", "z"), ("<p>" + "long words " * 100_000, ("long words " * 100_000).strip()),
        ("<p>a\x00b c</p>", "a\x00b c"), ("<head><title>t</title><p>x", "x"), ("<textarea><p>no</p></textarea><p>yes", "yes"),
    ]
    rows = [(k, f"http://h{k}.example/", page) for k, (page, _) in enumerate(cases)] + [(None, None, "<p>a"), (None, "no scheme", "<p>b"), (7, "http://h7.example/", cases[7][0])]
    got = run(spark, rows).collect()
    for g in got:
        if g.page_id is not None:
            assert " ".join(g.text.split(" ")) == " ".join(cases[g.page_id][1].split()) if g.page_id == 7 else g.text == cases[g.page_id][1], (g.page_id, g.text[:200])
    assert len(got) == len(rows) and {g.text for g in got if g.page_id is None} == {"a", "b"}
    assert run(spark, []).count() == 0


def test_constant_parts_are_template(spark):
    r = random.Random(8)
    rows = [(k, "http://s.example/", f"<div><h2>Our daily news</h2><p>{words(r, 20)}</p><h3>{words(r, 3)}</h3><ul><li>Print this page</li></ul></div>") for k in range(12)]
    for g, row in zip(sorted(run(spark, rows).collect()), rows):
        assert "Our daily news" not in g.text and "Print" not in g.text and g.text.split("\n")[0] in row[2] and g.text.count("\n") == 1


def test_matching():
    tree = lambda label, *kids: m.Slot.of([label, 1, 0, 0, 0, False, [], [k.rows() for k in kids]])
    a = tree("div", tree("p"), tree("div|x", tree("b1"), tree("b2")), tree("p"), tree("ul"))
    b = tree("div", tree("ul"), tree("div|x", tree("b2")), tree("ul"))
    assert m.weight(a, b) == 4 and m.match(a.kids, b.kids) == [(1, 1), (3, 2)]
    m.unite(a, b, fold=False)
    assert [k.label for k in a.kids] == ["p", "ul", "div|x", "p", "ul"] and [k.pages for k in a.kids] == [1, 1, 2, 1, 2]
    many = [tree(f"x{k % 70}") for k in range(200)]
    assert len(m.match(many, many[1:])) >= 100
    wide = tree("div", *(tree(f"x{k}") for k in range(m.MAX_SLOTS + 10)), )
    wide.kids[3].pages = 9
    m.prune(wide)
    assert [k.label for k in wide.kids] == ["x3"]
