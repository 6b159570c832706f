"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes a tree of slots: block elements by tag, classes and id, where repeated siblings share a slot. Trees of
one host are aligned by simple tree matching (Yang, 1991) and united into the host's wrapper, first within a task,
then in rounds over the tasks' wrappers. A wrapper's slot knows on how many pages it was seen, how much text and link
text it held, and whether its text was ever different. Slots that hold one text on several different pages are
template. The content slot is the host's article element, or else where most of its varying, unlinked text is; within
it the varying slots are the main text, without elements that say by tag, role or name that they are menus, headers,
footers, side bars, notices, adverts, forms or comments. Each page is then aligned with its host's wrapper, and the
text blocks of its content slots are put out in page order.

Pages that are copies of each other count as one page when a slot's text is judged constant, so that a host of copies
keeps its articles; headings of the first level inside the content are never template. Elements nested deeper than
MAX_DEPTH belong to the slot at that depth. Block elements separate blocks, line breaks are white space, character
references are decoded as in HTML, with or without their semicolon.

A null or empty page has the text "". Null urls, and urls without `://`, share the host "". Ids may be null or
repeat; rows are judged one by one. An empty table gives an empty result. Columns besides id, url and html are not
read. No page is cut short. A wrapper of more than MAX_SLOTS slots loses those that the fewest pages have; pages that
have them judge them by their names alone.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hot import hot_lookup
from .common import Scratch

MAX_DEPTH = 40
MAX_SLOTS = 4000
#: Wrappers that a task holds at a time, in slots.
HELD_SLOTS = 200_000
#: Different pages that must agree before a slot's text is template.
AGREEING = 3
#: Children lists of a larger product are aligned label by label instead of by dynamic programming.
WIDE = 4096
#: Wrappers that one task unites in a round.
FAN_IN = 64
#: All wrappers together are broadcast up to so many bytes; beyond it only those of hot hosts are.
BROADCAST_BYTES = 16 << 20
LINKED = 0.8
MOSTLY = 0.7

# fixed values: element names of HTML
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FLOW = frozenset("p h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure hr tr td th".split())
NO_TEXT = frozenset("head nav footer aside form dialog menu search button script style noscript template svg math iframe object textarea select title audio video canvas".split())
ELEMENTS = BLOCKS | NO_TEXT | {"html", "body"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol menu dl table select".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# fixed values: words that name page parts in classes and ids
PARTS = frozenset(
    "ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promotion recommended related replies reply respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|title|audio|video|canvas"
_TAG = r"[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+>|<({_RAW})(?=[\s/>]){_TAG}>.*?</\1\s*>|<(/?)([a-zA-Z][^\s/>]*+)({_TAG}|[^>]*+)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_TELLING = re.compile(r"\b(?:class|id|role|style|hidden)\b", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Slot:
    """A place in a page or wrapper. named: holds page furniture by its name; blocks: of a page, (place, text)."""

    __slots__ = ("label", "tag", "named", "kids", "shape", "blocks", "pages", "chars", "linked", "sign", "varies", "few")

    def __init__(self, label: str):
        self.label = label
        self.tag, _, names = label.partition("|")
        self.named = self.tag in NO_TEXT or names.startswith("!") or not PARTS.isdisjoint(names.split("."))
        self.kids: list[Slot] = []
        self.blocks: list[tuple[int, str]] = []
        self.shape = self.pages = self.chars = self.linked = self.sign = 0
        self.varies, self.few = False, []

    def header(self) -> bool:
        return self.tag == "header" or "header" in self.label.partition("|")[2].split(".")

    def walk(self) -> Iterator[Slot]:
        yield self
        for kid in self.kids:
            yield from kid.walk()

    def rows(self) -> list:
        return [self.label, self.pages, self.chars, self.linked, self.sign, self.varies, self.few, [k.rows() for k in self.kids]]

    @staticmethod
    def of(rows: list) -> Slot:
        slot = Slot(rows[0])
        slot.pages, slot.chars, slot.linked, slot.sign, slot.varies, slot.few = rows[1:7]
        slot.kids = [Slot.of(r) for r in rows[7]]
        return slot


def label_of(tag: str, attributes: str) -> str:
    """Tag and names of an element; `!` marks roles of page furniture and hidden elements."""
    if not attributes or not _TELLING.search(attributes):
        return tag
    got = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(attributes)}
    mark = got.get("role", "").lower() in ROLES or "hidden" in got or got.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", got.get("style", "")) is not None
    names = sorted({x.lower() for x in _NAME.findall(f"{got.get('class', '')} {got.get('id', '')}")})[:12]
    return f"{tag}|{'!.' * mark}{'.'.join(names)}" if mark or names else tag


def match(a: list[Slot], b: list[Slot]) -> list[tuple[int, int]]:
    """Pairs of two lists of slots, in order, of greatest common tree weight."""
    la, lb = [s.label for s in a], [s.label for s in b]
    if la == lb:
        return [(k, k) for k in range(len(a))]
    head = 0
    while head < len(a) and head < len(b) and la[head] == lb[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and la[-1 - tail] == lb[-1 - tail]:
        tail += 1
    out = [(k, k) for k in range(head)]
    m, n = len(a) - head - tail, len(b) - head - tail
    if m * n > WIDE:
        places: dict[str, list[int]] = {}
        for i in range(m):
            places.setdefault(la[head + i], []).append(i)
        last = -1
        for j in range(n):
            at = next((i for i in places.get(lb[head + j], ()) if i > last), None)
            if at is not None:
                out.append((head + at, head + j))
                last = at
    elif m and n:
        best = [[0] * (n + 1) for _ in range(m + 1)]
        w = [[weight(a[head + i], b[head + j]) for j in range(n)] for i in range(m)]
        for i in range(m):
            for j in range(n):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w[i][j])
        i, j, found = m, n, []
        while i and j:
            if w[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + w[i - 1][j - 1]:
                i, j = i - 1, j - 1
                found.append((head + i, head + j))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        out += reversed(found)
    return out + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def weight(a: Slot, b: Slot) -> int:
    """Simple tree matching: the most nodes of two trees that can be paired, roots first, keeping order."""
    if a.label != b.label:
        return 0
    if a.shape and a.shape == b.shape or not a.kids or not b.kids:
        return 1 + min(len(a.kids), len(b.kids))
    return 1 + sum(weight(a.kids[i], b.kids[j]) for i, j in match(a.kids, b.kids))


def unite(a: Slot, b: Slot, fold: bool) -> None:
    """Add slot b to a of the same label. fold: as a repeated part of one page; else as the same part of other pages."""
    a.chars, a.linked, a.shape = a.chars + b.chars, a.linked + b.linked, 0
    if fold:
        a.blocks += b.blocks
    else:
        a.pages, a.varies, a.few = a.pages + b.pages, a.varies or b.varies or a.sign != b.sign, sorted({*a.few, *b.few})[:AGREEING]
    kids, i, j = [], 0, 0
    for x, y in [*match(a.kids, b.kids), (len(a.kids), len(b.kids))]:
        kids += a.kids[i:x] + b.kids[j:y]
        if x < len(a.kids) and y < len(b.kids):
            unite(a.kids[x], b.kids[y], fold)
            kids.append(a.kids[x])
        i, j = x + 1, y + 1
    a.kids = kids


def _close(parent: Slot, slot: Slot) -> None:
    """Put a finished slot under its parent: with a slot of its kind if the page repeats it, else as a new one."""
    slot.shape = hash((slot.label, *(k.shape for k in slot.kids))) or 1
    for other in reversed(parent.kids) if slot.tag in FLOW else parent.kids[-1:]:
        if other.label == slot.label and (slot.tag in FLOW or other.shape == slot.shape):
            shape = other.shape
            unite(other, slot, fold=True)
            other.shape = shape if shape == slot.shape else hash((other.label, *(k.shape for k in other.kids))) or 1
            return
    parent.kids.append(slot)


def parse(page: str) -> Slot:
    """The tree of slots of a page, with its text blocks."""
    root = Slot("html")
    stack, inside = [root], ["html"]  # elements below MAX_DEPTH are open but have no slot of their own
    silent = link = 0  # depth of the outermost element without text; of the block that holds an open link
    buffer: list[str] = []
    order, links = 0, 0

    def flush() -> None:
        nonlocal order, links
        if buffer and (text := " ".join("".join(buffer).split())):
            k = min(len(stack), MAX_DEPTH) - 1
            while k and inside[k] not in ELEMENTS:  # named inline elements have no text
                k -= 1
            top = stack[k]
            top.blocks.append((order, text))
            top.chars, top.linked = top.chars + len(text), top.linked + min(links, len(text))
            order += 1
        buffer.clear()
        links = 0

    def pop() -> None:
        nonlocal silent, link
        inside.pop()
        slot = stack.pop()
        if len(stack) < MAX_DEPTH:
            _close(stack[-1], slot)
        silent = 0 if len(inside) < silent else silent
        link = 0 if len(inside) < link else link

    def close(names, stop=frozenset()) -> None:
        """Close the innermost open element of these names, unless one of stop stands before it."""
        for k in range(len(inside) - 1, 0, -1):
            if inside[k] in names:
                if not ELEMENTS.isdisjoint(inside[k:]):
                    flush()
                while len(inside) > k:
                    pop()
                return
            if inside[k] in stop:
                return

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not silent:
            piece = page[at : m.start()]
            piece = html.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            links += len(piece) if link else 0
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if silent and tag in FLOW and inside[-1] != "head":
            continue
        if tag == "a":
            link = 0 if m[2] else len(inside)
        if tag == "br":
            buffer.append(" ")
        label = "" if m[2] or tag in VOID else label_of(tag, m[4])
        block = tag in ELEMENTS
        if m[2]:
            if block or tag in inside:
                close({tag}, frozenset() if tag in ("table", "body", "html") else {"table", "td", "th"} - {tag})
            continue
        if tag == "hr" or tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body"):
            close({"head"})
            if tag in inside or tag == "html":
                continue
        if not block and not (label != tag and Slot(label).named):
            continue
        if block:
            flush()
            if "head" in inside and tag not in NO_TEXT:
                close({"head"})
            if tag in BLOCKS:
                close({"p"}, HOLDERS | {"td", "th"})
            if tag in CLOSED_BY:
                for _ in range(2 if tag == "tr" else 1):
                    close(CLOSED_BY[tag], HOLDERS)
        stack.append(Slot(label) if len(stack) < MAX_DEPTH else stack[-1])
        inside.append(tag)
        if (tag in NO_TEXT or not block) and not silent:
            silent = len(inside)
    if at < len(page) and not silent:
        buffer.append(html.unescape(page[at:]))
    flush()
    while len(inside) > 1:
        pop()
    return root


def page_tree(page: str) -> Slot:
    """A page's tree with what a wrapper needs of one page: a sign for the text of each slot, and one for the page."""
    root = parse(page)
    told: list[str] = []

    def sign(slot: Slot, named: bool) -> None:
        named = named or slot.named
        slot.pages = 1
        if slot.blocks:
            text = "\n".join(t for _, t in slot.blocks)
            slot.sign = xxhash.xxh64_intdigest(text) >> 1
            if not named:
                told.append(text)
        for kid in slot.kids:
            sign(kid, named)

    sign(root, False)
    own = xxhash.xxh64_intdigest("\n".join(told)) >> 1
    for slot in root.walk():
        slot.few = [own]
    return root


def prune(wrapper: Slot) -> None:
    """Without the rarest slots, where there are more than MAX_SLOTS."""
    total = sum(1 for _ in wrapper.walk())
    least = 1
    while total > MAX_SLOTS:
        for slot in list(wrapper.walk()):
            slot.kids = [k for k in slot.kids if k.pages > least]
        total, least = sum(1 for _ in wrapper.walk()), least * 2


def content_slots(wrapper: Slot) -> set[int]:
    """Numbers, in the order of walk(), of the slots that hold a host's main text."""
    number = {id(s): k for k, s in enumerate(wrapper.walk())}
    mass: dict[int, int] = {}
    holds: dict[int, bool] = {}  # an article, or a first heading

    def template(s: Slot) -> bool:
        return not s.varies and len(s.few) >= AGREEING and s.tag != "h1"

    def weigh(s: Slot, within: bool) -> tuple[int, bool]:
        within = within or s.tag in NO_TEXT
        own = 0 if within or template(s) or s.linked > LINKED * s.chars else s.chars - s.linked
        parts = [weigh(k, within) for k in s.kids]
        mass[id(s)] = own + sum(p[0] for p in parts)
        holds[id(s)] = any(p[1] for p in parts)
        return mass[id(s)], holds[id(s)] or s.tag in ("article", "main", "h1")

    total, _ = weigh(wrapper, False)

    def furniture(s: Slot) -> bool:
        if s.tag in NO_TEXT or "|!" in s.label:
            return True
        return s.named and s.tag not in ("html", "body", "main") and not holds[id(s)] and mass[id(s)] <= 0.9 * total

    def articles(s: Slot) -> list[Slot]:
        if furniture(s) or s.header():
            return []
        if s.tag in ("article", "main") and mass[id(s)]:
            inner = [x for k in s.kids for x in articles(k)] if s.tag == "main" else []
            return inner or [s]
        return [x for k in s.kids for x in articles(k)]

    roots = articles(wrapper)
    if not roots:
        top = wrapper
        while True:
            kids = [k for k in top.kids if not furniture(k) and (k.tag not in FLOW or k.tag in ("tr", "td")) and k.tag != "h1"]
            most = max(kids, key=lambda k: mass[id(k)], default=None)
            if most is None or mass[id(most)] < MOSTLY * max(1, mass[id(top)]):
                break
            top = most
        roots = [top]
    out: set[int] = set()

    def take(s: Slot, heading: bool) -> None:
        heading = heading or s.header() and s not in roots
        if furniture(s):
            return
        if not template(s) and not (s.chars and s.linked > LINKED * s.chars) and (not heading or re.fullmatch("h[1-6]", s.tag)):
            out.add(number[id(s)])
        for k in s.kids:
            take(k, heading)

    for root in roots:
        take(root, False)
    return out


def aligned(wrapper: Slot, page: Slot) -> list[int]:
    """For each slot of a page, in the order of walk(), the number of the wrapper's slot, or -1."""
    number = {id(s): k for k, s in enumerate(wrapper.walk())}
    to: dict[int, int] = {id(page): 0}

    def pair(a: Slot, b: Slot) -> None:
        for i, j in match(a.kids, b.kids):
            to[id(b.kids[j])] = number[id(a.kids[i])]
            pair(a.kids[i], b.kids[j])

    pair(wrapper, page)
    return [to.get(id(s), -1) for s in page.walk()]


class Wrapper:
    """A host's wrapper at work: which slots are content, and how pages of a shape align."""

    def __init__(self, data: bytes):
        self.root = Slot.of(json.loads(data))
        self.content, self.known = content_slots(self.root), {}

    def text(self, page: str) -> str:
        tree = parse(page)
        shape = hash((tree.label, *(k.shape for k in tree.kids)))
        slots = list(tree.walk())
        if (places := self.known.get(shape)) is None or len(places) != len(slots):
            places = aligned(self.root, tree)
            if len(self.known) < 1000:
                self.known[shape] = places
        blocks = [x for s, k in zip(slots, places) if k in self.content or k < 0 and self._unknown(tree, slots, places, s) for x in s.blocks]
        return "\n".join(text for _, text in sorted(blocks))

    def _unknown(self, tree: Slot, slots: list[Slot], places: list[int], slot: Slot) -> bool:
        """Whether a slot that the wrapper lost is content: its nearest known ancestor is, and no name speaks against it."""
        number = {id(s): k for s, k in zip(slots, places)}

        def find(s: Slot, held: bool) -> bool | None:
            k = number[id(s)]
            held = k in self.content if k >= 0 else held and not s.named
            if s is slot:
                return held
            return next((x for kid in s.kids if (x := find(kid, held)) is not None), None)

        return bool(find(tree, False))


def host_of(url) -> F.Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_WRAPPERS = "host string, part long, pages long, wrapper binary"


def _batch(found: dict[str, Slot], parts: Iterator[int]) -> pa.RecordBatch:
    for slot in found.values():
        prune(slot)
    data = [json.dumps(s.rows(), separators=(",", ":")).encode() for s in found.values()]
    cols = [pa.array(list(found), pa.string()), pa.array([next(parts) for _ in found], pa.int64()), pa.array([s.pages for s in found.values()], pa.int64()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, ["host", "part", "pages", "wrapper"])


def induce(pages: DataFrame, scratch: Scratch, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, pages and wrapper of every host: united in each task, then in rounds of at most about FAN_IN wrappers."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Slot] = {}
        held, parts = 0, count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                tree = page_tree(page.as_py() or "")
                for slot in tree.walk():
                    slot.blocks, slot.shape = [], 0
                    held += 1
                if host in found:
                    before = sum(1 for _ in found[host].walk()) + sum(1 for _ in tree.walk())
                    unite(found[host], tree, fold=False)
                    held -= before - sum(1 for _ in found[host].walk())
                else:
                    found[host] = tree
                if held > HELD_SLOTS:
                    yield _batch(found, parts)
                    found, held = {}, 0
        if found:
            yield _batch(found, parts)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, last, slot = count(TaskContext.get().partitionId() << 32), None, None
        for batch in batches:
            for host, group, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tree = Slot.of(json.loads(data.as_py()))
                if (host, group) == last:
                    unite(slot, tree, fold=False)
                    continue
                if last:
                    yield _batch({last[0]: slot}, parts)
                last, slot = (host, group), tree
        if last:
            yield _batch({last[0]: slot}, parts)

    named = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    found = scratch.staged(named.mapInArrow(learn, _WRAPPERS), "wrappers")
    while (most := found.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        group = F.pmod(F.xxhash64("part"), F.lit(-(-most // FAN_IN))).cast("int")
        dealt = found.withColumn("group", group).repartition("host", "group").sortWithinPartitions("host", "group", "part")
        found = scratch.staged(dealt.select("host", "group", "wrapper").mapInArrow(reduce, _WRAPPERS), "wrappers")
        scratch.clear(keep_last=1)
    return found.select("host", "pages", "wrapper")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page."""
    kind = pages.schema[id_col].dataType.simpleString()
    scratch = Scratch()  # the last wrappers stay: the result reads them
    wrappers = induce(pages, scratch, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for host, page, data in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                if host not in known:
                    known = known if len(known) < 500 else {}
                    known[host] = Wrapper(data.as_py())
                texts.append(known[host].text(page.as_py() or ""))
            cols = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias(url_col), host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias(html_col))
    size = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    both = rows.join(F.broadcast(wrappers.drop("pages")), "host") if size <= BROADCAST_BYTES else hot_lookup(rows, wrappers, ["host"], "pages", least=0)
    return both.select(id_col, url_col, "host", html_col, "wrapper").mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")
