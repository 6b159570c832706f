"""DuckDB SQL for the operators that SQL can express, written independently of them."""

from __future__ import annotations

import functools
import re

from . import quality_rules as q
from . import sharding
from . import url_filter as u

_SPACE = r"[\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACE}'), lambda x: x <> '')"


def _tail(k: str, n: str, p: float) -> str:
    return f"""case when {k} >= {n} then 1.0::double else list_sum(list_transform(range(0, {k} + 1), lambda i:
        exp(lgamma({n} + 1) - lgamma(i + 1) - lgamma({n} - i + 1) + i * ln({p}::double) + ({n} - i) * ln(1 - {p}::double)))) end"""


def quality_rules() -> str:
    grid = ", ".join(f"({k}, {c}::double)" for k, c in enumerate(q.GRID))
    stratum = " ".join(f"when n_words < {top} then {k}" for k, top in enumerate(q.STRATA))
    n = len(q.STRATA) + 1
    return f"""with d as (select row_number() over () rid, doc_id, coalesce(text, '') t from documents),
    w as (select rid, doc_id, t, {_words('t')} ws, list_filter(string_split(t, chr(10)), lambda x: trim(x, concat(' ', chr(9), chr(11), chr(12), chr(13))) <> '') ls from d),
    win as (select rid, i, array_to_string(ws[i:i + {q.WINDOW - 1}], ' ') x from w, unnest(range(1, len(ws) - {q.WINDOW - 2})) r(i)),
    twice as (select rid, i from (select rid, i, count(*) over (partition by rid, x) c from win) where c > 1),
    rep as (select rid, count(distinct i + j) k from twice, range(0, {q.WINDOW}) s(j) group by rid),
    m as (select doc_id, len(ws) n_words, length(array_to_string(ws, '')) word_chars, length(regexp_replace(t, '[^{q.SYMBOLS}]+', '', 'g')) n_symbols,
        len(ls) - len(list_distinct(ls)) n_dup_lines, coalesce(k, 0) n_repeat_words, length(regexp_replace(t, '[^A-Z]+', '', 'g')) n_capitals, len(ls) n_lines from w left join rep using (rid)),
    b as (select *, n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words base_failed, case {stratum} else {n - 1} end stratum,
        greatest(n_symbols / greatest(n_words, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1), n_capitals / greatest(word_chars, 1)) badness from m),
    good as (select doc_id from labels group by doc_id having min(quality) = 1),
    held as (select doc_id, max(badness) badness, min(stratum) stratum from b where not base_failed and doc_id in (select doc_id from good) group by doc_id),
    grid(k, c) as (values {grid}),
    part as (select width, p, {n} / width parts from (values {', '.join(f'({x})' for x in q.LEVELS)}) l(width), range(0, {n}) r(p) where p < {n} / width),
    tried as (select width, p, parts, k, c, (select count(*) from held where stratum // width = p) n, (select count(*) from held where stratum // width = p and badness > c) above from part, grid),
    tested as (select *, {_tail('above', 'n', q.RISK)} <= {q.DELTA}::double / parts ok, {_tail('0', 'n', q.RISK)} <= {q.DELTA}::double / parts able from tried),
    level as (select min(width) width from (select width, bool_and(able) able from tested group by width) where able),
    run as (select *, bool_and(ok) over (partition by width, p order by k) held_up from tested where width = (select width from level)),
    cut as (select width, p, min(c) c from run where held_up group by width, p)
    select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols, cast(n_dup_lines as bigint) n_dup_lines,
        cast(n_repeat_words as bigint) n_repeat_words, base_failed, not base_failed and not coalesce(badness > c, false) kept, stratum, cast(n_capitals as bigint) n_capitals
    from b left join cut on stratum // width = p"""


def _regex(glob: str) -> str:
    return "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob))


def url_verdicts() -> str:
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in u.RULES)
    suspect = "|".join(_regex(p) for p in u.SUSPECT).replace("'", "''")
    return f"""with p as (select row_number() over () rid, page_id, translate(regexp_extract(coalesce(url, ''), '{parts}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
        regexp_extract(coalesce(url, ''), '{parts}', 2) path from pages),
    rules(v, r, h, s) as (values {rules}),
    fit as (select rid, max_by(r, length(r)) r, max_by(v, length(r)) v from p, rules where (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by rid),
    plain as (select *, rtrim(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*$', ''), '.') || regexp_replace(case when contains(path, '%') then url_decode(path) else path end, '/+', '/', 'g') canonical from p)
    select page_id, host, path, r rule, coalesce(v, case when regexp_full_match(canonical, '(?s){suspect}') then 'block' else 'allow' end) verdict from plain left join fit using (rid)"""


def decontamination() -> str:
    found = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""with d as (select row_number() over () rid, doc_id, {found} ws from documents),
    b as (select item_id, {found} ws, least(10, len(ws)) n from benchmark),
    phrase as (select distinct item_id, n, array_to_string(ws[i:i + n - 1], ' ') x from b, unnest(range(1, len(ws) - n + 2)) r(i) where n > 0),
    size as (select distinct n from phrase),
    win as (select rid, i, n, array_to_string(ws[i:i + n - 1], ' ') x from d, size, unnest(range(1, len(ws) - n + 2)) r(i)),
    met as (select rid, i, n, item_id from win join phrase using (n, x)),
    hit as (select rid, count(distinct i + j) n_hit from met, unnest(range(0, n)) r(j) group by rid),
    item as (select rid, count(*) n_items, string_agg(name, ',' order by name) names from (select distinct rid, cast(item_id as varchar) name from met where item_id is not null) group by rid)
    select doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
    from d left join hit using (rid) left join item using (rid)"""


def near_duplicates() -> str:
    return f"""with recursive d as (select row_number() over () rid, doc_id, {_words(_LOWER)} ws from documents),
    s as (select distinct rid, x from (select rid, unnest(case when len(ws) >= 4 then list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) x from d)),
    n as (select d.rid, doc_id, count(x) n from d left join s using (rid) group by all),
    inter as (select a.rid r1, b.rid r2, count(*) k from s a join s b on a.x = b.x and a.rid < b.rid group by all),
    link as (select a.doc_id u, b.doc_id v from inter join n a on a.rid = r1 join n b on b.rid = r2 where 100 * k >= 80 * (a.n + b.n - k)),
    edges as (select u, v from link union select v, u from link),
    cc(id, root) using key (id) as (select doc_id, doc_id from n where doc_id is not null group by doc_id
        union select e.u, min(c.root) from cc c join edges e on e.v = c.id join recurring.cc r on r.id = e.u where c.root < r.root group by e.u)
    select doc_id, n n_shingles, root component_id, coalesce(doc_id = root, true) kept from n left join cc on id = doc_id"""


def archives() -> str:
    bits = "array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), '')"
    group = "list_sum(list_transform(range(1, 6), lambda j: case when substr(bits, 5 * g + j, 1) = '1' then 1 << (5 - j) else 0 end))"
    base32 = f"array_to_string(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + {group} as bigint), 1)), '')"
    return f"""with p as (select page_id, coalesce(html, '') body, sha1(coalesce(html, '')) h from pages),
    b as (select *, {bits} bits, max(page_id) over (partition by h) top from p)
    select page_id, cast(strlen(body) as bigint) payload_bytes, {base32} payload_digest, case when page_id = top then 'response' else 'revisit' end record_type, case when page_id <> top then top end refers_to from b"""


def _crc32(text: str) -> str:
    table = [functools.reduce(lambda c, _: c >> 1 ^ 0xEDB88320 * (c & 1), range(8), k) for k in range(256)]
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    return f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, ({table})[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295)"


def periodic_runs() -> str:
    """Pairs of equal windows of six words, stretched over consecutive words of one distance; smaller periods rule larger ones out."""
    return f"""with d as (select row_number() over () rid, doc_id, {_words("coalesce(text, '')")} ws, coalesce({_crc32("cast(doc_id as varchar)")}, 1) h from documents),
    g as (select *, len(ws) n, h // 10 g from d),
    a as (select *, case when n > 0 then g % n end a from g),
    p as (select *, 1 + (n - a) // (3 + g % 8) p from a),
    w as (select rid, doc_id, case when h % 10 = 0 and n > 0 then list_transform(range(0, n), lambda i: ws[1 + case when i >= a then a + (i - a) % p else i end]) else ws end ws from p),
    win as (select rid, i, array_to_string(ws[i + 1:i + 6], ' ') x from w, unnest(range(0, len(ws) - 5)) r(i)),
    pair as (select x.rid, x.i, y.i - x.i q from win x join win y on x.rid = y.rid and x.x = y.x and x.i < y.i),
    alike as (select rid, q, min(i) s, max(i) - min(i) + 6 + q k from (select *, i - row_number() over (partition by rid, q order by i) island from pair) group by rid, q, island),
    stretch as (select * from alike where k >= 2 * q and k >= 12),
    run as (select * from stretch x where not exists (select 1 from stretch y where y.rid = x.rid and y.q < x.q and y.s <= x.s and y.s + y.k >= x.s + x.k)),
    told as (select rid, count(*) n_runs, string_agg(concat(s, ',', k, ',', q, chr(10)), '' order by s, q) list, arg_min((s, k, q), (-k, s, q)) best from run group by rid),
    gone as (select distinct rid, i from run, unnest(range(s + q, s + k)) r(i)),
    kept as (select w.rid, string_agg(ws[r.i + 1], ' ' order by r.i) t from w cross join unnest(range(0, len(ws))) r(i) left join gone on gone.rid = w.rid and gone.i = r.i where gone.i is null group by w.rid)
    select doc_id, coalesce(n_runs, 0) n_runs, best[1] "start", best[2] length, best[3] period, 1000 * best[2] // best[3] exponent_milli,
        sha256(coalesce(list, '')) runs_sha256, sha256(coalesce(t, '')) collapsed_sha256 from w left join told using (rid) left join kept using (rid)"""


def main_texts() -> str:
    """The tables' pages have one article each, of a heading and paragraphs."""
    bare = "regexp_replace(x, '<[^>]*>', '', 'g')"
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        bare = f"regexp_replace({bare}, '&{name};?', '{char}', 'g')"
    blocks = f"list_filter(list_transform(regexp_split_to_array(body, '</?(p|h1)>'), lambda x: trim(regexp_replace({bare}, '\\s+', ' ', 'g'))), lambda x: x <> '')"
    return f"""with p as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) body from pages), t as (select page_id, url, array_to_string({blocks}, chr(10)) "text" from p)
    select page_id, url, "text", cast(length("text") as bigint) n_chars from t"""


def jump_shards(shards: int) -> str:
    """Scrambled keys follow their jumps until they leave one shard more; slots count blocks of a shard in turn."""
    crc = _crc32("coalesce(text, '')")
    times = lambda x, by: f"(({x})::uhugeint * {by}::uhugeint % 18446744073709551616::uhugeint)::ubigint"
    shift = lambda x, k: f"xor({x}, {x} >> {k})"
    return f"""with recursive d as (select row_number() over () rid, doc_id, strlen(coalesce(text, '')) + 8 size, {crc} text_crc32,
        coalesce(doc_id, -1)::hugeint id from documents),
    k0 as (select rid, (case when id < 0 then id + 18446744073709551616::hugeint else id end)::ubigint k from d),
    k1 as (select rid, {times(shift('k', 30), 0xBF58476D1CE4E5B9)} k from k0),
    k2 as (select rid, {times(shift('k', 27), 0x94D049BB133111EB)} k from k1),
    jump as (select rid, {shift('k', 31)} k, 0::bigint b from k2
        union all select rid, k, floor((b + 1) * (2147483648::double / ((k >> 33)::double + 1)))::bigint b
        from (select rid, b, ((k::uhugeint * 2862933555777941757::uhugeint + 1::uhugeint) % 18446744073709551616::uhugeint)::ubigint k from jump) where (b + 1) * (2147483648::double / ((k >> 33)::double + 1)) < {shards + 1}),
    s as (select rid, max(b) filter (b < {shards}) shard, max(b) grown_shard from jump group by rid),
    n as (select (count(*) + {shards * sharding.BLOCK_ROWS - 1}) // {shards * sharding.BLOCK_ROWS} blocks from d),
    dealt as (select *, ((id % blocks + blocks) % blocks + text_crc32 % blocks) % blocks block from d join s using (rid), n)
    select doc_id, cast(size as bigint) size, cast(text_crc32 as bigint) text_crc32, 'key' law, cast(shard as integer) shard,
        row_number() over (partition by shard order by block, doc_id nulls first, text_crc32, size) - 1 slot, cast(grown_shard as integer) grown_shard from dealt"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_jump_shards": jump_shards(24), "op5_quality_rules": quality_rules(), "op6_url_automaton": url_verdicts(), "op7_fm_index": decontamination(), "op8_minhash": near_duplicates(), "op10_warc_bundles": archives(),
        "op12_periodic_runs": periodic_runs(), "op13_wrapper_induction": main_texts(),
    }
