"""Input relations derived from the test tables: an order is a contig, a line item a gene, part and supplier class a cluster.

The SQL is common to Spark and DuckDB; {name} stands for a test table.
"""

from __future__ import annotations

FIXTURES = {
    "fx_orf": """
select concat('ctg_', cast(l_orderkey as string)) contig,
  cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    l_quantity, l_shipdate, l_discount, l_tax) as bigint) orf_n,
  concat(cast(l_partkey as string), ':', cast(l_suppkey % 10 as string)) cluster_key,
  cast(l_quantity as bigint) * 30 len, 20 + (l_partkey * 7919) % 2500 gap,
  case when l_returnflag = 'R' then -1 else 1 end strand, l_orderkey, l_partkey, l_suppkey, l_quantity
from {lineitem}""",
    "fx_clusters": """
select min(concat(contig, '_', cast(orf_n as string))) over (partition by cluster_key) cluster_rep,
  concat(contig, '_', cast(orf_n as string)) cluster_member
from fx_orf""",
    "fx_coords": """
select concat(contig, '_', cast(orf_n as string)) orf, contig, cum_end - len + 1 start_bp, cum_end end_bp, strand,
  concat('ID=', cast(orf_n as string), ';partial=00') metadata
from (select *, cast(sum(len + gap) over (partition by contig order by orf_n
  rows between unbounded preceding and current row) as bigint) cum_end from fx_orf) t""",
    "fx_fai": """
select contig, cast(max(end_bp) + min(cast(substr(contig, 5) as bigint)) % 5000 as bigint) length from fx_coords group by contig""",
    "fx_contig_taxonomy": """
select concat('ctg_', cast(o_orderkey as string)) contig,
  cast(case when o_orderkey % 17 = 0 then 0 else 1000 + o_custkey end as bigint) taxid, 'species' level,
  concat('T', cast(o_custkey as string)) taxa, cast(o_orderkey % 5 as bigint) fragments, cast(o_orderkey % 5 as bigint) returned,
  cast(o_orderkey % 4 as bigint) agreed, cast(o_orderkey % 4 as double) / 4 percent_agreed,
  case when o_orderkey % 17 = 0 then null else concat('d_', r_name, ';p_', n_name, ';c_', n_name, '-', c_mktsegment,
    ';o_', n_name, '-', c_mktsegment, '-', cast(c_custkey % 2 as string),
    case when o_orderkey % 11 = 0 then '' else concat(';f_F', cast(c_custkey % 3 as string), '-', n_name, '-', c_mktsegment,
      '-', cast(c_custkey % 2 as string), ';g_G', cast(c_custkey % 5 as string), ';s_S', cast(c_custkey as string)) end) end lineage
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
  join {region} on n_regionkey = r_regionkey""",
    "fx_lineages": """
select c_custkey number, concat('d_', r_name, ';p_', n_name, ';c_', n_name, '-', c_mktsegment, ';o_', n_name, '-', c_mktsegment, '-', cast(c_custkey % 2 as string)) upper,
  concat(';f_F', cast(c_custkey % 3 as string), '-', n_name, '-', c_mktsegment, '-', cast(c_custkey % 2 as string), ';g_G', cast(c_custkey % 5 as string), ';s_S', cast(c_custkey as string)) lower
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    # a gene has its contig's lineage or one that its cluster brought along; some stop at the order, some have none
    "fx_gene_taxonomy": """
select concat(g.contig, '_', cast(orf_n as string)) orf, g.contig, cast(l_quantity as double) weight, number,
  case when (l_partkey + orf_n) % 13 = 0 then null when (l_partkey + l_suppkey) % 7 = 0 then upper else concat(upper, lower) end lineage
from (select f.*, case when (l_partkey * 31 + l_suppkey) % 10 < 6 then o_custkey else lo + (l_partkey * 7919) % n end bearer
  from fx_orf f join {orders} on l_orderkey = o_orderkey cross join (select min(c_custkey) lo, count(*) n from {customer}) m) g
  join fx_lineages on bearer = number""",
    "fx_hits": """
select concat('ctg_', cast(l_orderkey as string), '_', cast(l_linenumber as string)) qtitle, p_name stitle,
  cast(round(100 * (1 - l_discount), 2) as double) pident, cast(l_extendedprice as double) bitscore,
  cast(l_tax as double) evalue, cast(2 * l_quantity as double) qcov, cast(2 * p_size as double) scov
from {lineitem} join {part} on l_partkey = p_partkey""",
    "fx_headers": """
select concat('>', orf, ' # ', cast(start_bp as string), ' # ', cast(end_bp as string), ' # ', cast(strand as string), ' # ', metadata) value from fx_coords""",
    "fx_fasta": """
select concat('ctg_', cast(doc_id as string)) name, text sequence from {documents} where text is not null""",
    "fx_sequences": """
select contig name, substr(repeat(md5(contig), cast(floor(length / 32) as int) + 1), 1, cast(length as int)) sequence from fx_fai""",
    "fx_genome": """
select concat('ctg_', cast(doc_id as string)) name, translate(hex(text), '0123456789ABCDEF', 'ACGTCATGGTACTGCA') sequence
from {documents} where text <> ''""",
    "fx_gene_sequences": """
select concat(contig, '_', cast(orf_n as string)) name, substr(concat(md5(concat(cluster_key, 'a')), md5(concat(cluster_key, 'b')), md5(concat(cluster_key, 'c')),
  md5(concat(cluster_key, 'd')), md5(concat(cluster_key, 'e'))), 1, 120 + cast(l_partkey % 40 as int)) sequence from fx_orf""",
    "fx_subjects": """
select distinct cluster_key name, concat(md5(concat(cluster_key, 'a')), md5(concat(cluster_key, 'b')), md5(concat(cluster_key, 'c')),
  md5(concat(cluster_key, 'd')), md5(concat(cluster_key, 'e'))) sequence from fx_orf""",
    # ten intervals a document, end to end over its whole text
    "fx_cuts_whole": """
select contig, start, stop, title region_title
from (select concat('ctg_', cast(doc_id as string)) contig, concat('cut_', cast(doc_id as string), '_', cast(k as string)) title,
    cast((n * k - (n * k) % 10) / 10 as bigint) start, cast((n * (k + 1) - (n * (k + 1)) % 10) / 10 as bigint) stop
  from (select doc_id, cast(length(text) as bigint) n from {documents} where text is not null) d
    cross join (values (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) as tenth(k)) t
where stop > start""",
}


def with_fixtures(place, made: dict[str, str] | None = None) -> str:
    """All fixtures as the entries of a WITH clause. place: name of a test table -> how the engine names it; made: fixtures that are tables already."""
    names = {n: place(n) for n in ("lineitem", "orders", "customer", "nation", "region", "part", "documents")}
    made = made or {}
    return ",\n".join(f"{n} as (select * from {made[n]})" if n in made else f"{n} as ({q.format(**names)})" for n, q in FIXTURES.items())
