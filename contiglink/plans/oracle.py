"""The same relations as DuckDB SQL, written independently of the DataFrame operators."""

from __future__ import annotations

from ..config import LEVELS, RANKS
from ..operators.alignment import Scoring
from ..operators.orfs import COMPLEMENT, STARTS, STOPS
from ..operators.reports import DIVERSITY
from ..operators.taxonomy import RANK_NAMES
from .fixtures import with_fixtures

TAXON = ("taxid", "level", "taxa", "fragments", "returned", "agreed", "percent_agreed", *RANKS)


def _level(k: int, a: str, b: str) -> str:
    x, y = f"{RANKS[k]}_{a}", f"{RANKS[k]}_{b}"
    above = f" and {RANKS[k - 1]}_{a} = {RANKS[k - 1]}_{b}" if k else ""
    return f"{x} is not null and {y} is not null and {x} <> 'None' and {y} <> 'None' and {x} <> {y}{above}"


def _by_level(relation: str, a: str, b: str, names: str) -> str:
    ranks = ", ".join(f"{r}_{s}" for s in (a, b) for r in RANKS)
    return " union all ".join(f"select {names}, {ranks}, '{x}' hgt_level from {relation} where {_level(k, a, b)}" for k, x in enumerate(LEVELS))


def _any_level(relation: str, a: str, b: str) -> str:
    return f"select distinct * from {relation} where " + " or ".join(f"({_level(k, a, b)})" for k in range(len(RANKS)))


def _counts(relation: str, a: str, b: str) -> str:
    return " union all ".join(f"select '{x}' hgt_level, count(*) instances from {relation} where {_level(k, a, b)}" for k, x in enumerate(LEVELS))


def _hits(identity: int, query: int, subject: int) -> str:
    return f"""select qtitle, stitle, pident, bitscore, evalue from (select *, row_number() over (partition by qtitle
    order by bitscore desc, evalue, stitle, pident desc) k from fx_hits where pident >= {identity} and qcov >= {query} and scov >= {subject}) where k = 1"""


def _vote(relation: str, name: str) -> dict[str, str]:
    """Common table expressions of the vote over a relation of (name, lineage, weight); the last is its result."""
    level = " ".join(f"when {k + 1} then '{x}'" for k, x in enumerate(RANK_NAMES))
    return {
        f"{name}_paths": f"select name, k, array_to_string(parts[1:k], ';') path, sum(weight) w, count(*) n from (select name, weight, string_split(lineage, ';') parts from {relation} where lineage <> ''), unnest(range(1, len(parts) + 1)) r(k) group by all",
        f"{name}_totals": f"select name, count(*) fragments, count(*) filter (lineage <> '') returned, sum(weight) filter (lineage <> '') total from {relation} group by name",
        f"{name}_labels": f"select name, k, path, w, n from {name}_paths join {name}_totals using (name) where w > 0.5 * total qualify row_number() over (partition by name order by k desc) = 1",
        name: f"""select name, case when returned = 0 then 0 when path is null then 1 else taxid end taxid, case when path is null then 'no rank' else case k {level} end end "level",
            case when returned = 0 then 'unclassified' when path is null then 'root' else regexp_replace(regexp_extract(path, '([^;]*)$', 1), '^[a-z]_', '') end taxa, fragments, returned,
            case when returned = 0 then 0 else coalesce(n, returned) end agreed, case when returned = 0 then 0 else coalesce(w / total, 1.0::double) end percent_agreed, path lineage
            from {name}_totals left join {name}_labels using (name) left join taxa using (path)""",
    }


def _orfs() -> str:
    """Codon by codon: stops so far number the reading frames of each of the six frames."""
    quoted = lambda codons: ", ".join(f"'{c}'" for c in codons)
    turned = lambda codons: quoted("".join(COMPLEMENT[x] for x in reversed(c)) for c in codons)
    over = "over (partition by name, f, strand order by i rows between unbounded preceding and {})"
    return f"""select concat(name, '_', k) orf, low + 1 "start", high "end", strand, concat('ID=', k, ';partial=', partial) metadata from (
        select *, row_number() over (partition by name order by low, high, strand) k from (
            select name, strand, case when g = 0 then f when strand = 1 then first else opens end low, case when strand = 1 then coalesce(closes + 3, edge) when g = total then edge else last + 3 end high,
                concat(cast(g = 0 as int), cast(g = total as int)) partial from (
                select name, f, strand, g, any_value(edge) edge, any_value(total) total, min(i) filter (s) first, max(i) filter (s) last, min(i) filter (e and strand = 1) closes, min(i) filter (e and strand = -1) opens from (
                    select *, count(*) filter (e) {over.format('current row')} - case when e and strand = 1 then 1 else 0 end g, count(*) filter (e) over (partition by name, f, strand) total from (
                        select name, i, i % 3 f, 1 strand, n - (n - i % 3) % 3 edge, c in ({quoted(STARTS)}) s, c in ({quoted(STOPS)}) e from codons
                        union all select name, i, i % 3, -1, n - (n - i % 3) % 3, c in ({turned(STARTS)}), c in ({turned(STOPS)}) from codons))
                group by name, f, strand, g)) where high - low >= 90)"""


_ranks = ", ".join(f"string_split(regexp_replace(lineage, '[a-z]_', '', 'g'), ';')[{k + 1}] {r}" for k, r in enumerate(RANKS))
_as = lambda suffix, table: ", ".join(f"{table}.{c} {c}_{suffix}" for c in TAXON)
_supported = "taxid > 1 and fragments >= 1 and returned >= 1 and agreed >= 1"

RELATIONS = {
    "orfs": "select cluster_rep, cluster_member, regexp_extract(cluster_member, '^(.*)_[^_]*$', 1) contig, cast(regexp_extract(cluster_member, '_([^_]*)$', 1) as bigint) orf_n from fx_clusters",
    "counts": "select contig, count(cluster_member) total_orfs from orfs group by contig having count(cluster_member) >= 3",
    "passing": "select o.*, total_orfs from orfs o join counts using (contig)",
    "allvall": "select a.cluster_rep, a.contig contig1, b.contig contig2, a.orf_n orf_n1, b.orf_n orf_n2, a.total_orfs t1, b.total_orfs t2 from passing a join passing b on a.cluster_rep = b.cluster_rep",
    "co": "select contig1, contig2, count(cluster_rep) co_occur_cts from allvall where contig1 <> contig2 group by all",
    "pairs": """select contig1, contig2, co_occur_cts, t1 total_orfs_ctg1, t2 total_orfs_ctg2, least(t1, t2) "smallest_contig_orfCts",
        orf_n1 identical_orf_position_contig1, orf_n2 identical_orf_position_contig2 from allvall join co using (contig1, contig2)""",
    "dedup": 'select * from pairs where co_occur_cts < 0.3::double * "smallest_contig_orfCts"',
    "red": 'select * from pairs where co_occur_cts >= 0.3::double * "smallest_contig_orfCts"',
    "dedup_ends": "select contig1 c from dedup union select contig2 from dedup",
    "red_ends": "select contig1 c from red union select contig2 from red",
    # clusters of duplicate-level contigs
    "r0": "select contig1, contig2, total_orfs_ctg1 n1, total_orfs_ctg2 n2 from red",
    "strict": "select distinct contig1 c from r0 where n1 > n2 and contig1 not in (select contig1 from r0 where n1 <= n2)",
    "fin": "select distinct contig1, contig2 from r0 where contig1 in (select c from strict)",
    "done": "select contig1 c from fin union select contig2 from fin",
    "r1": "select * from r0 where contig1 not in (select c from done) and contig2 not in (select c from done)",
    "tied": "select contig1 c from r1 where n1 = n2 union select contig2 from r1 where n1 = n2",
    "idx": "select c, dense_rank() over (order by c) i from tied",
    "r1t": "select r1.*, a.i i1, b.i i2 from r1 join idx a on contig1 = a.c join idx b on contig2 = b.c",
    "tierep": "select distinct contig1 c from r1t where i1 >= i2 and contig1 not in (select contig1 from r1t where i1 < i2)",
    "fin2": "select distinct contig1, contig2 from r0 where contig1 in (select c from strict union select c from tierep)",
    "named": "select contig1 c from fin2 union select contig2 from fin2",
    "r2": "select * from r1 where contig2 not in (select c from named)",
    "more": "select contig1, contig2 from r2 where n1 > n2 and contig1 not in (select contig1 from r2 where n1 < n2)",
    "clus": """select distinct c cluster_rep, c cluster_member from (select contig1 c from more union all select contig1 from fin2)
        union all select contig1, contig2 from more union all select contig1, contig2 from fin2""",
    # regions
    "shared": """select distinct contig1 contig, identical_orf_position_contig1 n, 1 side from dedup
        union all select distinct contig2, identical_orf_position_contig2, 2 from dedup""",
    "orfc": 'select s.contig, f.length, c.orf, c.start_bp "start", c.end_bp "end", c.strand, c.metadata from shared s join fx_coords c on c.orf = concat(s.contig, \'_\', s.n) join fx_fai f on f.contig = s.contig',
    "bed": 'select distinct contig, "start", "end", strand, orf from orfc',
    "bed2": 'select *, max("end") over (partition by contig order by "start", "end", orf rows between unbounded preceding and 1 preceding) m from bed',
    "bed3": 'select *, sum(case when m is null or "start" > m + 1000 then 1 else 0 end) over (partition by contig order by "start", "end", orf rows unbounded preceding) g from bed2',
    "merged": """select contig, min("start") "start", max("end") stop, count(*) orf_cts, string_agg(orf, ',' order by "start", "end", orf) orfs_encompassed from bed3 group by contig, g""",
    "meta0": "select m.*, concat(contig, '_region_', row_number() over (partition by contig order by \"start\")) region_idx, stop - \"start\" region_len from merged m",
    "meta1": """select m.*, f.length contig_length, f.length - 1000 end_edge_cutoff, cast(1001 as bigint) start_edge_cutoff,
        case when stop > f.length - 1000 then '_end_edge_' when "start" < 1001 then '_start_edge_' else '_internal_' end region_type from meta0 m join fx_fai f using (contig)""",
    "meta": "select *, concat(region_idx, region_type, 'length=', region_len) region_title from meta1",
    "rorf": "select contig, region_idx, unnest(string_split(orfs_encompassed, ',')) orf from meta",
    "rov": """select a.contig contig1, b.contig contig2, a.region_idx region_idx_contig1, b.region_idx region_idx_contig2, a.orf orf_region1, b.orf orf_region2
        from dedup d join rorf a on a.orf = concat(d.contig1, '_', d.identical_orf_position_contig1) join rorf b on b.orf = concat(d.contig2, '_', d.identical_orf_position_contig2)""",
    # lineages
    "ct_file": f"select contig, taxid, level, taxa, fragments, returned, agreed, percent_agreed, {_ranks} from fx_contig_taxonomy",
    "taxa": "select path, 8 * min(number) + k + 1 taxid from (select number, k, array_to_string(parts[1:k], ';') path from (select number, string_split(lineage, ';') parts from fx_gene_taxonomy where lineage is not null), unnest(range(1, len(parts) + 1)) r(k)) group by k, path",
    "contig_genes": "select contig as name, lineage, weight from fx_gene_taxonomy",
    **_vote("contig_genes", "cvote"),
    "ct": f"select name contig, taxid, level, taxa, fragments, returned, agreed, percent_agreed, {_ranks} from cvote",
    "region_genes": "select region_idx as name, lineage, weight from rorf join fx_gene_taxonomy using (orf)",
    **_vote("region_genes", "rvote"),
    "rt": f"select m.region_title region, taxid, level, taxa, fragments, returned, agreed, percent_agreed, {_ranks} from rvote join meta m on m.region_idx = name",
    "c1": f"""select m.*, r.region, {_as('region', 'r')}, {_as('contig', 'c')} from meta m join rt r on r.region = m.region_title join ct c on c.contig = m.contig
        where r.taxid > 1 and c.taxid > 1 and r.fragments >= 1 and r.returned >= 1 and r.agreed >= 1""",
    "known": f"select * from ct where {_supported}",
    "c2": f"select o.*, {_as('contig1', 'a')}, {_as('contig2', 'b')} from rov o join known a on a.contig = o.contig1 join known b on b.contig = o.contig2",
    "donors": " union ".join(
        f"""select distinct e.contig recipient, e.region_idx recipient_region_idx, o.contig2 donor, o.region_idx_contig2 donor_region_idx, '{x}' hgt_level, e.{r}_region shared_taxon
        from c1 e join c2 o on o.region_idx_contig1 = e.region_idx and o.{r}_contig2 = e.{r}_region where {_level(k, 'region', 'contig').replace(' and ', ' and e.').join(['e.', ''])}"""
        for k, (x, r) in enumerate(zip(LEVELS, RANKS))
    ),
    "h2": _any_level("c2", "contig1", "contig2"),
    "edges": "select region_idx_contig1 u, region_idx_contig2 v from h2 union select region_idx_contig2, region_idx_contig1 from h2",
    "cc(n, root)": "USING KEY",
    "groups0": "select root hgt_group_root, count(*) hgt_group_size from cc group by root",
    "groups1": "select *, row_number() over (order by hgt_group_size desc, hgt_group_root) hgt_group_id from groups0",
    "grp": f"select cc.n region_idx, g.hgt_group_id, g.hgt_group_size, g.hgt_group_root, m.* exclude (region_idx), {', '.join(f't.{r}' for r in RANKS)} from cc join groups1 g on cc.root = g.hgt_group_root left join meta m on m.region_idx = cc.n left join ct t on t.contig = m.contig",
    "types": "select hgt_group_id, string_agg(concat(region_type, ':', n), ',' order by n desc, region_type) region_types from (select hgt_group_id, region_type, count(*) n from grp group by all) group by hgt_group_id",
    "letters": "select name, length(sequence) n, string_split(sequence, '') l from fx_genome",
    "codons": "select name, n, unnest(range(0, n - 2)) i, unnest(list_transform(range(1, n - 1), lambda i: l[i] || l[i + 1] || l[i + 2])) c from letters",
    "oedge": f"select o_region donor_order, o_contig recipient_order, avg(region_len) mean_region_len from (select distinct o_region, o_contig, region_len from c1 where {_level(3, 'region', 'contig')}) group by all",
}

# PageRank with damping 0.85: all of 100 rounds, of which the first that changes less than 1e-6 a node counts
RELATIONS |= {
    "oe": "select distinct donor_order src, recipient_order dst from oedge",
    "odeg": "select src, count(*) degree from oe group by src",
    "onode": "select src node from oe union select dst from oe",
    "ocount": "select count(*)::double n from onode",
    "pr(it, node, r)": """select 0, node, 1 / n from onode cross join ocount
        union all select i.it + 1, x.node, 0.85::double * (coalesce(g.got, 0) + l.loose / n) + (1 - 0.85::double) / n
        from onode x cross join ocount cross join (select max(it) it from pr) i cross join (select coalesce(sum(r), 0) loose from pr where node not in (select src from oe)) l
        left join (select e.dst node, sum(p.r / d.degree) got from pr p join odeg d on d.src = p.node join oe e on e.src = p.node group by e.dst) g on g.node = x.node where i.it < 100""",
    "settled": "select min(a.it) it from (select a.it, sum(abs(a.r - b.r)) change from pr a join pr b on b.node = a.node and b.it = a.it - 1 group by a.it) a, ocount where change < n * 1e-6",
    "rank": "select node, round(r, 6) page_rank from pr where it = (select it from settled)",
    "degrees": "select node, cast(sum(i) as bigint) indegree, cast(sum(o) as bigint) outdegree from (select donor_order node, 0 i, 1 o from oedge union all select recipient_order, 1, 0 from oedge) group by node",
}

#: genes of one sequence are alike, others share nothing
_first = "min(name) over (partition by sequence)"
_scoring = Scoring(alphabet=16)
_pair = 'contig1, contig2, co_occur_cts, total_orfs_ctg1, total_orfs_ctg2, "smallest_contig_orfCts", identical_orf_position_contig1, identical_orf_position_contig2'
SELECTS = {
    "scan_clusters": "select * from fx_clusters",
    "scan_coords": 'select orf, start_bp "start", end_bp "end", strand, metadata from fx_coords',
    "scan_fai": "select contig, length from fx_fai",
    "orf_parse": "select * from orfs",
    "orf_id_build": "select concat(contig, '_', orf_n) orf from orfs",
    "cluster_rep_members": "select cluster_rep, count(*) members from fx_clusters group by 1",
    "contig_orf_counts": "select * from counts",
    "allvall": "select cluster_rep, contig1, contig2, orf_n1, orf_n2 from allvall",
    "pair_overlaps": "select * from pairs",
    "dedup_overlaps": "select * from dedup",
    "redundant_overlaps": "select * from red",
    "overlap_status": "select *, 'redundant' status from red union all select *, 'non-redundant' from dedup",
    "overlap_accounting": """select (select count(distinct contig) from orfs) input_contigs, (select count(*) from counts) passing_contigs,
        (select count(distinct contig) from orfs) - (select count(*) from counts) filtered_contigs,
        (select count(*) from counts) - (select count(distinct contig1) from co) singlet_contigs, (select count(distinct contig1) from co) submitted_contigs,
        (select count(*) from dedup_ends where c not in (select c from red_ends)) nonredundant_contigs, (select count(*) from red_ends) redundant_contigs,
        (select count(*) from (select contig1 from pairs union select contig2 from pairs)) contigs_with_overlaps,
        (select count(*) from dedup_ends where c not in (select c from red_ends)) dedup_contigs""",
    "contig_clusters": "select * from clus",
    "cluster_accounting": """select (select count(distinct contig1) from r0 where n1 >= n2 and contig1 not in (select contig1 from r0 where n1 < n2)) size_selected_reps,
        count(distinct cluster_rep) cluster_reps, count(distinct cluster_member) cluster_members,
        (select count(*) from (select cluster_rep from clus union select cluster_member from clus)) contigs_represented from clus""",
    "overlap_orf_coords": "select * from orfc",
    "potential_hgts_bed": "select * from bed",
    "merge_intervals": "select * from merged",
    "region_metadata": "select * from meta",
    "region_orfs": "select * from rorf",
    "region_overlaps": "select * from rov",
    "filter_reciprocals": "select * from rov where contig1 < contig2",
    "region_slop": 'select contig, greatest("start" - 1000, 0) "start", least(stop + 1000, contig_length) stop, region_title from meta',
    "extract_regions": """select concat(region_title, '::', contig, ':', "start", '-', stop) name, cast(0 as integer) part, cast(stop - "start" as integer) letters, md5(substr(sequence, "start" + 1, stop - "start")) sequence_md5
        from (select contig, greatest("start" - 1000, 0) "start", least(stop + 1000, contig_length) stop, region_title from meta) join fx_sequences on contig = name where stop > "start\"""",
    "fasta_index_file": "select contig, length, least(60, length) linebases, least(60, length) + 1 linewidth from fx_fai",
    "orf_scan": _orfs(),
    "kmer_candidates": f"select {_first} query, name target, 1.0::double identity, 1.0::double query_cover, 1.0::double target_cover from fx_gene_sequences qualify name <> query",
    # the centre of three or more has the most neighbours; of two the tie goes to the larger checksum
    "gene_clusters": f"select case when count(*) over (partition by sequence) = 2 then arg_max(name, md5(name)) over (partition by sequence) else {_first} end cluster_rep, name cluster_member from fx_gene_sequences",
    # a gene is the start of its cluster's subject: all its letters match; by chance none aligns better
    "aligned_hits": f"select g.name qtitle, t.name stitle, 100.0::double pident, round(({_scoring.scale!r}::double * 5 * length(g.sequence) - ln({_scoring.k!r}::double)) / ln(2), 6) bitscore, 0.0::double evalue from fx_gene_sequences g join fx_subjects t on starts_with(t.sequence, g.sequence) and left(t.sequence, 32) = left(g.sequence, 32)",
    "scan_overlaps": "select * from dedup",
    "scan_merged_bed": "select * from merged",
    "scan_region_metadata": "select * from meta",
    "scan_region_overlaps": "select * from rov",
    "extract_regions_whole": "select concat(region_title, '::', contig, ':', \"start\", '-', stop) name, substr(sequence, cast(\"start\" + 1 as int), cast(stop - \"start\" as int)) sequence from fx_cuts_whole join fx_fasta on contig = name where stop <= length(sequence)",
    "fasta_index": "select name contig, length(sequence) length from fx_fasta",
    "orf_header_parse": 'select orf, start_bp "start", end_bp "end", strand, metadata from fx_coords',
    "parse_lineage": f"select contig, {', '.join(RANKS)} from ct_file",
    "scan_taxonomy": "select * from ct_file",
    "lineage_vote": "select name contig, * exclude (name) from cvote",
    "region_lineage_vote": "select name region_idx, * exclude (name) from rvote",
    "region_name_clean": "select region_idx, region_title region from meta",
    "criteria1_input": "select * from c1",
    "criteria2_input": "select * from c2",
    "hgt1_levels": _by_level("c1", "region", "contig", "region_idx, contig"),
    "hgt2_levels": _by_level("c2", "contig1", "contig2", "orf_region1, orf_region2"),
    "hgt1_level_counts": _counts("c1", "region", "contig"),
    "hgt2_level_counts": _counts("c2", "contig1", "contig2"),
    "all_hgt1": _any_level("c1", "region", "contig"),
    "all_hgt2": "select * from h2",
    "donor_recipient": "select * from donors",
    "donor_level_counts": " union all ".join(f"select '{x}' hgt_level, count(*) instances from donors where hgt_level = '{x}'" for x in LEVELS),
    "all_donor_recipient": "select distinct recipient, recipient_region_idx, donor, donor_region_idx, " + ", ".join(f"case when hgt_level = '{x}' then shared_taxon end {r}_shared_taxon" for x, r in zip(LEVELS, RANKS)) + " from donors",
    "hgt_components": "select n region_idx, root hgt_group_root from cc",
    "hgt_groups": "select * from grp",
    "group_report": f"""select hgt_group_id, first(hgt_group_size) hgt_group_size, count(distinct region_idx) num_regions, count(distinct contig) num_contigs, cast(sum(region_len) as bigint) total_region_len,
        avg(region_len) avg_region_len, max(region_len) max_region_len, first(region_types) region_types, {', '.join(f'count(distinct {r}) num_distinct_{d}' for r, d in zip(RANKS, DIVERSITY))}
        from grp join types using (hgt_group_id) group by hgt_group_id""",
    "order_graph_edges": "select * from oedge",
    "graph_degrees": "select node, cast(sum(i) as bigint) indegree, cast(sum(o) as bigint) outdegree from (select donor_order node, 0 i, 1 o from oedge union all select recipient_order, 1, 0 from oedge) group by node",
    "order_graph_pagerank": "select * from rank",
    "order_graph_stats": "select * from rank join degrees using (node)",
    "hgt2_undirected_level_counts": _counts("(select * from c2 where contig1 < contig2) c2", "contig1", "contig2"),
    "event_counts": f"""select (select count(distinct hgt_group_id) from grp) "groups", (select count(*) from ({_any_level("c1", "region", "contig")})) criterion1_rows, (select count(*) from h2) criterion2_rows,
        (select count(*) from (select distinct least(region_idx_contig1, region_idx_contig2), greatest(region_idx_contig1, region_idx_contig2) from h2)) region_pairs, (select count(*) from donors) donor_pairs""",
    "annot_ripdb": _hits(20, 80, 80),
    "annot_card": _hits(90, 50, 50),
    "annot_mobileog": _hits(20, 80, 80),
}
_CC = """cc(n, root) using key (n) as (select u, u from edges group by u union
    select e.u, min(c.root) from cc c join edges e on e.v = c.n join recurring.cc r on r.n = e.u where c.root < r.root group by e.u)"""


def oracle_sql() -> dict[str, str]:
    steps = ",\n".join(_CC if n.startswith("cc(") else f"{n} as ({q})" for n, q in RELATIONS.items())
    head = f"with recursive {with_fixtures(lambda n: n)},\n{steps}\n"
    return {name: head + q for name, q in SELECTS.items()}
