"""Lineage votes against a plain count of every ancestor."""

import collections
import random

import pytest

from contiglink.operators import taxonomy

VOTES = "name string, lineage string, weight double, k int, path string"


def plain(rows, majority):
    out = {}
    by = collections.defaultdict(list)
    for name, lineage, weight, *_ in rows:
        by[name].append((lineage, weight))
    for name, genes in by.items():
        known = [(x, w) for x, w in genes if x]
        total = sum(w for _, w in known)
        weight, count = collections.Counter(), collections.Counter()
        for x, w in known:
            parts = x.split(";")
            for k in range(1, len(parts) + 1):
                weight[";".join(parts[:k])] += w
                count[";".join(parts[:k])] += 1
        most = [p for p in weight if weight[p] > majority * total]
        label = max(most, key=lambda p: p.count(";"), default=None)
        agreed = count[label] if label else len(known)
        out[name] = (len(genes), len(known), agreed, weight[label] / total if label else float(bool(known)), label)
    return out


def test_votes(spark):
    r = random.Random(5)
    tree = [";".join(f"{x}_{x.upper()}{r.randrange(2)}" for x in "dpcofgs"[: r.randrange(1, 8)]) for _ in range(60)]
    rows = [(f"c{r.randrange(30)}", r.choice([None, "", *tree[: r.choice([3, 60])]]), float(r.randrange(1, 9)), 1, "x") for _ in range(500)]
    rows += [("hub", r.choice(tree), 1.0, 1, "x") for _ in range(2000)] + [("none", None, 3.0, 1, "x"), ("split", "d_A;p_B", 2.0, 1, "x"), ("split", "d_C;p_D", 2.0, 1, "x"), (None, "d_A", 1.0, 1, "x")]
    votes = spark.createDataFrame(rows, VOTES).repartition(5)
    taxa = taxonomy.taxon_numbers(spark.createDataFrame([(x, k) for k, x in enumerate([*tree, "d_A;p_B", "d_C;p_D"])], "lineage string, number long"))
    numbers = {x.lineage: x.taxid for x in taxa.collect()}
    assert len(set(numbers.values())) == len(numbers) and min(numbers.values()) > 1
    for majority in (0.5, 0.8):
        got = {x.name: x for x in taxonomy.lineage_vote(votes, taxa, majority=majority).collect() if x.name is not None}
        want = plain([x for x in rows if x[0] is not None], majority)
        assert {n: (x.fragments, x.returned, x.agreed, x.percent_agreed, x.lineage) for n, x in got.items()} == want
        assert all(x.taxid == (numbers[x.lineage] if x.lineage else int(x.returned > 0)) for x in got.values())
    assert (got["none"].taxa, got["split"].taxa, got["split"].level) == ("unclassified", "root", "no rank")
    assert all(x.level == taxonomy.RANK_NAMES[x.lineage.count(";")] and x.taxa == x.lineage.split(";")[-1][2:] for x in got.values() if x.lineage)
    assert taxonomy.lineage_vote(votes.limit(0), taxa).count() == 0


def test_eight_ranks_raise(spark):
    votes = spark.createDataFrame([("c", ";".join("abcdefgh"), 1.0, 1, "x")], VOTES)
    with pytest.raises(Exception, match="more than seven"):
        taxonomy.lineage_vote(votes, spark.createDataFrame([], "lineage string, taxid long")).collect()


def test_genes_brought_together_or_dealt(spark):
    """Names with few genes are counted in one place, those with many are dealt out: the same table."""
    r = random.Random(11)
    tree = [";".join(f"{x}_{x.upper()}{r.randrange(3)}" for x in "dpcofgs"[: r.randrange(1, 8)]) for _ in range(40)]
    rows = [(f"c{min(r.randrange(40), r.randrange(40))}", r.choice([None, "", *tree]), float(r.randrange(1, 9)), 1, "x") for _ in range(900)]
    votes = spark.createDataFrame(rows, VOTES).repartition(5)
    taxa = taxonomy.taxon_numbers(spark.createDataFrame([(x, k) for k, x in enumerate(tree)] * 3, "lineage string, number long"))
    tables = [{tuple(x) for x in taxonomy.lineage_vote(votes, taxa, majority=m, cell=c).collect()} for m in (0.2, 0.5) for c in (0, 20, 10**6)]
    assert tables[0] == tables[1] == tables[2] and tables[3] == tables[4] == tables[5] != tables[0]
    sizes = votes.groupBy("name").count()
    assert {tuple(x) for x in taxonomy.lineage_vote(votes, taxa, sizes=sizes, cell=20).collect()} == tables[3]


def test_one_shuffle_of_rows(spark):
    """Ancestors of a name's genes are counted where its genes are: no exchange by ancestor."""
    votes = spark.createDataFrame([(f"c{k % 9}", "d_A;p_B", 1.0, 1, "x") for k in range(50)], VOTES)
    plan = taxonomy._counted(votes, "name", 0.5, False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and taxonomy._counted(votes, "name", 0.5, True)._jdf.queryExecution().executedPlan().toString().count("Exchange") > 2
