"""Hot clusters, hub contigs and long contigs: the same rows for every way of dealing, and no task with a large share."""

import collections
import random

from pyspark.sql import functions as F

from contiglink.operators import clustering, overlaps, regions


def bag(df):
    return collections.Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def plain_merge(rows, distance):
    out = []
    for contig in sorted({r[0] for r in rows}):
        for _, start, end, _, orf in sorted((r for r in rows if r[0] == contig), key=lambda r: (r[1], r[2], r[4])):
            if out and out[-1][0] == contig and start <= out[-1][2] + distance:
                out[-1][2] = max(out[-1][2], end)
                out[-1][3].append(orf)
            else:
                out.append([contig, start, end, [orf]])
    return collections.Counter((c, a, b, len(o), ",".join(o)) for c, a, b, o in out)


def test_merge_for_every_span(spark):
    r = random.Random(3)
    rows = []
    for k in range(400):
        contig = "hub" if k % 2 else f"c{r.randrange(9)}"
        a = r.randrange(3000)
        rows.append((contig, a, a + r.choice([5, 40, 900]), 1, f"{contig}_{k}"))
    bed = spark.createDataFrame(rows, "contig string, start long, end long, strand int, orf string")
    want = plain_merge(rows, 10)
    for span in (1, 37, 500, regions.SPAN):
        merged = regions.merge_intervals(bed, 10, span)
        assert collections.Counter(map(tuple, merged.select("contig", "start", "stop", "orf_cts", "orfs_encompassed").collect())) == want, span
        numbers = {(x.contig, x.number): x.start for x in regions.region_numbers(merged, span).collect()}
        assert len(numbers) == sum(want.values())
        for c in {c for c, _ in numbers}:
            own = [numbers[c, k] for k in range(1, 1 + sum(x == c for x, _ in numbers))]
            assert own == sorted(own)


def test_a_contig_is_dealt_over_its_spans(spark):
    bed = spark.range(3000).select(F.lit("hub").alias("contig"), (F.col("id") * 500).alias("start"), (F.col("id") * 500 + 400).alias("end"), F.lit(1).alias("strand"), F.concat(F.lit("hub_"), F.col("id").cast("string")).alias("orf"))
    assert regions.merge_intervals(bed, 10, 5000).count() == 3000 and regions.merge_intervals(bed, 100, 5000).count() == 1
    assert regions.merge_intervals(bed, 100, 5000).first().stop == 2999 * 500 + 400


def test_hub_contigs_by_lookup(spark):
    r = random.Random(8)
    size = {f"k{k}": r.randrange(3, 7) for k in range(120)}
    pairs = {("k0", f"k{k}") for k in range(1, 60)} | {tuple(sorted(r.sample(sorted(size), 2))) for _ in range(150)}
    rows = [x for a, b in pairs if a != b for x in ((a, b, size[a], size[b]), (b, a, size[b], size[a]))]
    df = spark.createDataFrame(rows + rows[:10], "contig1 string, contig2 string, total_orfs_ctg1 long, total_orfs_ctg2 long")
    assert bag(clustering.contig_clusters(df, large=0)) == bag(clustering.contig_clusters(df))


def test_largest_cell_of_a_hot_cluster(spark):
    """One cluster holds a third of the rows: none of the tasks that pair its genes has a tenth of the pairs."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 700).cast("string"))).alias("cluster_rep"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("contig"), F.lit(1).cast("long").alias("orf_n"), F.lit(3).cast("long").alias("total_orfs"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    half = overlaps._half_pairs(rows, cell=60)
    per = half.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count"), F.sum("count")).first()
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert per[0] < per[1] / 10 and bag(half) == bag(overlaps._half_pairs(rows, cell=10**6))
