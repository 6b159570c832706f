"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from contiglink.plans.queries import Relations, VIEWS

HEADLINE = (
    "scan_clusters", "orf_parse", "contig_orf_counts", "pair_overlaps", "dedup_overlaps", "overlap_accounting", "contig_clusters", "potential_hgts_bed", "merge_intervals",
    "region_metadata", "region_overlaps", "filter_reciprocals", "parse_lineage", "criteria1_input", "criteria2_input", "hgt1_level_counts", "hgt2_level_counts", "all_hgt1",
    "all_hgt2", "all_donor_recipient", "hgt_components", "hgt_groups", "group_report", "graph_degrees", "order_graph_pagerank", "annot_card",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # starts the executor threads
    relations = Relations(spark, sf_dir)  # steps that queries share are written once, as in a run of the whole analysis
    took = {}
    for name in HEADLINE:
        began = time.time()
        VIEWS[name](relations).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "whole analysis, steps kept between queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
