"""Clustering (E1-E5), report (R1, R2) and feature properties."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from wirelake.operators import cluster
from wirelake.operators import features as feat
from wirelake.operators.report import report_lines, write_report
from wirelake.sources.tables import packets_events, packets_lineitem


def test_grouping_does_not_depend_on_the_cluster(spark):
    """The same partitions, and so the same start and result, for any layout of the input."""
    features = feat.feature_table(packets_events(spark, SF001)).checkpoint()
    found = []
    for layout in (features.coalesce(1), features.repartition(8), features.repartition(200, "packet_count")):
        assert cluster.repeatable(layout).rdd.getNumPartitions() == cluster.FIT_PARTITIONS
        _, predictions = cluster.fit_kmeans(layout)
        found.append(sorted((r.filename, r.prediction) for r in predictions.collect()))
    assert found[0] == found[1] == found[2]


def test_given_k_is_capped_at_distinct_vectors(spark):
    features = feat.feature_table(packets_events(spark, SF001)).limit(2).checkpoint()
    model, _ = cluster.fit_kmeans(features, k=9)
    assert len(model.clusterCenters()) == 2


def test_kmeans_is_repeatable_and_uses_rule_k(spark):
    features = feat.feature_table(packets_events(spark, SF001)).checkpoint()
    k = cluster.choose_k(features).first()
    assert k.k == min(3, max(2, k.rows // 2))
    _, p1 = cluster.fit_kmeans(features)
    _, p2 = cluster.fit_kmeans(features)
    a = {(r.filename, r.prediction) for r in p1.collect()}
    assert a == {(r.filename, r.prediction) for r in p2.collect()}
    assert len({p for _, p in a}) <= k.k


def test_single_distinct_vector_gives_one_cluster(spark):
    features = feat.feature_table(packets_events(spark, SF001)).limit(1).checkpoint()
    assert cluster.choose_k(features).first().k == 1
    model, pred = cluster.fit_kmeans(features)
    assert model is None and {r.prediction for r in pred.collect()} == {0}
    assert cluster.silhouette(pred).first().silhouette is None


def test_merged_edges_equal_one_pass(spark):
    packets = packets_lineitem(spark, SF001)
    one = feat.feature_table(packets)
    early = feat.edge_table(packets.filter(F.col("ts") < "1995-01-01"), ["filename"])
    late = feat.edge_table(packets.filter(~(F.col("ts") < "1995-01-01")), ["filename"])
    merged = feat.features_from_edges(feat.merge_edges(early, late, keys=["filename"]), ["filename"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, merged.select(one.columns).collect()))


def test_direct_and_edge_forms_agree(spark):
    packets = packets_events(spark, SF001)
    a = feat.feature_table(packets)
    b = feat.feature_table_direct(packets).select(a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_approx_uniques_within_bound(spark):
    packets = packets_lineitem(spark, "/root/testdata/sf0.01")
    exact = {r.filename: r for r in feat.feature_table(packets).collect()}
    for r in feat.approx_feature_table(packets).collect():
        e = exact[r.filename]
        assert r.packet_count == e.packet_count and r.total_bytes == e.total_bytes
        for c in ("unique_src_ips", "unique_dst_ips"):
            assert abs(r[c] - e[c]) <= 0.15 * e[c] + 1


def test_sketches_merge_across_batches(spark):
    packets = packets_lineitem(spark, SF001).withColumn("batch", F.year("ts"))
    merged = feat.merge_endpoint_sketches(feat.endpoint_sketches(packets, ["filename"], "batch"), ["filename"])
    exact = {r.filename: r for r in feat.feature_table(packets.drop("batch")).collect()}
    for r in merged.collect():
        assert abs(r.unique_src_ips - exact[r.filename].unique_src_ips) <= 0.1 * exact[r.filename].unique_src_ips + 1


def test_report_text(spark, scratch):
    features = feat.feature_table(packets_events(spark, SF001)).checkpoint()
    _, pred = cluster.fit_kmeans(features)
    lines = report_lines(features, cluster.silhouette(pred))
    out = os.path.join(scratch, "report")
    write_report(lines, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-"))
    rows = text.split("\n")
    assert rows[0] == "=== Network Traffic Analysis Report ==="
    assert rows[2].startswith("File: cap_") and rows[4].startswith("Total Bytes: ") and rows[4].endswith(".00")
    assert "  - TCP: " in text and "=== Clustering Results ===" in text
    assert rows[-2].startswith("Silhouette Score: ")
    assert text.count("File: ") == features.count()


def test_hot_capture_spreads_over_partitions(spark):
    """One capture with over a third of all packets: its edges spread over the shuffle partitions."""
    packets = packets_lineitem(spark, "/root/testdata/sf0.01").withColumn(
        "filename", F.when(F.col("packet_no") % 3 == 0, F.lit("hot.pcap")).otherwise(F.col("filename")))
    a = feat.feature_table(packets)
    b = feat.feature_table_direct(packets).select(a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # look at the raw shuffle layout
    try:
        edges = feat.edge_table(packets, ["filename"]).filter(F.col("filename") == "hot.pcap")
        sizes = [r["count"] for r in edges.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) <= 2 * (sum(sizes) / len(sizes))
