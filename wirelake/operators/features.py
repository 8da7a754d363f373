"""Per-capture traffic features.

The exact path aggregates twice. First an *edge table*: one row per
(capture, source, destination) with packet, byte, protocol and SYN counts.
Its shuffle key includes both addresses, so a capture holding a third of all
packets is still spread over many tasks, and the map-side partial aggregate
collapses repeated pairs before anything is shuffled. Then the features:
sums of the edge counts, plus distinct sources and destinations counted over
the (much smaller) edge table. Edge tables from separate runs or batches
merge by re-aggregation (``merge_edges``), which is how results computed in
pieces combine into the same features as one pass over all packets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wirelake.functions.protocol import flag_count, is_pure_syn, safe_ratio
from wirelake.schema import FEATURE_COLUMNS

_EDGE_COUNTS = ["tcp", "udp", "icmp", "http", "dns"]


def capture_keys(df: DataFrame, keys: list[str] | None = None) -> list[str]:
    """Group by ``path`` (unique) when present and keep ``filename`` (basename) for display."""
    if keys is not None:
        return list(keys)
    return ["path", "filename"] if "path" in df.columns else ["filename"]


def edge_table(packets: DataFrame, keys: list[str] | None = None, batch: str | None = None) -> DataFrame:
    """One row per (capture keys, [batch], src_ip, dst_ip) with additive counts."""
    keys = capture_keys(packets, keys) + ([batch] if batch else [])
    return packets.groupBy(*keys, "src_ip", "dst_ip").agg(
        F.count(F.lit(1)).alias("packets"),
        F.sum("packet_size").cast("long").alias("bytes"),
        *[flag_count(f"is_{p}").alias(p) for p in _EDGE_COUNTS],
        F.count_if(is_pure_syn("tcp_flags")).alias("syn"),
        F.bool_or(F.coalesce("has_ip", F.lit(False))).alias("has_ip"),
    )


def merge_edges(*edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Combine edge tables of the same captures (other runs, batches) into one."""
    unioned = reduce(lambda a, b: a.unionByName(b), edges)
    keys = capture_keys(unioned, keys)
    return unioned.groupBy(*keys, "src_ip", "dst_ip").agg(
        F.sum("packets").alias("packets"),
        F.sum("bytes").alias("bytes"),
        *[F.sum(p).alias(p) for p in _EDGE_COUNTS],
        F.sum("syn").alias("syn"),
        F.bool_or("has_ip").alias("has_ip"),
    )


def _derive(agg: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("packet_count")
    seen = [F.when(F.col(f"{p}_packet_count") > 0, 1).otherwise(0) for p in _EDGE_COUNTS]
    return agg.select(
        *keys,
        *FEATURE_COLUMNS[:9],
        safe_ratio("total_bytes", n).alias("avg_packet_size"),
        (reduce(lambda a, b: a + b, seen).cast("double") / F.lit(5.0)).alias("protocol_diversity"),
        safe_ratio("connections", n).alias("connection_density"),
        safe_ratio("syn_packets", n).alias("syn_flood_indicator"),
    )


def features_from_edges(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = capture_keys(edges, keys)
    connection = F.col("has_ip") & F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()
    agg = edges.groupBy(*keys).agg(
        F.sum("packets").alias("packet_count"),
        F.sum("bytes").alias("total_bytes"),
        F.count_distinct("src_ip").alias("unique_src_ips"),
        F.count_distinct("dst_ip").alias("unique_dst_ips"),
        *[F.sum(p).alias(f"{p}_packet_count") for p in _EDGE_COUNTS],
        F.count_if(connection).alias("connections"),
        F.sum("syn").alias("syn_packets"),
    )
    return _derive(agg, keys)


def feature_table(packets: DataFrame, keys: list[str] | None = None,
                  captures: DataFrame | None = None) -> DataFrame:
    """The feature table (C10): C1-C9 for every capture in one job.

    ``captures`` (a DataFrame with the key columns) adds captures that have no
    packets, with all-zero features.
    """
    keys = capture_keys(packets, keys)
    features = features_from_edges(edge_table(packets, keys), keys)
    return with_empty_captures(features, captures, keys) if captures is not None else features


def feature_table_direct(packets: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Single-aggregate form (Catalyst expands the three distinct counts). Kept for plan comparison."""
    keys = capture_keys(packets, keys)
    connection = F.when(F.col("has_ip"), F.struct("src_ip", "dst_ip"))
    agg = packets.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("packet_count"),
        F.sum("packet_size").cast("long").alias("total_bytes"),
        F.count_distinct("src_ip").alias("unique_src_ips"),
        F.count_distinct("dst_ip").alias("unique_dst_ips"),
        *[flag_count(f"is_{p}").alias(f"{p}_packet_count") for p in _EDGE_COUNTS],
        F.count_distinct(connection).alias("connections"),
        F.count_if(is_pure_syn("tcp_flags")).alias("syn_packets"),
    )
    return _derive(agg, keys)


def with_empty_captures(features: DataFrame, captures: DataFrame, keys: list[str]) -> DataFrame:
    """Left join from the capture list so captures without packets get zero features."""
    joined = captures.select(*keys).distinct().join(features, keys, "left")
    zeros = {c: 0 for c in FEATURE_COLUMNS[:9]}
    zeros.update({c: 0.0 for c in FEATURE_COLUMNS[9:]})
    return joined.na.fill(zeros).select(*keys, *FEATURE_COLUMNS)


def approx_feature_table(packets: DataFrame, keys: list[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """Opt-in approximate uniques for very large captures.

    The three distinct counts become HyperLogLog++ estimates with relative
    standard deviation ``rsd``; everything else stays exact. One aggregate,
    no distinct expansion.
    """
    keys = capture_keys(packets, keys)
    pair = F.when(F.col("has_ip"), F.concat_ws(">", "src_ip", "dst_ip"))
    agg = packets.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("packet_count"),
        F.sum("packet_size").cast("long").alias("total_bytes"),
        F.approx_count_distinct("src_ip", rsd).alias("unique_src_ips"),
        F.approx_count_distinct("dst_ip", rsd).alias("unique_dst_ips"),
        *[flag_count(f"is_{p}").alias(f"{p}_packet_count") for p in _EDGE_COUNTS],
        F.approx_count_distinct(pair, rsd).alias("connections"),
        F.count_if(is_pure_syn("tcp_flags")).alias("syn_packets"),
    )
    return _derive(agg, keys)


def endpoint_sketches(packets: DataFrame, keys: list[str] | None = None, batch: str | None = None,
                      lg_k: int = 12) -> DataFrame:
    """Mergeable HLL sketches of sources and destinations per capture (and batch)."""
    keys = capture_keys(packets, keys) + ([batch] if batch else [])
    return packets.groupBy(*keys).agg(
        F.hll_sketch_agg("src_ip", lg_k).alias("src_sketch"),
        F.hll_sketch_agg("dst_ip", lg_k).alias("dst_sketch"),
    )


def merge_endpoint_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Union sketches across batches or runs and estimate unique endpoints."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("src_sketch", True)).alias("unique_src_ips"),
        F.hll_sketch_estimate(F.hll_union_agg("dst_sketch", True)).alias("unique_dst_ips"),
    )
