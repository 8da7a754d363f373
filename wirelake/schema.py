"""Data contracts: packet table, feature table, stream lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Fixed values that must match the reference's output: the five protocol
# kinds in the reference's display order, and the feature column order.
PROTOCOLS = ["TCP", "UDP", "ICMP", "HTTP", "DNS"]
PROTOCOL_COUNT_COLUMNS = {
    "TCP": "tcp_packet_count",
    "UDP": "udp_packet_count",
    "ICMP": "icmp_packet_count",
    "HTTP": "http_packet_count",
    "DNS": "dns_packet_count",
}

FEATURE_COLUMNS = [
    "packet_count", "total_bytes", "unique_src_ips", "unique_dst_ips",
    "tcp_packet_count", "udp_packet_count", "icmp_packet_count",
    "http_packet_count", "dns_packet_count", "avg_packet_size",
    "protocol_diversity", "connection_density", "syn_flood_indicator",
]

# Counts are 64-bit and ratios double (the reference used 32-bit floats,
# which rounds byte totals above 2**24).
FEATURE_SCHEMA = T.StructType(
    [T.StructField("filename", T.StringType(), True)]
    + [T.StructField(c, T.LongType(), True) for c in FEATURE_COLUMNS[:9]]
    + [T.StructField(c, T.DoubleType(), True) for c in FEATURE_COLUMNS[9:]]
)

PACKET_SCHEMA = T.StructType([
    T.StructField("packet_no", T.LongType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("has_ip", T.BooleanType(), True),
    T.StructField("src_ip", T.StringType(), True),
    T.StructField("dst_ip", T.StringType(), True),
    T.StructField("is_tcp", T.BooleanType(), True),
    T.StructField("is_udp", T.BooleanType(), True),
    T.StructField("is_icmp", T.BooleanType(), True),
    T.StructField("is_http", T.BooleanType(), True),
    T.StructField("is_dns", T.BooleanType(), True),
    T.StructField("tcp_flags", T.IntegerType(), True),
    T.StructField("packet_size", T.IntegerType(), True),
])


def to_feature_schema(df: DataFrame) -> DataFrame:
    """Cast and order a feature DataFrame to ``FEATURE_SCHEMA`` (extra key columns such as ``path`` stay in front)."""
    extra = [c for c in df.columns if c not in FEATURE_SCHEMA.fieldNames()]
    return df.select(
        *extra,
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_SCHEMA.fields],
    )
