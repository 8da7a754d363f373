"""SQL exploration over the feature table.

The feature table is registered under the reference's two view names, and
the report's column projection is kept as SQL text: Catalyst plans it the
same way as the DataFrame form, straight down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_NAMES = ("network_features", "network_traffic")

# Fixed output list: the report's columns, in their order.
REPORT_COLUMNS_SQL = """
SELECT filename, packet_count, total_bytes, unique_src_ips, unique_dst_ips,
       tcp_packet_count, udp_packet_count, icmp_packet_count, http_packet_count,
       dns_packet_count, protocol_diversity, connection_density
FROM network_features
"""

QUERIES = {"report_columns": REPORT_COLUMNS_SQL}


def register_views(features: DataFrame, *names: str) -> DataFrame:
    """Register ``features`` as temporary views (default: both reference names)."""
    for name in names or VIEW_NAMES:
        features.createOrReplaceTempView(name)
    return features


def sql_query(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(QUERIES[name])
