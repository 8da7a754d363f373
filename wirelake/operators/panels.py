"""Dashboard and summary data sets over the feature table.

Each function returns the rows a chart would draw, as a DataFrame; nothing is
collected. Long forms use ``unpivot`` (one pass, no shuffle); grand totals
are ungrouped aggregates whose partial sums are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wirelake.functions.protocol import safe_ratio
from wirelake.schema import PROTOCOL_COUNT_COLUMNS, PROTOCOLS


def _protocol_position(c: str = "protocol"):
    return F.array_position(F.array(*[F.lit(p) for p in PROTOCOLS]), F.col(c))


def packets_by_capture(features: DataFrame) -> DataFrame:
    """Packet count per capture."""
    return features.select("filename", "packet_count")


def protocol_totals(features: DataFrame) -> DataFrame:
    """The five (overlapping) protocol counts summed over all captures, long form."""
    totals = features.agg(*[F.sum(PROTOCOL_COUNT_COLUMNS[p]).alias(p) for p in PROTOCOLS])
    return totals.unpivot([], PROTOCOLS, "protocol", "packets")


def protocol_share(features: DataFrame) -> DataFrame:
    """Protocol totals and each one's share of their sum (the pie).

    The window has no partition key, but it runs over the five total rows only.
    """
    totals = protocol_totals(features)
    return totals.select(
        "protocol", "packets",
        safe_ratio("packets", F.sum("packets").over(Window.partitionBy())).alias("share"),
    )


def endpoints_long(features: DataFrame) -> DataFrame:
    """D3: unique sources and destinations per capture, long form."""
    return features.select(
        "filename",
        F.col("unique_src_ips").alias("Source IPs"),
        F.col("unique_dst_ips").alias("Destination IPs"),
    ).unpivot(["filename"], ["Source IPs", "Destination IPs"], "endpoint", "addresses")


def avg_size_by_capture(features: DataFrame) -> DataFrame:
    """Average packet size per capture."""
    return features.select("filename", "avg_packet_size")


def traffic_by_protocol(features: DataFrame) -> DataFrame:
    """Packets per (capture, protocol), long form (the stacked bars)."""
    wide = features.select("filename", *[F.col(PROTOCOL_COUNT_COLUMNS[p]).alias(p) for p in PROTOCOLS])
    return wide.unpivot(["filename"], PROTOCOLS, "protocol", "packets")


def protocol_long(features: DataFrame) -> DataFrame:
    """(capture, protocol, count, percentage of the capture's packets); 0 for empty captures."""
    wide = features.select(
        "filename", "packet_count", *[F.col(PROTOCOL_COUNT_COLUMNS[p]).alias(p) for p in PROTOCOLS]
    )
    long = wide.unpivot(["filename", "packet_count"], PROTOCOLS, "protocol", "count")
    return long.select(
        "filename", "protocol", "count",
        (safe_ratio("count", "packet_count") * F.lit(100.0)).alias("percentage"),
    )


def protocol_count_by_capture(features: DataFrame, protocol: str | None = None) -> DataFrame:
    """The count series per protocol (all five unless ``protocol`` is given)."""
    long = protocol_long(features)
    if protocol is not None:
        long = long.filter(F.col("protocol") == protocol)
    return long.select("filename", "protocol", "count")


def protocol_percentage(features: DataFrame, protocol: str | None = None) -> DataFrame:
    """The percentage series per protocol."""
    long = protocol_long(features)
    if protocol is not None:
        long = long.filter(F.col("protocol") == protocol)
    return long.select("filename", "protocol", "percentage")


def protocol_comparison(features: DataFrame) -> DataFrame:
    """Total count per protocol (grouped over the long table)."""
    return protocol_long(features).groupBy("protocol").agg(F.sum("count").alias("total_count"))


def protocol_trend(features: DataFrame, order_col: str | None = None) -> DataFrame:
    """Counts per protocol over captures in input order.

    ``order_col`` is the capture's position in the input (``capture_index``
    from ingest); without it the captures are ordered by name. The sort is
    a distributed range sort.
    """
    order_col = order_col or ("capture_index" if "capture_index" in features.columns else "filename")
    wide = features.select(
        "filename", F.col(order_col).alias("capture_order"),
        *[F.col(PROTOCOL_COUNT_COLUMNS[p]).alias(p) for p in PROTOCOLS],
    )
    long = wide.unpivot(["filename", "capture_order"], PROTOCOLS, "protocol", "count")
    return long.orderBy("capture_order", _protocol_position()).select("filename", "protocol", "count")


def summary(features: DataFrame) -> DataFrame:
    """Files, packets, bytes, gigabytes (1e9) and bytes per packet over all captures."""
    agg = features.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("packet_count"), F.lit(0)).cast("long").alias("total_packets"),
        F.coalesce(F.sum("total_bytes"), F.lit(0)).cast("long").alias("total_bytes"),
    )
    return agg.select(
        "files", "total_packets", "total_bytes",
        (F.col("total_bytes").cast("double") / F.lit(1e9)).alias("total_gb"),
        safe_ratio("total_bytes", "total_packets").alias("bytes_per_packet"),
    )


def row_count(features: DataFrame) -> DataFrame:
    """C14: number of feature rows."""
    return features.agg(F.count(F.lit(1)).alias("rows"))
