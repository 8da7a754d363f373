"""The text report as DataFrame rows.

Each capture becomes a block of formatted lines (``format_string`` +
``posexplode``), the clustering section is one more block, and the report is
written with ``write.text`` after a distributed sort on
(section, capture order, line number); nothing goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed texts of the report layout.
TITLE = "=== Network Traffic Analysis Report ==="
CLUSTER_TITLE = "=== Clustering Results ==="
SEPARATOR = "---"


def _fmt(fmt: str, *cols) -> Column:
    return F.format_string(fmt, *[F.col(c) if isinstance(c, str) else c for c in cols])


def _capture_block() -> Column:
    # Fixed texts of the report layout.
    return F.array(
        _fmt("File: %s", "filename"),
        _fmt("Total Packets: %d", "packet_count"),
        _fmt("Total Bytes: %.2f", F.col("total_bytes").cast("double")),
        _fmt("Unique Source IPs: %d", "unique_src_ips"),
        _fmt("Unique Destination IPs: %d", "unique_dst_ips"),
        F.lit(""),
        F.lit("Protocol Distribution:"),
        _fmt("  - TCP: %d packets", "tcp_packet_count"),
        _fmt("  - UDP: %d packets", "udp_packet_count"),
        _fmt("  - ICMP: %d packets", "icmp_packet_count"),
        _fmt("  - HTTP: %d packets", "http_packet_count"),
        _fmt("  - DNS: %d packets", "dns_packet_count"),
        F.lit(""),
        _fmt("Protocol Diversity: %.2f", "protocol_diversity"),
        _fmt("Connection Density: %.4f", "connection_density"),
        F.lit(""),
        F.lit(SEPARATOR),
        F.lit(""),
    )


def report_lines(features: DataFrame, silhouette: DataFrame, order_col: str | None = None) -> DataFrame:
    """Rows (section, capture_order, line_no, value); ``silhouette`` is a one-row DataFrame."""
    order_col = order_col or ("capture_index" if "capture_index" in features.columns else "filename")
    none = F.lit(None).cast(features.schema[order_col].dataType)
    blocks = features.select(
        F.lit(1).alias("section"), F.col(order_col).alias("capture_order"),
        F.posexplode(_capture_block()).alias("line_no", "value"),
    )
    head = features.sparkSession.range(1).select(
        F.lit(0).alias("section"), none.alias("capture_order"),
        F.posexplode(F.array(F.lit(TITLE), F.lit(""))).alias("line_no", "value"))
    score = F.when(F.col("silhouette").isNull(), F.lit("Silhouette Score: n/a")).otherwise(
        F.format_string("Silhouette Score: %.4f", F.col("silhouette")))
    tail = silhouette.select(
        F.lit(2).alias("section"), none.alias("capture_order"),
        F.posexplode(F.array(F.lit(CLUSTER_TITLE), F.lit(""), score)).alias("line_no", "value"))
    return head.unionByName(blocks).unionByName(tail)


def write_report(lines: DataFrame, path: str) -> None:
    """Write the report as text, lines in report order across the output parts."""
    lines.orderBy("section", "capture_order", "line_no").select("value").write.mode("overwrite").text(path)
