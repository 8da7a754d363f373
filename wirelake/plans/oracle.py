"""DuckDB-runnable SQL for every catalog entry that has an SQL equivalent.

Each text inlines the packet view it reads as a CTE, because the oracle only
sees the driver's base tables. Computed columns carry the same names as the
Spark results.
"""

from __future__ import annotations

PACKETS_EVENTS = """
SELECT event_id AS packet_no,
       CONCAT('cap_', CAST(EXTRACT(DAY FROM ts) AS STRING), '.pcap') AS filename,
       ts,
       event_type <> 'error' AS has_ip,
       CASE WHEN event_type <> 'error' THEN CONCAT('10.0.0.', CAST(user_id % 200 AS STRING)) END AS src_ip,
       CASE WHEN event_type <> 'error' THEN CONCAT('10.0.1.', CAST(event_id % 17 AS STRING)) END AS dst_ip,
       event_type IN ('click', 'view') OR (event_type = 'error' AND event_id % 10 = 0) AS is_tcp,
       event_type = 'purchase' AS is_udp,
       event_type = 'signup' AS is_icmp,
       event_type = 'view' AS is_http,
       event_type = 'purchase' AND event_id % 2 = 0 AS is_dns,
       CASE WHEN event_type = 'click' AND event_id % 5 = 0 THEN 2
            WHEN event_type = 'click' AND event_id % 5 = 1 THEN 18
            WHEN event_type IN ('click', 'view') OR (event_type = 'error' AND event_id % 10 = 0) THEN 24
       END AS tcp_flags,
       CAST(60 + (event_id * 37) % 1441 AS INT) AS packet_size
FROM events"""

PACKETS_LINEITEM = """
SELECT l_orderkey * 10 + l_linenumber AS packet_no,
       CONCAT('cap_', CAST(l_suppkey % 12 AS STRING), '.pcap') AS filename,
       l_shipdate AS ts,
       l_linenumber < 7 AS has_ip,
       CASE WHEN l_linenumber < 7 THEN CONCAT('10.0.0.', CAST(l_suppkey % 200 AS STRING)) END AS src_ip,
       CASE WHEN l_linenumber < 7 THEN CONCAT('10.0.1.', CAST(l_partkey % 250 AS STRING)) END AS dst_ip,
       l_returnflag = 'A' AS is_tcp,
       l_returnflag = 'N' AS is_udp,
       l_returnflag = 'R' AND l_linenumber < 7 AS is_icmp,
       l_returnflag = 'A' AND l_linestatus = 'F' AS is_http,
       l_returnflag = 'N' AND l_linestatus = 'O' AS is_dns,
       CASE WHEN l_returnflag = 'A' AND l_quantity < 10 THEN 2 WHEN l_returnflag = 'A' THEN 24 END AS tcp_flags,
       CAST(l_quantity AS INT) * 30 AS packet_size
FROM lineitem"""

FEATURES_AGG = """
SELECT filename,
       COUNT(*) AS packet_count,
       CAST(SUM(packet_size) AS BIGINT) AS total_bytes,
       COUNT(DISTINCT src_ip) AS unique_src_ips,
       COUNT(DISTINCT dst_ip) AS unique_dst_ips,
       CAST(SUM(CASE WHEN is_tcp  THEN 1 ELSE 0 END) AS BIGINT) AS tcp_packet_count,
       CAST(SUM(CASE WHEN is_udp  THEN 1 ELSE 0 END) AS BIGINT) AS udp_packet_count,
       CAST(SUM(CASE WHEN is_icmp THEN 1 ELSE 0 END) AS BIGINT) AS icmp_packet_count,
       CAST(SUM(CASE WHEN is_http THEN 1 ELSE 0 END) AS BIGINT) AS http_packet_count,
       CAST(SUM(CASE WHEN is_dns  THEN 1 ELSE 0 END) AS BIGINT) AS dns_packet_count,
       CAST(MAX(CASE WHEN is_tcp  THEN 1 ELSE 0 END) + MAX(CASE WHEN is_udp  THEN 1 ELSE 0 END)
          + MAX(CASE WHEN is_icmp THEN 1 ELSE 0 END) + MAX(CASE WHEN is_http THEN 1 ELSE 0 END)
          + MAX(CASE WHEN is_dns  THEN 1 ELSE 0 END) AS BIGINT) AS protocol_types,
       COUNT(DISTINCT CASE WHEN has_ip THEN CONCAT(src_ip, '>', dst_ip) END) AS connections,
       CAST(SUM(CASE WHEN tcp_flags = 2 THEN 1 ELSE 0 END) AS BIGINT) AS syn_packets
FROM packets GROUP BY filename"""

FEATURES_SELECT = """
SELECT filename, packet_count, total_bytes, unique_src_ips, unique_dst_ips, tcp_packet_count,
       udp_packet_count, icmp_packet_count, http_packet_count, dns_packet_count,
       CAST(total_bytes AS DOUBLE) / packet_count AS avg_packet_size,
       CAST(protocol_types AS DOUBLE) / CAST(5.0 AS DOUBLE) AS protocol_diversity,
       CAST(connections AS DOUBLE) / packet_count AS connection_density,
       CAST(syn_packets AS DOUBLE) / packet_count AS syn_flood_indicator
FROM agg"""

PROTOCOL_CASE = """CASE WHEN is_dns THEN 'DNS' WHEN is_http THEN 'HTTP' WHEN has_ip AND is_tcp THEN 'TCP'
                        WHEN has_ip AND is_udp THEN 'UDP' WHEN has_ip AND is_icmp THEN 'ICMP' ELSE 'OTHER' END"""


def with_ctes(final: str, *ctes: tuple[str, str]) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def packets_cte(view: str = "events", where: str | None = None) -> tuple[str, str]:
    sql = PACKETS_EVENTS if view == "events" else PACKETS_LINEITEM
    if where:
        sql = f"SELECT * FROM ({sql}) p WHERE {where}"
    return ("packets", sql)


def features_sql(view: str = "events", where: str | None = None, final: str | None = None,
                 extra: tuple[tuple[str, str], ...] = ()) -> str:
    """Features over a packet view, then ``final`` over a CTE named ``features``."""
    ctes = [packets_cte(view, where), ("agg", FEATURES_AGG), ("features", FEATURES_SELECT), *extra]
    return with_ctes(final or "SELECT * FROM features", *ctes)


UNPIVOT_COUNTS = """
SELECT filename, packet_count, 'TCP' AS protocol, tcp_packet_count AS count, 1 AS pos FROM features
UNION ALL SELECT filename, packet_count, 'UDP', udp_packet_count, 2 FROM features
UNION ALL SELECT filename, packet_count, 'ICMP', icmp_packet_count, 3 FROM features
UNION ALL SELECT filename, packet_count, 'HTTP', http_packet_count, 4 FROM features
UNION ALL SELECT filename, packet_count, 'DNS', dns_packet_count, 5 FROM features"""

LONG = ("long", UNPIVOT_COUNTS)

PERCENT = "CASE WHEN packet_count > 0 THEN CAST(count AS DOUBLE) / CAST(packet_count AS DOUBLE) ELSE 0.0 END * 100.0"

TOTALS = ("totals", "SELECT protocol, CAST(SUM(count) AS BIGINT) AS packets FROM long GROUP BY protocol")


def panels() -> dict[str, str]:
    f = features_sql
    return {
        "packets_by_capture": f(final="SELECT filename, packet_count FROM features"),
        "protocol_totals": f(final="SELECT protocol, packets FROM totals", extra=(LONG, TOTALS)),
        "protocol_share": f(
            final="SELECT protocol, packets, CASE WHEN SUM(packets) OVER () > 0 THEN "
                  "CAST(packets AS DOUBLE) / CAST(SUM(packets) OVER () AS DOUBLE) ELSE 0.0 END AS share FROM totals",
            extra=(LONG, TOTALS)),
        "endpoints_long": f(final="SELECT filename, 'Source IPs' AS endpoint, unique_src_ips AS addresses FROM features "
                                  "UNION ALL SELECT filename, 'Destination IPs', unique_dst_ips FROM features"),
        "avg_size_by_capture": f(final="SELECT filename, avg_packet_size FROM features"),
        "traffic_by_protocol": f(final="SELECT filename, protocol, count AS packets FROM long", extra=(LONG,)),
        "protocol_long": f(final=f"SELECT filename, protocol, count, {PERCENT} AS percentage FROM long",
                           extra=(LONG,)),
        "protocol_count_by_capture": f(final="SELECT filename, protocol, count FROM long", extra=(LONG,)),
        "protocol_percentage": f(final=f"SELECT filename, protocol, {PERCENT} AS percentage FROM long",
                                 extra=(LONG,)),
        "protocol_comparison": f(final="SELECT protocol, CAST(SUM(count) AS BIGINT) AS total_count FROM long "
                                       "GROUP BY protocol", extra=(LONG,)),
        "protocol_trend": f(final="SELECT filename, protocol, count FROM long ORDER BY filename, pos",
                            extra=(LONG,)),
        "summary": f(final="SELECT COUNT(*) AS files, CAST(COALESCE(SUM(packet_count), 0) AS BIGINT) AS total_packets, "
                           "CAST(COALESCE(SUM(total_bytes), 0) AS BIGINT) AS total_bytes, "
                           "CAST(COALESCE(SUM(total_bytes), 0) AS DOUBLE) / 1e9 AS total_gb, "
                           "CASE WHEN COALESCE(SUM(packet_count), 0) > 0 THEN CAST(SUM(total_bytes) AS DOUBLE) "
                           "/ CAST(SUM(packet_count) AS DOUBLE) ELSE 0.0 END AS bytes_per_packet FROM features"),
        "row_count": f(final="SELECT COUNT(*) AS rows FROM features"),
        "report_columns": f(final="SELECT filename, packet_count, total_bytes, unique_src_ips, unique_dst_ips, "
                                  "tcp_packet_count, udp_packet_count, icmp_packet_count, http_packet_count, "
                                  "dns_packet_count, protocol_diversity, connection_density FROM features"),
        "sql_view": f(),
    }


# Length of the fixture encoding of each packet (see headers.encode_frames):
# Ethernet 14, a VLAN tag 4 on UDP over IPv4, IPv4 20 (24 with the option
# word on ICMP), IPv6 40, TCP 20, UDP and ICMP 8, payload 16 on HTTP and DNS,
# ARP frames 42. Capture records are padded up to packet_size.
FRAME_LEN = """CASE WHEN has_ip THEN 14 + CASE WHEN is_udp AND NOT is_tcp THEN 4 ELSE 0 END
                         + CASE WHEN is_icmp THEN 24 ELSE 20 END
                         + CASE WHEN is_tcp THEN 20 WHEN is_udp OR is_icmp THEN 8 ELSE 0 END
                         + CASE WHEN is_http OR is_dns THEN 16 ELSE 0 END
                    WHEN is_tcp OR is_udp THEN 54 + CASE WHEN is_tcp THEN 20 ELSE 8 END
                         + CASE WHEN is_http OR is_dns THEN 16 ELSE 0 END
                    ELSE 42 END"""


PADDED = ("packets", f"SELECT * REPLACE (GREATEST(packet_size, {FRAME_LEN}) AS packet_size) FROM ({PACKETS_EVENTS}) p")


def roundtrip_sql(view: str = "events") -> str:
    source = PACKETS_EVENTS if view == "events" else PACKETS_LINEITEM
    padded = ("packets", f"SELECT * REPLACE (GREATEST(packet_size, {FRAME_LEN}) AS packet_size) "
                         f"FROM ({source}) p")
    ctes = [padded, ("agg", FEATURES_AGG), ("features", FEATURES_SELECT)]
    return with_ctes("SELECT * FROM features", *ctes)


def feature_queries() -> dict[str, str]:
    return {
        "capture_roundtrip": roundtrip_sql("events"),
        "capture_source": roundtrip_sql("events"),
        "capture_labels": features_sql(final="SELECT filename AS capture, 'part-00000.pcap' AS filename, packet_count FROM features"),
        "feature_store": roundtrip_sql("events"),
        "packets_bucketed": roundtrip_sql("events"),
        "capture_roundtrip_volume": roundtrip_sql("lineitem"),
        "capture_roundtrip_gzip": roundtrip_sql("events"),
        "features_captures": roundtrip_sql("events").removesuffix("SELECT * FROM features") +
            "SELECT filename AS capture, false AS again, * EXCLUDE (filename) FROM features UNION ALL "
            "SELECT filename, true, * EXCLUDE (filename) FROM features WHERE filename = (SELECT MIN(filename) FROM features)",
        "capture_status": with_ctes("SELECT 'ok' AS status, COUNT(DISTINCT filename) + 1 AS captures FROM packets "  # and the cut one
                                    "UNION ALL SELECT unnest(['bad_header', 'missing', 'unreadable', 'framing_error']), 1", packets_cte("events")),
        "feature_schema": features_sql("events"),
        "features_approx": features_sql(final="SELECT filename, true AS unique_src_ips_near, true AS unique_dst_ips_near, "
                                              "true AS connections_near FROM features"),
        "sketches_merged": features_sql(final="SELECT filename, true AS unique_src_ips_near, true AS unique_dst_ips_near FROM features"),
        "features": features_sql("events"),
        "features_volume": features_sql("lineitem"),
        "features_tcp_only": features_sql("events", where="is_tcp"),
        "features_merged_edges": features_sql("events"),
        "syn_packets": with_ctes(
            "SELECT filename, CAST(SUM(CASE WHEN tcp_flags = 2 THEN 1 ELSE 0 END) AS BIGINT) AS syn_packets, "
            "CAST(SUM(CASE WHEN tcp_flags = 18 THEN 1 ELSE 0 END) AS BIGINT) AS syn_ack_packets "
            "FROM packets WHERE is_tcp GROUP BY filename",
            packets_cte("events")),
        "protocol_label": with_ctes(f"SELECT packet_no, {PROTOCOL_CASE} AS protocol FROM packets",
                                    packets_cte("events")),
        "unknown_addresses": with_ctes(
            "SELECT packet_no, COALESCE(src_ip, 'unknown') AS src_ip, COALESCE(dst_ip, 'unknown') AS dst_ip "
            "FROM packets", packets_cte("events")),
    }


CONTRACT_COLS = ("packet_no, has_ip, src_ip, dst_ip, is_tcp, is_udp, is_icmp, is_http, is_dns, "
                 "tcp_flags, packet_size")

RECORDS = ("rec", f"""
SELECT ts, {PROTOCOL_CASE} AS protocol, COALESCE(src_ip, 'unknown') AS src_ip,
       COALESCE(dst_ip, 'unknown') AS dst_ip, packet_size, has_ip, is_tcp, is_udp, is_icmp, is_http, is_dns,
       printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000) AS secs
FROM packets""")

LINES = ("lines", """
SELECT concat_ws(',', secs, protocol, src_ip, dst_ip, CAST(packet_size AS VARCHAR)) AS value FROM rec
UNION ALL SELECT concat_ws(',', secs, protocol, src_ip, dst_ip) FROM rec WHERE NOT has_ip
UNION ALL SELECT concat_ws(',', secs, protocol, src_ip, dst_ip, CAST(packet_size AS VARCHAR) || '.5')
FROM rec WHERE is_udp
UNION ALL SELECT concat_ws(',', t, protocol, src_ip, dst_ip, CAST(packet_size AS VARCHAR))
FROM (SELECT *, unnest([replace(secs, '.', '') || '000', '1e14', '1e300', '1e400']) AS t FROM rec WHERE is_tcp)""")

PARSED = ("parsed", r"""
SELECT len(p) AS n, regexp_replace(p[1], '^\s+|\s+$', '', 'g') AS t, p[2] AS protocol, p[3] AS src_ip,
       p[4] AS dst_ip, regexp_replace(p[5], '^\s+|\s+$', '', 'g') AS s
FROM (SELECT string_split(value, ',') AS p FROM lines)""")

LINE_PARSE_FINAL = r"""
SELECT TRY_CAST(t AS DOUBLE) AS timestamp, protocol, src_ip, dst_ip, TRY_CAST(s AS BIGINT) AS packet_size
FROM parsed
WHERE n = 5 AND regexp_full_match(t, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')
  AND coalesce(TRY_CAST(t AS DOUBLE) BETWEEN -62135596800 AND 253402300799.999999, false)
  AND regexp_full_match(s, '[+-]?[0-9]+') AND TRY_CAST(s AS BIGINT) IS NOT NULL"""

# Each row falls into four sliding windows (4 h long, 1 h slide) that start
# on the hour at k = 0..3 hours before its own hour.
WINDOWED = ("windowed", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) + INTERVAL 4 HOUR AS window_end,
       protocol, packet_size
FROM rec, (VALUES (0), (1), (2), (3)) v(k)""")

WIN_PROTOCOL = """
SELECT window_start, window_end, protocol, COUNT(*) AS packets, CAST(SUM(packet_size) AS BIGINT) AS bytes
FROM windowed GROUP BY window_start, window_end, protocol"""

WIN_TOTALS = ("totals_w", """
SELECT window_start, window_end, CAST(SUM(packet_size) AS BIGINT) AS bytes, COUNT(*) AS packets,
       AVG(packet_size) AS avg_packet_size
FROM windowed GROUP BY window_start, window_end""")

COUNTERS = """
SELECT COUNT(*) AS total_packets,
       COUNT(*) FILTER (WHERE has_ip AND is_tcp) AS tcp_packets,
       COUNT(*) FILTER (WHERE has_ip AND NOT is_tcp AND is_udp) AS udp_packets,
       COUNT(*) FILTER (WHERE has_ip AND NOT is_tcp AND NOT is_udp AND is_icmp) AS icmp_packets,
       COUNT(*) FILTER (WHERE NOT is_dns AND is_http) AS http_packets,
       COUNT(*) FILTER (WHERE is_dns) AS dns_packets,
       CAST(COALESCE(SUM(packet_size), 0) AS BIGINT) AS total_bytes
FROM rec"""


# packet_no % 8: 0 plain, 1 GRE, 2 VXLAN, 3 MPLS, 4 PPPoE, 5 IP in IP, 6 MPLS(GRE(PPPoE)), 7 IP(VXLAN(MPLS)); frames without
# IP or a transport (ARP) go into GRE where they can't stand directly under another. The outermost IPv4 addresses count.
TUNNELLED = """
SELECT packet_no, has_ip OR outer_ip AS has_ip, CASE WHEN outer_ip THEN '192.0.2.1' ELSE src_ip END AS src_ip,
       CASE WHEN outer_ip THEN '192.0.2.2' ELSE dst_ip END AS dst_ip, is_tcp,
       is_udp OR kind = 2 OR (kind = 7 AND NOT arp) AS is_udp, is_icmp, is_http, is_dns, tcp_flags, packet_size
FROM (SELECT *, kind IN (1, 2, 5, 6, 7) OR (kind IN (3, 4) AND arp) AS outer_ip
      FROM (SELECT *, packet_no % 8 AS kind, NOT has_ip AND NOT is_tcp AND NOT is_udp AS arp FROM packets))"""

THETAS_COMMON = """
SELECT n.filename, n.next_filename,
       (SELECT COUNT(*) FROM (SELECT src_ip FROM packets p WHERE has_ip AND p.filename = n.filename INTERSECT
                              SELECT src_ip FROM packets p WHERE has_ip AND p.filename = n.next_filename)) AS common_src,
       (SELECT COUNT(*) FROM (SELECT dst_ip FROM packets p WHERE has_ip AND p.filename = n.filename INTERSECT
                              SELECT dst_ip FROM packets p WHERE has_ip AND p.filename = n.next_filename)) AS common_dst,
       (SELECT COUNT(*) FROM (SELECT src_ip, dst_ip FROM packets p WHERE has_ip AND p.filename = n.filename INTERSECT
                              SELECT src_ip, dst_ip FROM packets p WHERE has_ip AND p.filename = n.next_filename)) AS common_connections
FROM (SELECT filename, LEAD(filename) OVER (ORDER BY filename) AS next_filename FROM (SELECT DISTINCT filename FROM packets)) n
WHERE n.next_filename IS NOT NULL"""


def stream_queries() -> dict[str, str]:
    p = packets_cte("events")
    win_counts = with_ctes(WIN_PROTOCOL, p, RECORDS, WINDOWED)
    counters = with_ctes(COUNTERS, p, RECORDS)

    def totals(metric: str) -> str:
        return with_ctes(f"SELECT window_start, window_end, {metric} FROM totals_w", p, RECORDS, WINDOWED,
                         WIN_TOTALS)

    labels = ", ".join(f"COUNT(*) FILTER (WHERE protocol = '{p_}') AS label_{p_.lower()}" for p_ in ("TCP", "UDP", "ICMP", "HTTP", "DNS"))
    label_counters = with_ctes(f"SELECT COUNT(*) AS total_packets, {labels}, CAST(COALESCE(SUM(packet_size), 0) AS BIGINT) AS total_bytes FROM rec",
                               p, RECORDS)
    on_time = ("packets", f"SELECT * FROM ({PACKETS_EVENTS}) p WHERE NOT (packet_no % 10 = 0 AND ts < "
                          "(SELECT MIN(ts) + (MAX(ts) - MIN(ts)) / 2 FROM events))")
    return {
        "label_counters": label_counters,
        "stream_label_counters": label_counters,
        "stream_late_rows": with_ctes(
            "SELECT * FROM wc WHERE window_end <= (SELECT MAX(ts) FROM rec) - INTERVAL 2 HOUR",
            on_time, RECORDS, WINDOWED, ("wc", WIN_PROTOCOL)),
        "header_decode_tunnels": with_ctes(TUNNELLED, p),
        "stream_compacted": win_counts,
        "stream_stopped": win_counts,
        "stream_late_counts": with_ctes(
            "SELECT window_start, window_end, protocol, COUNT(*) AS dropped FROM windowed "
            "WHERE window_end <= (SELECT MAX(ts) FROM (" + PACKETS_EVENTS + ") e) - INTERVAL 2 HOUR "
            "GROUP BY window_start, window_end, protocol",
            ("packets", f"SELECT * FROM ({PACKETS_EVENTS}) p WHERE packet_no % 10 = 0 AND ts < "
                        "(SELECT MIN(ts) + (MAX(ts) - MIN(ts)) / 2 FROM events)"), RECORDS, WINDOWED),
        "stream_capture_windows": with_ctes(WIN_PROTOCOL, PADDED, RECORDS, WINDOWED),
        "win_pane_counts": win_counts,
        "stream_pane_counts": with_ctes(
            "SELECT * FROM wc WHERE window_end <= (SELECT MAX(ts) FROM rec) - INTERVAL 2 HOUR",
            p, RECORDS, WINDOWED, ("wc", WIN_PROTOCOL)),
        "thetas_common": with_ctes(THETAS_COMMON, p),
        "bitmaps_merged": with_ctes("SELECT filename, COUNT(DISTINCT src_ip) AS unique_src_ips, COUNT(DISTINCT dst_ip) AS unique_dst_ips "
                                    "FROM packets WHERE has_ip GROUP BY filename", p),
        "thetas_merged": with_ctes("SELECT DISTINCT filename, true AS unique_src_ips_near, true AS unique_dst_ips_near, true AS connections_near "
                                   "FROM packets WHERE has_ip", p),
        "header_decode": with_ctes(f"SELECT {CONTRACT_COLS} FROM packets", p),
        "header_decode_volume": with_ctes(f"SELECT {CONTRACT_COLS} FROM packets", packets_cte("lineitem")),
        "line_format": with_ctes(
            "SELECT concat_ws(',', secs, protocol, src_ip, dst_ip, CAST(packet_size AS VARCHAR)) AS value FROM rec",
            p, RECORDS),
        "line_parse": with_ctes(LINE_PARSE_FINAL, p, RECORDS, LINES, PARSED),
        "win_protocol_counts": win_counts,
        "win_bytes": totals("bytes"),
        "win_avg_size": totals("avg_packet_size"),
        "win_packet_count": totals("packets"),
        "running_counters": counters,
        "stream_win_protocol_counts": win_counts,
        "stream_running_counters": counters,
        "stream_win_totals": with_ctes("SELECT window_start, window_end, bytes, packets, avg_packet_size FROM totals_w",
                                       p, RECORDS, WINDOWED, WIN_TOTALS),
        "stream_line_windows": win_counts,
        "stream_win_append": with_ctes(
            "SELECT * FROM wc WHERE window_end <= (SELECT MAX(ts) FROM rec) - INTERVAL 2 HOUR",
            p, RECORDS, WINDOWED, ("wc", WIN_PROTOCOL)),
    }


_FC = ["packet_count", "total_bytes", "unique_src_ips", "unique_dst_ips", "tcp_packet_count", "udp_packet_count",
       "icmp_packet_count", "http_packet_count", "dns_packet_count", "avg_packet_size", "protocol_diversity",
       "connection_density", "syn_flood_indicator"]


def _dist(alias: str) -> str:
    return " + ".join(f"(CAST(f.{c} AS DOUBLE) - CAST({alias}.{c} AS DOUBLE)) * "
                      f"(CAST(f.{c} AS DOUBLE) - CAST({alias}.{c} AS DOUBLE))" for c in _FC)


def _labels_ctes() -> tuple[tuple[str, str], ...]:
    return (
        ("c0", "SELECT * FROM features ORDER BY packet_count ASC, filename ASC LIMIT 1"),
        ("c1", "SELECT * FROM features ORDER BY packet_count DESC, filename ASC LIMIT 1"),
        ("labelled", f"SELECT f.*, CASE WHEN {_dist('c0')} <= {_dist('c1')} THEN 0 ELSE 1 END AS prediction "
                     "FROM features f, c0, c1"),
    )


def _silhouette_sql() -> str:
    norm = " + ".join(f"CAST({c} AS DOUBLE) * CAST({c} AS DOUBLE)" for c in _FC)
    sums = ", ".join(f"SUM(CAST({c} AS DOUBLE)) AS s_{c}" for c in _FC)
    dot = " + ".join(f"CAST(p.{c} AS DOUBLE) * s.s_{c}" for c in _FC)
    return (
        "WITH " + ", ".join(f"{n} AS ({q})" for n, q in [
            packets_cte("events"), ("agg", FEATURES_AGG), ("features", FEATURES_SELECT), *_labels_ctes(),
            ("pts", f"SELECT *, {norm} AS norm2 FROM labelled"),
            ("stats", f"SELECT prediction, COUNT(*) AS n, SUM(norm2) AS q, {sums} FROM pts GROUP BY prediction"),
            ("d", f"SELECT p.filename, p.prediction AS own, s.prediction AS c, s.n, "
                  f"p.norm2 + s.q / s.n - 2.0 * ({dot}) / s.n AS dist FROM pts p, stats s"),
            ("ab", "SELECT filename, MAX(CASE WHEN c = own THEN n END) AS own_n, "
                   "MAX(CASE WHEN c = own AND n > 1 THEN dist * n / (n - 1.0) END) AS a, "
                   "MIN(CASE WHEN c <> own THEN dist END) AS b FROM d GROUP BY filename"),
            ("k", "SELECT COUNT(*) AS clusters FROM stats"),
        ])
        + "\nSELECT CASE WHEN (SELECT clusters FROM k) < 2 THEN NULL ELSE ROUND(AVG(CASE WHEN own_n = 1 THEN 0.0 "
          "WHEN a < b THEN 1.0 - a / b WHEN a > b THEN b / a - 1.0 ELSE 0.0 END), 8) END AS silhouette FROM ab"
    )


def _report_sql() -> str:
    lines = ["printf('File: %s', filename)", "printf('Total Packets: %d', packet_count)", "printf('Total Bytes: %.2f', CAST(total_bytes AS DOUBLE))",
             "printf('Unique Source IPs: %d', unique_src_ips)", "printf('Unique Destination IPs: %d', unique_dst_ips)", "''",
             "'Protocol Distribution:'", *[f"printf('  - {p}: %d packets', {p.lower()}_packet_count)" for p in ("TCP", "UDP", "ICMP", "HTTP", "DNS")], "''",
             "printf('Protocol Diversity: %.2f', protocol_diversity)", "printf('Connection Density: %.4f', connection_density)", "''", "'---'", "''"]
    block = f"SELECT 1 AS section, filename AS capture_order, unnest(range({len(lines)})) AS line_no, unnest([{', '.join(lines)}]) AS value FROM features"
    score = "CASE WHEN silhouette IS NULL THEN 'Silhouette Score: n/a' ELSE printf('Silhouette Score: %.4f', silhouette) END"
    return (f"WITH score AS ({_silhouette_sql()}), {features_sql(final=block).removeprefix('WITH ')} "
            "UNION ALL SELECT 0, NULL, unnest(range(2)), unnest(['=== Network Traffic Analysis Report ===', '']) "
            f"UNION ALL SELECT 2, NULL, unnest(range(3)), unnest(['=== Clustering Results ===', '', {score}]) FROM score")


def cluster_queries() -> dict[str, str]:
    distinct_cols = ", ".join(_FC)
    k = f"LEAST(LEAST(3, GREATEST(2, (SELECT COUNT(*) FROM features) // 2)), (SELECT COUNT(*) FROM (SELECT DISTINCT {distinct_cols} FROM features)))"
    return {
        "assemble": features_sql(final="SELECT filename, 13 AS entries, CAST(packet_count AS DOUBLE) AS first_entry, "
                                       "syn_flood_indicator AS last_entry FROM features"),
        "kmeans_fit": features_sql(final=f"SELECT filename, CAST({k} AS BIGINT) AS k, true AS nearest FROM features"),
        "kmeans_saved": features_sql(final=(
            "SELECT filename, CAST((SELECT LEAST(LEAST(3, GREATEST(2, COUNT(*) // 2)), COUNT(DISTINCT (" + distinct_cols + "))) FROM "
            "(SELECT *, NTILE(2) OVER (ORDER BY filename) AS turn FROM features) WHERE turn = 1) AS BIGINT) AS k, "
            "true AS nearest, true AS same_number FROM features")),
        "cluster_scatter": features_sql(final="SELECT filename, packet_count, total_bytes, prediction FROM labelled", extra=_labels_ctes()),
        "report_lines": _report_sql(),
        "choose_k": features_sql(final=(
            "SELECT rows, distinct_vectors, CAST(LEAST(LEAST(3, GREATEST(2, rows // 2)), distinct_vectors) AS BIGINT)"
            " AS k FROM (SELECT (SELECT COUNT(*) FROM features) AS rows, "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT {distinct_cols} FROM features)) AS distinct_vectors)")),
        "assign_fixed_centres": features_sql(final="SELECT filename, prediction FROM labelled",
                                             extra=_labels_ctes()),
        "silhouette_fixed_labels": _silhouette_sql(),
    }


def all_oracles() -> dict[str, str]:
    out = {}
    for group in (feature_queries, panels, stream_queries, cluster_queries):
        out.update(group())
    return out
