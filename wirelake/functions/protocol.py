"""Scalar column expressions over the packet table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wirelake.schema import PROTOCOLS  # noqa: F401  (re-exported for callers)

TCP_FLAG_MASK = 0x1FF  # the nine TCP flag bits, NS..FIN
SYN = 0x002


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(x: str | Column, n: str | Column) -> Column:
    """``x / n`` as double, 0.0 when ``n`` is 0."""
    x, n = col_(x), col_(n)
    return F.when(n > 0, x.cast("double") / n.cast("double")).otherwise(F.lit(0.0))


def is_pure_syn(flags: str | Column = "tcp_flags") -> Column:
    """Flags are exactly SYN (B2); SYN+ACK or SYN+ECE+CWR do not match. NULL flags give false."""
    return F.coalesce(col_(flags).bitwiseAND(F.lit(TCP_FLAG_MASK)) == F.lit(SYN), F.lit(False))


def protocol_label() -> Column:
    """One label per packet as the live stream assigns it.

    DNS wins over HTTP; otherwise, with IPv4, TCP before UDP before ICMP;
    anything else is OTHER (TCP over IPv6 included).
    """
    return (
        F.when(F.col("is_dns"), "DNS")
        .when(F.col("is_http"), "HTTP")
        .when(F.col("has_ip") & F.col("is_tcp"), "TCP")
        .when(F.col("has_ip") & F.col("is_udp"), "UDP")
        .when(F.col("has_ip") & F.col("is_icmp"), "ICMP")
        .otherwise("OTHER")
    )


def address_or_unknown(c: str | Column) -> Column:
    """The stream's default address without an IPv4 layer."""
    return F.coalesce(col_(c), F.lit("unknown"))


def flag_count(c: str | Column) -> Column:
    """Number of rows where a boolean column is true (never NULL)."""
    return F.count_if(F.coalesce(col_(c), F.lit(False)))
