"""Packet tables derived from the driver's parquet tables.

There are no captures among the test inputs, so two column mappings turn
``events`` (event time, every protocol) and ``lineitem`` (volume) into the
packet-table contract of ``wirelake.schema.PACKET_SCHEMA``. Both are plain
projections: Catalyst prunes the scan to the columns they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# Unique keys of the driver tables: hashing on them spreads rows evenly and
# deterministically (a retried task gets the same rows) without a sort.
TABLE_KEYS = {"events": ["event_id"], "lineitem": ["l_orderkey", "l_linenumber"]}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, TABLE_KEYS[name]) if spread_rows else df


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows hashed on a unique key over the cluster's cores (even, deterministic, no sort).

    For the small test tables only: a file stored as one row group is read by one task,
    and every step after it up to the first shuffle would run on one core. Large tables
    have enough splits and need no spreading, so it is a choice of the caller, never made
    by size. Filters and column pruning still reach the scan.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def packets_events(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """30 captures (one per day of month); ``error`` rows are the non-IPv4 packets. ``spread_rows``: see ``spread``."""
    return packets_from_events(read_table(spark, sf_dir, "events", spread_rows))


def packets_from_events(e: DataFrame) -> DataFrame:
    """The events mapping on any events DataFrame, static or streaming."""
    kind, eid = F.col("event_type"), F.col("event_id")
    has_ip = kind != "error"
    is_tcp = kind.isin("click", "view") | ((kind == "error") & (eid % 10 == 0))
    return e.select(
        eid.alias("packet_no"),
        F.concat(F.lit("cap_"), F.dayofmonth("ts").cast("string"), F.lit(".pcap")).alias("filename"),
        F.col("ts"),
        has_ip.alias("has_ip"),
        F.when(has_ip, F.concat(F.lit("10.0.0."), (F.col("user_id") % 200).cast("string"))).alias("src_ip"),
        F.when(has_ip, F.concat(F.lit("10.0.1."), (eid % 17).cast("string"))).alias("dst_ip"),
        is_tcp.alias("is_tcp"),
        (kind == "purchase").alias("is_udp"),
        (kind == "signup").alias("is_icmp"),
        (kind == "view").alias("is_http"),
        ((kind == "purchase") & (eid % 2 == 0)).alias("is_dns"),
        F.when((kind == "click") & (eid % 5 == 0), 2)
        .when((kind == "click") & (eid % 5 == 1), 18)
        .when(is_tcp, 24)
        .alias("tcp_flags"),
        (F.lit(60) + (eid * 37) % 1441).cast("int").alias("packet_size"),
    )


def packets_lineitem(spark: SparkSession, sf_dir: str, spread_rows: bool = False) -> DataFrame:
    """12 captures by supplier; the volume view for benchmarks (day-granular time)."""
    li = read_table(spark, sf_dir, "lineitem", spread_rows)
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    has_ip = ln < 7
    return li.select(
        (F.col("l_orderkey") * 10 + ln).alias("packet_no"),
        F.concat(F.lit("cap_"), (F.col("l_suppkey") % 12).cast("string"), F.lit(".pcap")).alias("filename"),
        F.col("l_shipdate").alias("ts"),
        has_ip.alias("has_ip"),
        F.when(has_ip, F.concat(F.lit("10.0.0."), (F.col("l_suppkey") % 200).cast("string"))).alias("src_ip"),
        F.when(has_ip, F.concat(F.lit("10.0.1."), (F.col("l_partkey") % 250).cast("string"))).alias("dst_ip"),
        (rf == "A").alias("is_tcp"),
        (rf == "N").alias("is_udp"),
        ((rf == "R") & has_ip).alias("is_icmp"),
        ((rf == "A") & (ls == "F")).alias("is_http"),
        ((rf == "N") & (ls == "O")).alias("is_dns"),
        F.when((rf == "A") & (F.col("l_quantity") < 10), 2).when(rf == "A", 24).alias("tcp_flags"),
        (F.col("l_quantity").cast("int") * 30).alias("packet_size"),
    )

