"""Sliding-window counters and running totals (F1-F8).

Every function here takes a DataFrame of packet records and works unchanged
on a static DataFrame (batch, used as the oracle) and on a streaming one.
Windows are event-time windows aligned on the epoch; the reference's default
is 20 s windows sliding by 5 s (four panes per window).

For streams, ``with_watermark`` bounds the state: windows older than the
watermark are finalised, emitted (append mode) and dropped from the state
store, and rows arriving later than the delay are ignored. ``run_bounded``
drives a query to the end of its input with an ``availableNow`` trigger and
a checkpoint in the shared folder, so a restarted job resumes where it left.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from wirelake.functions.timeconv import instant_to_ntz, to_instant
from wirelake.session import shared_dir

DEFAULT_INTERVAL_SECONDS = 5  # the reference's batch interval; window = 4 intervals


def default_window(interval_seconds: int = DEFAULT_INTERVAL_SECONDS) -> tuple[str, str]:
    return f"{4 * interval_seconds} seconds", f"{interval_seconds} seconds"


def _bool(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def with_watermark(records: DataFrame, time_col: str = "ts", delay: str = "1 minute",
                   out: str = "event_time") -> DataFrame:
    """Event time as ``TIMESTAMP`` plus a watermark (F6). NTZ input is read as UTC wall clock."""
    if isinstance(records.schema[time_col].dataType, T.TimestampNTZType):
        records = records.withColumn(out, to_instant(records, time_col))
    elif time_col != out:
        records = records.withColumn(out, F.col(time_col))
    return records.withWatermark(out, delay)


def _window_cols(time_col: str, length: str, slide: str):
    return F.window(time_col, length, slide).alias("w")


def _bounds(ntz: bool) -> list[Column]:
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = instant_to_ntz(start), instant_to_ntz(end)
    return [start.alias("window_start"), end.alias("window_end")]


def protocol_window_counts(records: DataFrame, length: str = "20 seconds", slide: str = "5 seconds",
                           time_col: str = "ts", ntz_out: bool = False) -> DataFrame:
    """packets (and bytes) per protocol label in each sliding window."""
    agg = records.groupBy(_window_cols(time_col, length, slide), "protocol").agg(
        F.count(F.lit(1)).alias("packets"),
        F.try_sum("packet_size").alias("bytes"),
    )
    return agg.select(*_bounds(ntz_out), "protocol", "packets", "bytes")


def window_totals(records: DataFrame, length: str = "20 seconds", slide: str = "5 seconds",
                  time_col: str = "ts", ntz_out: bool = False) -> DataFrame:
    """Bytes, packets and average packet size per sliding window, all protocols together."""
    agg = records.groupBy(_window_cols(time_col, length, slide)).agg(
        F.try_sum("packet_size").alias("bytes"),
        F.count(F.lit(1)).alias("packets"),
        F.avg("packet_size").alias("avg_packet_size"),
    )
    return agg.select(*_bounds(ntz_out), "bytes", "packets", "avg_packet_size")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def _whole_seconds(duration: str) -> int:
    number, unit = duration.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def protocol_pane_counts(records: DataFrame, length: str = "20 seconds", slide: str = "5 seconds", time_col: str = "ts") -> DataFrame:
    """F1 by panes, first step: packets and bytes per protocol in panes that don't overlap. A pane is as long as the
    greatest common divisor of length and slide (the slide, when it divides the length), so every window is a run of
    whole panes. A packet is one row here, where overlapping windows make ``length / slide`` rows of it."""
    pane = f"{math.gcd(_whole_seconds(length), _whole_seconds(slide))} seconds"
    return records.groupBy(F.window(time_col, pane).alias("pane"), "protocol").agg(F.count(F.lit(1)).alias("packets"), F.try_sum("packet_size").alias("bytes"))


def windows_of_panes(panes: DataFrame, length: str = "20 seconds", slide: str = "5 seconds", ntz_out: bool = False) -> DataFrame:
    """F1 by panes, second step: sliding windows from pane counts. On a stream (append mode) this is a second
    stateful aggregation over the first one's final panes; the state holds each packet's counts once per pane, and
    only open panes and windows of counts."""
    agg = panes.groupBy(F.window(F.window_time("pane"), length, slide).alias("w"), "protocol").agg(
        F.sum("packets").alias("packets"), F.try_sum("bytes").alias("bytes"))
    return agg.select(*_bounds(ntz_out), "protocol", "packets", "bytes")


def _total_bytes() -> Column:
    """Sum of sizes, 0 without packets, null where 64 bits don't hold it (a line may claim any size)."""
    return F.when(F.count("packet_size") == 0, F.lit(0).cast("long")).otherwise(F.try_sum("packet_size")).alias("total_bytes")


def label_counters(records: DataFrame) -> DataFrame:
    """Counters of a line stream, whose records carry only the protocol label: each packet counts once, under its
    label (a DNS-over-TCP packet as DNS only), so these are not ``running_counters`` and have other names."""
    label = F.col("protocol")
    return records.agg(
        F.count(F.lit(1)).alias("total_packets"),
        *[F.count_if(label == p).alias(f"label_{p.lower()}") for p in ("TCP", "UDP", "ICMP", "HTTP", "DNS")],
        _total_bytes(),
    )


def running_counters(records: DataFrame) -> DataFrame:
    """the live counters, from packet records. TCP, UDP and ICMP need IPv4 and exclude each other
    in that order; DNS and HTTP are counted apart, DNS winning over HTTP."""
    ip = _bool("has_ip")
    tcp = ip & _bool("is_tcp")
    udp = ip & ~_bool("is_tcp") & _bool("is_udp")
    icmp = ip & ~_bool("is_tcp") & ~_bool("is_udp") & _bool("is_icmp")
    return records.agg(
        F.count(F.lit(1)).alias("total_packets"),
        F.count_if(tcp).alias("tcp_packets"),
        F.count_if(udp).alias("udp_packets"),
        F.count_if(icmp).alias("icmp_packets"),
        F.count_if(~_bool("is_dns") & _bool("is_http")).alias("http_packets"),
        F.count_if(_bool("is_dns")).alias("dns_packets"),
        _total_bytes(),
    )


def run_bounded(result: DataFrame, name: str, output_mode: str = "append",
                sink: str | None = None, checkpoint: str | None = None,
                timeout_seconds: float | None = None,
                state_partitions: int | None = None,
                writer: Callable[[DataFrame, int], None] | None = None) -> tuple[str, StreamingQuery]:
    """Run a streaming query over all input available now, writing parquet.

    ``append`` adds finalised rows; ``complete`` rewrites the whole result
    every micro-batch (for bounded runs and small results). Returns the sink
    folder and the finished query. Writes are idempotent: a micro-batch that
    is replayed after a failure rewrites its own ``batch_id=`` folder
    (append) or the whole result (complete) instead of adding rows twice. ``state_partitions`` sizes the state store
    (fixed in the checkpoint at the first start); by default the session's
    shuffle partition count is used. ``writer`` takes the place of the Parquet writer (see ``streaming.log``).
    """
    spark = result.sparkSession
    sink = sink or shared_dir(spark, f"{name}-out")
    checkpoint = checkpoint or shared_dir(spark, f"{name}-chk")
    write = writer or batch_writer(sink, output_mode)

    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = (
            result.writeStream.queryName(name).outputMode(output_mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return sink, query


def start_stream(result: DataFrame, name: str, output_mode: str, sink: str, checkpoint: str, state_partitions: int | None = None,
                 interval_seconds: float = 0) -> StreamingQuery:
    """Start a query that runs until it is stopped (``stop_gracefully``), with ``run_bounded``'s sink; either goes on from
    the other's checkpoint."""
    spark = result.sparkSession
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return (result.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint)
                .foreachBatch(batch_writer(sink, output_mode)).trigger(processingTime=f"{interval_seconds} seconds").start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def batch_writer(sink: str, output_mode: str):
    """``foreachBatch`` function writing Parquet idempotently (see ``run_bounded``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(sink)
        else:
            batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return write


def stop_gracefully(query: StreamingQuery, timeout_seconds: float = 60.0) -> None:
    """F8: let the running micro-batch finish, then stop; after the timeout stop anyway."""
    deadline = time.monotonic() + timeout_seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
        time.sleep(0.05)
    query.stop()


def latest_windows(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """What an update-mode sink says now: every window and protocol with the counts of its last micro-batch,
    windows that are still open included."""
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    rows = reader.parquet(sink)
    keys = ["window_start", "window_end", "protocol"]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("packets", "bytes"), "batch_id").alias("now"))
    return last.select(*keys, "now.packets", "now.bytes")


def totals_of(counts: DataFrame) -> DataFrame:
    """F2-F4 from F1: a window's totals are the sums over its protocols."""
    rows = counts.groupBy("window_start", "window_end").agg(F.try_sum("bytes").alias("bytes"), F.sum("packets").alias("packets"))
    return rows.withColumn("avg_packet_size", F.col("bytes") / F.col("packets"))


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(sink)
    return df.drop("batch_id") if "batch_id" in df.columns else df


def ordered_files(rows: DataFrame, folder: str, fmt: str, files: int, late: Column | None = None, time_col: str = "ts") -> str:
    """Write ``rows`` once, as ``files`` files in time order below ``folder`` (rows marked ``late`` in one more), with
    modification times in that order, so that a stream over the returned path with one file per trigger runs that
    many micro-batches. The time column is written only where ``fmt`` holds columns."""
    low, high = rows.agg(F.min(time_col), F.max(time_col)).first()
    part = F.lit(0)
    if low is not None:
        step = (high - low) / files
        for k in range(1, files):
            part = part + (F.col(time_col) >= F.lit(low + k * step)).cast("int")
    if late is not None:
        part = F.when(late, F.lit(files)).otherwise(part)
    rows = rows.withColumn("part", part)
    rows = rows.drop(time_col) if fmt == "text" else rows
    if low is None:
        rows.drop("part").coalesce(1).write.format(fmt).save(f"{folder}/part=0")
    else:
        rows.repartition(files + 1, "part").write.partitionBy("part").format(fmt).save(folder)
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    began = int(time.time() * 1000) - 3_600_000
    for k in range(files + 1):
        place = path(f"{folder}/part={k}")
        for status in fs.listStatus(place) if fs.exists(place) else []:
            fs.setTimes(status.getPath(), began + 1000 * k, -1)
    return f"{folder}/part=*"


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, max_files_per_trigger: int = 1) -> DataFrame:
    """A folder of event files as a stream (the stand-in for live capture)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(folder)
