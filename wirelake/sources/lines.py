"""Text line records: ``timestamp,protocol,src_ip,dst_ip,packet_size``.

The live stream carries one CSV line per packet. ``format_lines`` writes
them from packet records, ``parse_lines`` reads them back with native
expressions (no Python per row), and ``read_line_stream`` is the streaming
source for a folder of text files; any other streaming DataFrame with a
``value`` column (socket, Kafka) works the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.functions.protocol import address_or_unknown, protocol_label
from wirelake.functions.timeconv import epoch_micros, seconds_text

# Fixed formats: Python's float() and int() accept surrounding whitespace and
# these number shapes; non-finite times are rejected (no event time).
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INT_TEXT = r"^[+-]?[0-9]+$"
EDGE_SPACE = r"^\s+|\s+$"
# Event times are those of the years 1 to 9999, the range in which a TIMESTAMP can be shown. An epoch in
# milliseconds or nanoseconds, or a number that no double holds, is no time.
MIN_SECONDS, MAX_SECONDS = -62_135_596_800, 253_402_300_800


def packet_records(packets: DataFrame) -> DataFrame:
    """Packet rows in stream-record form: one protocol label, ``unknown`` addresses."""
    return packets.select(
        "ts",
        protocol_label().alias("protocol"),
        address_or_unknown("src_ip").alias("src_ip"),
        address_or_unknown("dst_ip").alias("dst_ip"),
        "packet_size",
        "has_ip", "is_tcp", "is_udp", "is_icmp", "is_http", "is_dns",
    )


def _line(*parts: Column) -> Column:
    return F.concat_ws(",", *parts)


def format_lines(records: DataFrame, time_col: str = "ts", keep: list[str] | None = None) -> DataFrame:
    """One CSV line per record (B8), time as epoch seconds with six decimals; ``keep``: columns to leave beside it."""
    secs = seconds_text(epoch_micros(records, time_col))
    return records.select(
        _line(secs, "protocol", "src_ip", "dst_ip", F.col("packet_size").cast("string")).alias("value"), *(keep or []))


def damaged_lines(records: DataFrame, time_col: str = "ts") -> DataFrame:
    """Lines that the parser must reject, derived from the records.

    Non-IPv4 packets give a line without the size field; UDP packets give a
    line whose size is not an integer; TCP packets give lines whose time is
    no event time: in nanoseconds, or larger than a timestamp or a double.
    """
    secs = seconds_text(epoch_micros(records, time_col))
    short = records.filter(~F.col("has_ip")).select(_line(secs, "protocol", "src_ip", "dst_ip").alias("value"))
    frac = records.filter(F.col("is_udp")).select(
        _line(secs, "protocol", "src_ip", "dst_ip", F.concat(F.col("packet_size").cast("string"), F.lit(".5")))
        .alias("value"))
    times = F.array(F.concat(F.replace(secs, F.lit("."), F.lit("")), F.lit("000")), F.lit("1e14"), F.lit("1e300"), F.lit("1e400"))
    odd = records.filter("is_tcp").withColumn("odd_time", F.explode(times)).select(
        _line("odd_time", "protocol", "src_ip", "dst_ip", F.col("packet_size").cast("string")).alias("value"))
    return short.unionByName(frac).unionByName(odd)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_SPACE, "")


def parse_lines(lines: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """Split on commas; keep lines with exactly five fields, a time in the years 1 to 9999 and an integer size.

    The protocol and addresses are kept as written; only the numbers are
    stripped of surrounding blanks. With ``keep_rejects`` every line is kept
    and ``valid`` tells which passed.
    """
    # Each step's values are bound once (by ``transform`` over one element, then ``inline``): as columns they would be
    # copied into every expression that uses them, the line's own making included, and the filter moved below shuffles.
    split = F.transform(F.array(F.split(F.col("value"), ",", -1)), lambda p: F.struct(p.alias("parts"), _strip(F.get(p, 0)).alias("time"), _strip(F.get(p, 4)).alias("size")))

    def numbers(x: Column) -> Column:
        return F.struct(x["parts"].alias("parts"), F.when(x["time"].rlike(FLOAT_TEXT), x["time"].try_cast("double")).alias("time"),
                        x["size"].rlike(INT_TEXT).alias("integer"), x["size"].alias("size"))

    def checked(x: Column) -> Column:
        valid = F.coalesce((F.size(x["parts"]) == 5) & (x["time"] >= MIN_SECONDS) & (x["time"] < MAX_SECONDS) & x["integer"], F.lit(False))
        return F.struct(x["parts"].alias("parts"), x["time"].alias("time"), F.when(valid, x["size"].try_cast("long")).alias("size"), valid.alias("valid"))

    def record(x: Column) -> Column:
        fields = [F.when(x["valid"], F.get(x["parts"], k)).alias(name) for k, name in ((1, "protocol"), (2, "src_ip"), (3, "dst_ip"))]
        return F.struct(F.when(x["valid"], x["time"]).alias("timestamp"), *fields, x["size"].alias("packet_size"), (x["valid"] & x["size"].isNotNull()).alias("valid"))

    parsed = lines.select(F.inline(F.transform(F.transform(F.transform(split, numbers), checked), record)))
    if keep_rejects:
        return parsed
    return parsed.filter("valid").drop("valid")


def with_event_time(records: DataFrame, seconds_col: str = "timestamp", out: str = "event_time") -> DataFrame:
    """Epoch seconds (double) to a ``TIMESTAMP`` column usable for windows and watermarks; null where they are
    outside the years 1 to 9999 (``parse_lines`` gives none of those)."""
    seconds = F.col(seconds_col)
    fits = (seconds >= MIN_SECONDS) & (seconds < MAX_SECONDS)
    return records.withColumn(out, F.timestamp_micros(F.round(F.when(fits, seconds) * F.lit(1e6)).cast("long")))


def read_line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source: new text files in ``folder``, one line per record (A5)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)
