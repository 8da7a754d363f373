"""Structured Streaming: text-line source, watermark and late data, bounded runs (A5, F1-F8)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF001
from wirelake.session import shared_dir
from wirelake.sources.lines import parse_lines, read_line_stream, with_event_time
from wirelake.streaming import windows as win


def _write(folder: str, name: str, lines: list[str]) -> None:
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _line_stream(spark, folder):
    records = with_event_time(parse_lines(read_line_stream(spark, folder)))
    return win.with_watermark(records, "event_time", "10 seconds")


def test_sliding_windows_on_line_stream_append_mode(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    # times in seconds; 20 s windows sliding by 5 s (the default four panes)
    _write(src, "a.txt", ["0,TCP,a,b,10", "6.5,UDP,a,b,20", "12,TCP,a,b,30", "bad line", "100,TCP,a,b,1"])
    counts = win.protocol_window_counts(_line_stream(spark, src), *win.default_window(), time_col="event_time")
    sink, query = win.run_bounded(counts, "t_append", output_mode="append")
    got = {(r.window_start.timestamp(), r.protocol): r.packets for r in win.read_sink(spark, sink).collect()}
    # windows ending before the watermark (100 - 10 s) are final; TCP at 0 s and 12 s
    assert got[(-15.0, "TCP")] == 1 and got[(0.0, "TCP")] == 2 and got[(5.0, "TCP")] == 1
    assert got[(0.0, "UDP")] == 1
    assert not any(start >= 85 for start, _ in got)  # still open at the end of a bounded run


def test_late_rows_are_dropped_after_watermark(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    chk = shared_dir(spark, "t_late-chk")
    out = shared_dir(spark, "t_late-out")
    _write(src, "1.txt", ["100,TCP,a,b,1", "200,TCP,a,b,1"])
    totals = win.window_totals(_line_stream(spark, src), "20 seconds", "20 seconds", time_col="event_time")
    win.run_bounded(totals, "t_late", output_mode="append", sink=out, checkpoint=chk)
    # a row 150 s behind the watermark arrives in a later micro-batch
    _write(src, "2.txt", ["40,TCP,a,b,1", "300,TCP,a,b,1"])
    win.run_bounded(totals, "t_late", output_mode="append", sink=out, checkpoint=chk)
    starts = {r.window_start.timestamp() for r in win.read_sink(spark, out).collect()}
    assert 100.0 in starts and 200.0 in starts and 40.0 not in starts


def test_stream_equals_batch_on_events(spark):
    from wirelake.plans.catalog import SLIDE, WINDOW, q_stream_win_protocol_counts, _records

    batch = win.protocol_window_counts(_records(spark, SF001), WINDOW, SLIDE)
    stream = q_stream_win_protocol_counts(spark, SF001)
    cols = ["window_start", "window_end", "protocol", "packets", "bytes"]
    assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, stream.select(cols).collect()))


def test_running_counters_semantics(spark):
    from wirelake.plans.catalog import _records

    r = win.running_counters(_records(spark, SF001)).first()
    assert r.tcp_packets + r.udp_packets + r.icmp_packets <= r.total_packets
    events = spark.read.parquet(f"{SF001}/events.parquet")
    assert r.total_packets == events.count()
    # TCP without IPv4 (one in ten error rows) is not a TCP packet for the live counters
    ip_tcp = events.filter(F.col("event_type").isin("click", "view")).count()
    assert r.tcp_packets == ip_tcp
