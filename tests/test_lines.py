"""Stream line parsing (B6, B7) on the fixed line fixture, and format/parse round trip."""

from __future__ import annotations

from conftest import SF001
from wirelake.sources.lines import format_lines, packet_records, parse_lines
from wirelake.sources.tables import packets_events
from wirelake.streaming.windows import label_counters

# (line, expected parsed tuple or None when the line is rejected)
FIXTURE = [
    ("0,TCP,10.0.0.1,10.0.1.1,10", (0.0, "TCP", "10.0.0.1", "10.0.1.1", 10)),
    ("6.5,UDP,10.0.0.1,10.0.1.1,20", (6.5, "UDP", "10.0.0.1", "10.0.1.1", 20)),
    ("21,OTHER,unknown,unknown,30", (21.0, "OTHER", "unknown", "unknown", 30)),
    ("8, TCP,a,b, 5 ", (8.0, " TCP", "a", "b", 5)),
    ("bad", None),
    ("1,TCP,a,b", None),
    ("22,TCP,a,b,1,2", None),
    ("7,TCP,a,b,x", None),
    ("7,TCP,a,b,1.5", None),
    ("9,TCP,a,b,3000000000", (9.0, "TCP", "a", "b", 3000000000)),
    ("nan,TCP,a,b,1", None),
    ("1e14,TCP,a,b,1", None),
    ("1e300,TCP,a,b,1", None),
    ("1e400,TCP,a,b,1", None),
    ("-1e300,TCP,a,b,1", None),
    ("1704067798778549000,TCP,a,b,1", None),
    ("2.5e11,TCP,a,b,9000000000000000000", (2.5e11, "TCP", "a", "b", 9000000000000000000)),
    ("", None),
]


def test_line_fixture(spark):
    lines = spark.createDataFrame([(v,) for v, _ in FIXTURE], "value string")
    got = {tuple(r) for r in parse_lines(lines).collect()}
    assert got == {e for _, e in FIXTURE if e is not None}
    flagged = parse_lines(lines, keep_rejects=True).collect()
    assert [r.valid for r in flagged] == [e is not None for _, e in FIXTURE]


def test_odd_lines_do_not_stop_a_stream(spark, scratch):
    """Times without a timestamp and sizes that overflow a sum, in a stream that goes on."""
    from wirelake.sources.lines import read_line_stream, with_event_time
    from wirelake.streaming import windows as win

    spark.createDataFrame([(v,) for v, _ in FIXTURE] + [("2.5e11,TCP,a,b,9000000000000000000",)], "value string").coalesce(1).write.text(f"{scratch}/lines")
    records = with_event_time(parse_lines(read_line_stream(spark, f"{scratch}/lines")))
    counts = win.protocol_window_counts(win.with_watermark(records, "event_time", "1 hour"), "20 seconds", "5 seconds", "event_time")
    sink, _ = win.run_bounded(counts, "odd_lines", "update")
    got = win.latest_windows(spark, sink, counts.schema).filter("window_start > '9000-01-01'").collect()
    assert {(r.packets, r.bytes) for r in got} == {(2, None)} and len(got) == 4
    totals = win.label_counters(parse_lines(spark.createDataFrame([("1,TCP,a,b,9000000000000000000",)] * 2, "value string"))).first()
    assert totals.total_bytes is None and totals.label_tcp == 2


def test_format_parse_round_trip(spark):
    records = packet_records(packets_events(spark, SF001))
    parsed = parse_lines(format_lines(records))
    assert parsed.count() == records.count()
    a = {(r.protocol, r.src_ip, r.dst_ip, r.packet_size) for r in parsed.collect()}
    b = {(r.protocol, r.src_ip, r.dst_ip, r.packet_size) for r in records.collect()}
    assert a == b


def test_parse_makes_each_line_once(spark):
    """The text of a line is made once, not once for each use of a field, and its check stays above the shuffle."""
    parsed = parse_lines(format_lines(packet_records(packets_events(spark, SF001, spread_rows=True))))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string") == 1 and "format_string" not in plan.split("RepartitionByExpression")[1]


def test_counters_make_each_line_once(spark):
    counters = label_counters(parse_lines(format_lines(packet_records(packets_events(spark, SF001, spread_rows=True)))))
    plan = counters._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string") == 1
    assert counters.first().total_packets == 1000
