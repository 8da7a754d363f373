"""End-to-end flows: batch analysis of captures and the live stream analysis."""

from __future__ import annotations

import os
from collections import Counter

from pyspark.sql import functions as F

from pcap_builder import write_pcap
from test_capture import _mixed_packets
from wirelake.plans.analysis import analyze_captures, read_stream_analysis, start_stream_analysis
from wirelake.sources.lines import read_line_stream
from wirelake.streaming.windows import stop_gracefully


def test_analyze_captures(spark, scratch):
    paths = []
    for i, n in enumerate([200, 120, 0, 50]):
        p = os.path.join(scratch, f"c{i}.pcap")
        write_pcap(p, _mixed_packets(n, seed=i) if n else [])
        paths.append(p)
    paths.append(os.path.join(scratch, "missing.pcap"))
    res = analyze_captures(spark, paths, os.path.join(scratch, "out"))
    feats = {r.filename: r for r in res.features.collect()}
    assert {f: feats[f].packet_count for f in feats} == {"c0.pcap": 200, "c1.pcap": 120, "c2.pcap": 0, "c3.pcap": 50}
    assert res.rejected.count() == 1
    assert res.predictions.count() == 4
    assert res.panels["summary"].first().total_packets == 370
    trend = [r.filename for r in res.panels["protocol_trend"].collect()]
    assert trend[::5] == ["c0.pcap", "c1.pcap", "c2.pcap", "c3.pcap"]  # input order
    assert spark.sql("SELECT COUNT(*) AS n FROM network_traffic").first().n == 4
    empty = res.panels["protocol_long"].filter("filename = 'c2.pcap'").collect()
    assert len(empty) == 5 and all(r["count"] == 0 and r.percentage == 0.0 for r in empty)
    report = os.path.join(res.report_path)
    assert any(f.startswith("part-") for f in os.listdir(report))


def test_stream_analysis(spark, scratch):
    src = os.path.join(scratch, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(f"{t},{'TCP' if t % 2 else 'UDP'},a,b,{10 + t}" for t in range(0, 200, 3)) + "\n")
    out = os.path.join(scratch, "out")
    queries = start_stream_analysis(read_line_stream(spark, src), out, interval_seconds=1, console=True)
    try:
        for q in queries.values():
            q.processAllAvailable()
    finally:
        for q in queries.values():
            stop_gracefully(q)
    times = range(0, 200, 3)
    state = read_stream_analysis(spark, out)
    counters = state["label_counters"].first()
    assert counters.total_packets == len(times) and counters.label_tcp == sum(t % 2 for t in times)
    # every window that holds a line, those still open at the end included
    want = Counter()
    for t in times:
        for start in range(t - 3, t + 1):
            want[start, "TCP" if t % 2 else "UDP"] += 1
    got = {(int(r.window_start.timestamp()), r.protocol): r.packets for r in state["protocol_counts"].collect()}
    assert got == want
    assert state["window_totals"].agg(F.sum("packets")).first()[0] == 4 * len(times)


def test_cli_explain(spark, capsys):
    from conftest import SF001
    from wirelake.__main__ import main

    main(["explain", "features", SF001])
    out = capsys.readouterr().out
    assert "== Physical Plan ==" in out and "HashAggregate" in out
