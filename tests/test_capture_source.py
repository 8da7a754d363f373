"""``format("capture")``: filter pushdown, growing files, restarts (A1, A5)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pcap_builder import eth, ip4, tcp, write_pcap, write_pcapng
from wirelake.functions.headers import decode_packets
from wirelake.sources import capture_source
from wirelake.sources.capture import ingest_captures
from wirelake.streaming import windows as win


def _packets(n: int, start: float, size: int = 40):
    return [(start + i, eth(0x0800, ip4("10.0.0.1", f"10.0.1.{i % 250}", 6, tcp(1000 + i, 443, 2))) + b"\0" * (i % size)) for i in range(n)]


def test_reads_what_the_ingest_reads(spark, scratch):
    paths = [os.path.join(scratch, n) for n in ("a.pcap", "b.pcapng", "bad.pcap", "none.pcap", "e.pcap")]
    write_pcap(paths[0], _packets(500, 1000.0))
    write_pcapng(paths[1], _packets(300, 2000.0))
    write_pcap(paths[2], [], magic=0x1234)
    write_pcap(paths[4], [])
    columns = ["capture_index", "path", "filename", "packet_no", "ts", "packet_size", "src_ip", "dst_ip", "is_tcp", "tcp_flags", "src_port"]
    ingest = ingest_captures(spark, paths, f"{scratch}/out", split_bytes=3000)
    index = capture_source.write_index(spark, paths, f"{scratch}/indexed", 3000)
    frames = capture_source.read_captures(spark, index=index)
    rows = sorted(map(tuple, decode_packets(frames).select(columns).collect()))
    assert len(rows) == 800 and rows == sorted(map(tuple, ingest.packets.select(columns).collect()))
    assert {r.filename: r.status for r in capture_source.captures_of(spark, f"{scratch}/indexed").collect()} == {
        "a.pcap": "ok", "b.pcapng": "ok", "bad.pcap": "bad_header", "none.pcap": "missing", "e.pcap": "ok"}
    assert capture_source.read_captures(spark, [paths[2], paths[4]]).count() == 0


def test_filters_choose_files_and_ranges(spark, scratch):
    a, b = os.path.join(scratch, "a.pcap"), os.path.join(scratch, "b.pcap")
    write_pcap(a, _packets(400, 1000.0))
    write_pcap(b, _packets(400, 5000.0))
    frames = capture_source.read_captures(spark, [a, b], split_bytes=2000)
    assert frames.count() == 800
    os.remove(b)  # whatever opens it now fails
    assert frames.filter("filename = 'a.pcap'").count() == 400
    assert frames.filter(F.col("filename").isin("a.pcap", "c.pcap") & (F.col("packet_no") > 100)).count() == 300
    assert frames.filter("filename = 'a.pcap' AND filename = 'b.pcap'").count() == 0
    assert frames.filter("ts < timestamp_seconds(1010)").count() == 10
    assert frames.filter("ts >= timestamp_seconds(1390) AND ts < timestamp_seconds(4000)").count() == 10
    with pytest.raises(Exception):
        frames.filter("ts >= timestamp_seconds(5000)").count()


def test_growing_captures_with_restarts(spark, scratch):
    """Files that grow by odd numbers of bytes; every start goes on from the checkpoint; lost notes cost only time."""
    live = os.path.join(scratch, "live")
    os.makedirs(f"{live}/sub")
    whole = {}
    for name, first in (("a.pcap", 0.0), ("sub/b.pcap", 500.0), ("c.pcapng", 900.0)):
        path = os.path.join(scratch, "whole")
        (write_pcapng if name.endswith("ng") else write_pcap)(path, _packets(300, first))
        whole[name] = open(path, "rb").read()
    whole["junk.pcap"] = b"no capture " * 500
    sink, seen = f"{scratch}/out", []
    for share in (0.001, 0.2, 0.21, 0.6, 0.6, 1.0):
        for name, data in whole.items():
            with open(f"{live}/{name}", "wb") as f:
                f.write(data[: int(len(data) * share)])
        frames = capture_source.stream_captures(spark, live, f"{scratch}/notes")
        win.run_bounded(frames.select("filename", "packet_no", "ts", "packet_size"), "growing", "append", sink, f"{scratch}/chk")
        seen.append(win.read_sink(spark, sink, frames.select("filename", "packet_no", "ts", "packet_size").schema).count())
        if share == 0.21:
            for note in os.listdir(f"{scratch}/notes"):
                os.remove(f"{scratch}/notes/{note}")
    assert seen[0] == 0 and 0 < seen[1] < seen[3] == seen[4] < 900 == seen[5]
    rows = spark.read.parquet(sink)
    assert rows.groupBy("filename").agg(F.count_distinct("packet_no").alias("n"), F.max("packet_no").alias("hi"), F.count("*").alias("all")).filter("n = 300 AND hi = 300 AND all = 300").count() == 3
    assert rows.filter("filename = 'b.pcap'").agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()[:] == (500, 799)
