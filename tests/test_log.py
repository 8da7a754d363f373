"""The folded update log and late counts (F6, F7); cluster numbers over refits."""

from __future__ import annotations

import os
from collections import defaultdict
from datetime import datetime, timedelta

from wirelake.operators import cluster
from wirelake.streaming import log

SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, protocol string, packets long, bytes long"
START = datetime(2024, 1, 1)


def _rows(batch: int):
    """Every trigger updates the last three hours' windows and opens a new one."""
    return [(START + timedelta(hours=h), START + timedelta(hours=h + 4), p, 10 * batch + h, 100 * batch) for h in range(max(0, batch - 3), batch + 1) for p in ("TCP", "UDP")]


def test_reading_is_bounded_by_open_windows(spark, scratch):
    sink, schema = f"{scratch}/log", spark.createDataFrame([], SCHEMA).schema
    write, now = log.compacting_writer(sink, "2 hours", 4), {}
    for batch in range(40):
        now |= {r[:3]: r[3:] for r in _rows(batch)}
        frame = spark.createDataFrame(_rows(batch), SCHEMA).coalesce(1)
        write(frame, batch)
        if batch in (5, 17):
            write(frame, batch)  # a replayed micro-batch
    assert {tuple(r)[:3]: tuple(r)[3:] for r in log.all_windows(spark, sink, schema).collect()} == now
    version, content = log._manifest(spark, sink).latest()
    assert version == 10 and content["upto"] == 39
    still = log.open_windows(spark, sink, schema)
    assert still.count() <= 2 * 8  # windows that end after the watermark, whatever came before
    assert not any("batch_id" in f or "closed" in f for f in still.inputFiles())
    frame = spark.createDataFrame(_rows(40), SCHEMA)
    write(frame, 40)
    files = log.open_windows(spark, sink, schema).inputFiles()
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {"batch_id=40", f"open-{content['open']}"}


def test_an_unpublished_fold_does_not_count(spark, scratch):
    sink, schema = f"{scratch}/log", spark.createDataFrame([], SCHEMA).schema
    write = log.compacting_writer(sink, "2 hours", 100)
    for batch in range(6):
        write(spark.createDataFrame(_rows(batch), SCHEMA), batch)
    log.compact(spark, sink, schema, "2 hours")
    before = sorted(map(tuple, log.all_windows(spark, sink, schema).collect()))
    spark.createDataFrame([(*_rows(0)[0][:3], 999, 999, 3)], SCHEMA + ", batch_id long").write.parquet(f"{sink}/_parts/open-00000002")  # a failed fold's
    assert sorted(map(tuple, log.all_windows(spark, sink, schema).collect())) == before
    assert log.compact(spark, sink, schema, "2 hours") == 2
    assert sorted(map(tuple, log.all_windows(spark, sink, schema).collect())) == before


def test_late_rows_by_window(spark, scratch):
    sink = f"{scratch}/late"
    write = log.late_writer(sink, "4 hours", "1 hour", "1 hour")
    table = lambda hours: spark.createDataFrame([(START + timedelta(hours=h, minutes=1), "TCP") for h in hours], "event_time timestamp, protocol string")
    write(table([0, 1, 10]), 0)  # nothing is late in the first
    write(table([2, 5, 8.5, 12]), 1)  # watermark 9:01: of 2:01 and 5:01 all four windows have ended, of 8:31 the one that ends at 9:00
    write(table([2, 5, 8.5, 12]), 1)  # replayed
    write(table([11]), 2)  # watermark 11:01
    got = defaultdict(int)
    for r in spark.read.parquet(sink).collect():
        got[r.batch_id] += r.dropped
    assert got == {1: 4 + 4 + 1}
    assert sum(r.dropped for r in spark.read.parquet(sink).filter("batch_id = 1 AND window_end > timestamp_ntz'2024-01-01 09:01:00'").collect()) == 0


def test_cluster_numbers_over_refits():
    old = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]
    assert cluster.matched_numbers(old, [[9.0, 0.0], [0.0, 9.0], [1.0, 0.0]]) == [1, 2, 0]
    assert cluster.matched_numbers(old, [[0.0, 9.0]]) == [2]
    assert cluster.matched_numbers(old[:2], [[50.0, 50.0], [0.0, 1.0], [10.0, 1.0]]) == [2, 0, 1]
