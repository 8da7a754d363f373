"""The incremental feature store: only new captures are read, loads count once."""

from __future__ import annotations

import os

import pytest

from pcap_builder import eth, ip4, tcp, write_pcap
from wirelake.sources.capture import ingest_captures
from wirelake.sources.manifest import Manifest
from wirelake.sources.store import FeatureStore
from wirelake.operators.features import feature_table
from wirelake.schema import FEATURE_COLUMNS


def _capture(path: str, n: int, seed: int) -> str:
    write_pcap(path, [(1000.0 + i, eth(0x0800, ip4("10.0.0.1", f"10.{seed}.1.{i % 9}", 6, tcp(1000, 443, 2)))) for i in range(n)])
    return path


def test_loads_add_up_and_count_once(spark, scratch):
    paths = [_capture(f"{scratch}/c{k}.pcap", 10 * k, k) for k in range(5)]  # the first has no packets
    bad = f"{scratch}/bad.pcap"
    write_pcap(bad, [], magic=0x1234)
    store = FeatureStore(spark, f"{scratch}/store")
    assert store.features().count() == 0
    first = store.load(paths[:2] + [bad, f"{scratch}/none.pcap"])
    assert store.load(paths[:2] + [bad]) is None and store.loads() == [first]  # nothing new
    prepared = store.prepare(paths[:4])  # fails before its commit: doesn't count
    assert store.features().count() == 2
    again = store.load(paths[:4])
    assert again == prepared and store.loads() == [first, again]
    store.commit(again)
    assert store.loads() == [first, again]
    read = spark.read.parquet(f"{scratch}/store/loads/{again}/captures")
    assert {r.filename for r in read.collect()} == {"c2.pcap", "c3.pcap"}  # only the new ones
    store.load(paths)
    whole = ingest_captures(spark, paths, f"{scratch}/out")
    want = feature_table(whole.packets, ["path", "filename"], captures=whole.captures)
    rows = lambda df: sorted(map(tuple, df.select("path", "filename", *FEATURE_COLUMNS).collect()))
    assert rows(store.features()) == rows(want)
    assert {r.status for r in store.captures().filter("filename = 'bad.pcap'").collect()} == {"bad_header"}


def test_a_changed_capture_replaces_itself(spark, scratch):
    a, b = _capture(f"{scratch}/a.pcap", 20, 1), _capture(f"{scratch}/b.pcap", 7, 2)
    store = FeatureStore(spark, f"{scratch}/store")
    store.load([a, b])
    _capture(a, 33, 3)
    os.utime(a, (2e9, 2e9))
    store.load([a, b])
    assert {r.filename: r.packet_count for r in store.features().collect()} == {"a.pcap": 33, "b.pcap": 7}
    assert store.committed().count() == 3


def test_of_two_commits_one_waits(spark, scratch):
    store = FeatureStore(spark, f"{scratch}/store")
    store.commit("x")
    manifest = Manifest(spark, f"{scratch}/store/manifest")
    version, _ = manifest.latest()
    manifest.publish(version + 1, {"loads": ["x", "other"]})
    with pytest.raises(FileExistsError):
        manifest.publish(version + 1, {"loads": ["x", "lost"]})
    store.commit("y")
    assert store.loads() == ["x", "other", "y"]
