"""Capture ingest (A1, A3, A4, A6) and header decode rules (A2, B1, B2)."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from pcap_builder import arp, eth, icmp_echo, ip4, ip6, tcp, udp, write_pcap
from wirelake.functions.headers import decode_packets
from wirelake.operators.features import feature_table
from wirelake.schema import to_feature_schema
from wirelake.sources.capture import ingest_captures

SYN, ACK, PSH, ECE, CWR = 0x02, 0x10, 0x08, 0x40, 0x80
A, B = "10.0.0.1", "10.0.0.2"

# name -> (frame bytes, expected decoded fields)
CASES = {
    "tcp_options": (eth(0x0800, ip4(A, B, 6, tcp(1234, 443, ACK), options=b"\x01\x01\x01\x00")),
                    dict(has_ip=True, is_tcp=True, tcp_flags=ACK, src_ip=A, dst_ip=B)),
    "syn": (eth(0x0800, ip4(A, B, 6, tcp(1234, 443, SYN))), dict(is_tcp=True, tcp_flags=SYN)),
    "syn_ack": (eth(0x0800, ip4(A, B, 6, tcp(443, 1234, SYN | ACK))), dict(is_tcp=True, tcp_flags=SYN | ACK)),
    "syn_ece_cwr": (eth(0x0800, ip4(A, B, 6, tcp(1, 2, SYN | ECE | CWR))), dict(tcp_flags=SYN | ECE | CWR)),
    "http": (eth(0x0800, ip4(A, B, 6, tcp(5555, 80, PSH | ACK, b"GET / HTTP/1.1\r\n"))),
             dict(is_tcp=True, is_http=True, is_dns=False)),
    "bare_ack_80": (eth(0x0800, ip4(A, B, 6, tcp(5555, 80, ACK))), dict(is_tcp=True, is_http=False)),
    "dns_udp": (eth(0x0800, ip4(A, B, 17, udp(5353, 53, b"\x12\x34" + b"\0" * 10))),
                dict(is_udp=True, is_dns=True, is_tcp=False)),
    "dns_tcp": (eth(0x0800, ip4(A, B, 6, tcp(53, 40000, PSH | ACK, b"\0\x0c" + b"\0" * 12))),
                dict(is_tcp=True, is_dns=True)),
    "icmp": (eth(0x0800, ip4(A, B, 1, icmp_echo())), dict(has_ip=True, is_icmp=True, is_tcp=False)),
    "later_fragment": (eth(0x0800, ip4(A, B, 6, b"\0" * 24, frag=185)),
                       dict(has_ip=True, is_tcp=False, tcp_flags=None)),
    "ipv6_tcp": (eth(0x86DD, ip6(6, tcp(1, 443, SYN))), dict(has_ip=False, is_tcp=True, src_ip=None)),
    "arp": (eth(0x0806, arp()), dict(has_ip=False, is_tcp=False, is_udp=False)),
    "vlan_tcp": (eth(0x0800, ip4(A, B, 6, tcp(1, 2, SYN)), vlan=1), dict(has_ip=True, is_tcp=True, tcp_flags=SYN)),
    "qinq_udp": (eth(0x0800, ip4(A, B, 17, udp(1, 2)), vlan=2), dict(has_ip=True, is_udp=True)),
    "runt": (b"\x01\x02\x03", dict(has_ip=False, is_tcp=False, is_udp=False, is_icmp=False)),
}


def test_decode_rules(spark):
    rows = [(name, 1, bytearray(frame), len(frame)) for name, (frame, _) in CASES.items()]
    frames = spark.createDataFrame(rows, "name string, linktype int, data binary, packet_size int")
    got = {r["name"]: r.asDict() for r in decode_packets(frames).collect()}
    for name, (_, expected) in CASES.items():
        for key, value in expected.items():
            assert got[name][key] == value, (name, key, got[name][key], value)
    for r in got.values():  # flags are never NULL
        assert all(r[k] is not None for k in ("has_ip", "is_tcp", "is_udp", "is_icmp", "is_http", "is_dns"))


def test_raw_ip_linktype(spark):
    frames = spark.createDataFrame([(101, bytearray(ip4(A, B, 17, udp(9, 53, b"x" * 4))), 40)],
                                   "linktype int, data binary, packet_size int")
    r = decode_packets(frames).first()
    assert r.has_ip and r.is_udp and r.is_dns and r.src_ip == A


def _mixed_packets(n: int, seed: int = 7) -> list[tuple[float, bytes]]:
    rnd = random.Random(seed)
    names = list(CASES)
    out, t = [], 1_700_000_000.0
    for _ in range(n):
        frame = CASES[rnd.choice(names)][0]
        pad = bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 300)))
        t += rnd.random() * 0.01
        out.append((round(t, 6), frame + pad))
    return out


def _expected(packets):
    import pandas as pd

    spark_free = pd.DataFrame({"size": [len(d) for _, d in packets]})
    return len(packets), int(spark_free["size"].sum())


def test_ingest_cases(spark, scratch):
    d1, d2 = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    os.makedirs(d1)
    os.makedirs(d2)
    pk = _mixed_packets(300)
    paths = {
        "le": os.path.join(d1, "le.pcap"), "be": os.path.join(d1, "be.pcap"),
        "ns": os.path.join(d1, "ns.pcap"), "empty": os.path.join(d1, "empty.pcap"),
        "one": os.path.join(d1, "one.pcap"), "trunc": os.path.join(d1, "trunc.pcap"),
        "bad": os.path.join(d1, "bad.pcap"), "same1": os.path.join(d1, "same.pcap"),
        "same2": os.path.join(d2, "same.pcap"), "missing": os.path.join(d1, "nothere.pcap"),
    }
    write_pcap(paths["le"], pk)
    write_pcap(paths["be"], pk, big_endian=True)
    write_pcap(paths["ns"], pk, nanos=True, big_endian=True)
    write_pcap(paths["empty"], [])
    write_pcap(paths["one"], pk[:1])
    write_pcap(paths["trunc"], pk[:10], truncate_last=5)
    write_pcap(paths["bad"], pk[:10], magic=0x12345678)
    write_pcap(paths["same1"], pk[:20])
    write_pcap(paths["same2"], pk[:30])
    order = list(paths.values())
    res = ingest_captures(spark, order, os.path.join(scratch, "out"), split_bytes=4096)
    feats = to_feature_schema(feature_table(res.packets, ["path", "filename"], captures=res.captures))
    by_path = {r["path"]: r for r in feats.collect()}
    n, total = _expected(pk)
    for key in ("le", "be", "ns"):
        assert by_path[paths[key]]["packet_count"] == n
        assert by_path[paths[key]]["total_bytes"] == total
    assert by_path[paths["empty"]]["packet_count"] == 0
    assert by_path[paths["empty"]]["avg_packet_size"] == 0.0
    assert by_path[paths["one"]]["packet_count"] == 1
    assert by_path[paths["trunc"]]["packet_count"] == 9
    assert by_path[paths["same1"]]["packet_count"] == 20
    assert by_path[paths["same2"]]["packet_count"] == 30
    assert by_path[paths["same1"]]["filename"] == by_path[paths["same2"]]["filename"] == "same.pcap"
    rejected = {r["path"]: r["status"] for r in res.rejected.collect()}
    assert rejected == {paths["bad"]: "bad_header", paths["missing"]: "missing"}
    # times survive both byte orders and nanosecond captures
    ts = res.packets.filter(F.col("path") == paths["ns"]).agg(F.min("ts"), F.max("ts")).first()
    ts_le = res.packets.filter(F.col("path") == paths["le"]).agg(F.min("ts"), F.max("ts")).first()
    assert all(abs((a - b).total_seconds()) <= 1e-6 for a, b in zip(ts, ts_le))  # writer rounds to ns
    # packet numbers are 1..n in file order
    nos = [r.packet_no for r in res.packets.filter(F.col("path") == paths["le"]).orderBy("packet_no").collect()]
    assert nos == list(range(1, n + 1))


def test_split_framing_is_exact(spark, scratch):
    """Many small ranges, payloads that imitate record headers: framing stays exact."""
    rnd = random.Random(3)
    packets, t = [], 1_700_000_000.0
    for i in range(4000):
        frame = CASES["http"][0]
        if i % 3 == 0:  # a fake record chain inside the payload
            fake = b"".join(
                (int(t).to_bytes(4, "little") + (1).to_bytes(4, "little") + (8).to_bytes(4, "little")
                 + (8).to_bytes(4, "little") + b"\0" * 8) for _ in range(20))
            frame = frame + fake
        frame = frame + bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 64)))
        t += 0.001
        packets.append((round(t, 6), frame))
    path = os.path.join(scratch, "big.pcap")
    write_pcap(path, packets)
    res = ingest_captures(spark, [path], os.path.join(scratch, "out"), split_bytes=1000)
    got = res.packets.agg(F.count("*").alias("n"), F.sum("packet_size").alias("b"),
                          F.min("packet_no").alias("lo"), F.max("packet_no").alias("hi"),
                          F.count_distinct("packet_no").alias("d")).first()
    assert got.n == len(packets) == got.d == got.hi and got.lo == 1
    assert got.b == sum(len(p) for _, p in packets)
    assert res.packets.filter(~F.col("is_http")).count() == 0


def test_pcapng_matches_classic(spark, scratch):
    from pcap_builder import write_pcapng

    pk = _mixed_packets(1500, seed=11)
    paths = {
        "classic": os.path.join(scratch, "a.pcap"),
        "ng_le": os.path.join(scratch, "b.pcapng"),
        "ng_be_ns": os.path.join(scratch, "c.pcapng"),
        "ng_mixed": os.path.join(scratch, "d.pcapng"),
    }
    write_pcap(paths["classic"], pk)
    write_pcapng(paths["ng_le"], pk)
    write_pcapng(paths["ng_be_ns"], pk, big_endian=True, tsresol=9)
    write_pcapng(paths["ng_mixed"], pk, simple_every=7, stats_every=50)
    res = ingest_captures(spark, list(paths.values()), os.path.join(scratch, "out"), split_bytes=3000)
    feats = {r["path"]: r for r in feature_table(res.packets, ["path", "filename"]).collect()}
    want = feats[paths["classic"]].asDict()
    for key in ("ng_le", "ng_be_ns", "ng_mixed"):
        got = feats[paths[key]].asDict()
        assert {k: v for k, v in got.items() if k not in ("path", "filename")} == \
               {k: v for k, v in want.items() if k not in ("path", "filename")}, key
    times = {}
    for key in ("classic", "ng_le", "ng_be_ns"):
        times[key] = res.packets.filter(F.col("path") == paths[key]).agg(F.min("ts"), F.max("ts")).first()
    assert tuple(times["classic"]) == tuple(times["ng_le"])
    assert all(abs((a - b).total_seconds()) <= 1e-6 for a, b in zip(times["classic"], times["ng_be_ns"]))
    nos = [r.packet_no for r in res.packets.filter(F.col("path") == paths["ng_mixed"]).orderBy("packet_no").collect()]
    assert nos == list(range(1, len(pk) + 1))
    assert res.rejected.count() == 0


def test_other_link_types(spark):
    """Linux cooked v1/v2 and BSD loopback headers in front of the same IPv4/TCP packet."""
    import struct

    from pcap_builder import ip4, tcp

    pkt = ip4(A, B, 6, tcp(1, 80, PSH | ACK, b"GET / HTTP/1.1\r\n"))
    sll = struct.pack(">HHH8sH", 0, 1, 6, b"\0" * 8, 0x0800) + pkt
    sll2 = struct.pack(">HHIHBB8s", 0x0800, 0, 2, 1, 0, 6, b"\0" * 8) + pkt
    null_le = struct.pack("<I", 2) + pkt
    rows = [(113, bytearray(sll), len(sll)), (276, bytearray(sll2), len(sll2)), (0, bytearray(null_le), len(null_le)),
            (108, bytearray(struct.pack(">I", 2) + pkt), len(pkt) + 4)]
    frames = spark.createDataFrame(rows, "linktype int, data binary, packet_size int")
    for r in decode_packets(frames).collect():
        assert r.has_ip and r.is_tcp and r.is_http and r.src_ip == A and r.dst_ip == B, r


def test_ipv6_extension_headers(spark):
    import struct

    from pcap_builder import ip6

    def ext(nh: int, body_len8: int = 0) -> bytes:  # hop-by-hop / destination options style
        return bytes([nh, body_len8]) + b"\x01\x04\0\0\0\0" + b"\0" * (8 * body_len8)

    def frag(nh: int, offset8: int) -> bytes:
        return struct.pack(">BBHI", nh, 0, offset8 << 3, 7)

    cases = {
        "hbh_tcp": (ip6(0, ext(6) + tcp(1, 80, PSH | ACK, b"GET / HTTP/1.1\r\n")), dict(is_tcp=True, is_http=True)),
        "dst_rt_tcp": (ip6(60, ext(43, 1) + ext(6) + tcp(1, 443, SYN)), dict(is_tcp=True, tcp_flags=SYN)),
        "frag0_dns": (ip6(44, frag(17, 0) + udp(5353, 53, b"\0" * 12)), dict(is_udp=True, is_dns=True)),
        "frag_later": (ip6(44, frag(6, 185) + b"\0" * 24), dict(is_tcp=False, is_udp=False)),
    }
    rows = [(n, 1, bytearray(eth(0x86DD, b)), 100) for n, (b, _) in cases.items()]
    got = {r.name: r for r in decode_packets(
        spark.createDataFrame(rows, "name string, linktype int, data binary, packet_size int")).collect()}
    for name, (_, want) in cases.items():
        for k, v in want.items():
            assert got[name][k] == v, (name, k, got[name][k])
        assert got[name].has_ip is False


def test_folder_listing_and_partition_pruning(spark, scratch):
    from pcap_builder import write_pcapng
    from wirelake.sources.capture import captures_in_folder

    folder = os.path.join(scratch, "caps")
    os.makedirs(os.path.join(folder, "sub"))
    write_pcap(os.path.join(folder, "x.pcap"), _mixed_packets(80, seed=1))
    write_pcapng(os.path.join(folder, "sub", "y.pcapng"), _mixed_packets(60, seed=2))
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not a capture")
    caps = captures_in_folder(spark, folder)
    listing_plan = caps._jdf.queryExecution().executedPlan().toString()
    assert "content" not in listing_plan.split("ReadSchema")[1].split("\n")[0]  # file bodies never loaded
    res = ingest_captures(spark, caps, os.path.join(scratch, "out"))
    counts = {r.filename: r["count"] for r in res.packets.groupBy("filename").count().collect()}
    assert counts == {"x.pcap": 80, "y.pcapng": 60}
    one = res.packets.filter(F.col("filename") == "x.pcap")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(filename" in plan and "x.pcap" in plan
    assert one.count() == 80


def test_ingest_with_nothing_readable(spark, scratch):
    bad = os.path.join(scratch, "bad.pcap")
    write_pcap(bad, [], magic=0x1234)
    res = ingest_captures(spark, [bad, os.path.join(scratch, "missing.pcap")], os.path.join(scratch, "out"))
    assert res.packets.count() == 0 and res.rejected.count() == 2
    assert feature_table(res.packets, ["path", "filename"], captures=res.captures).count() == 0


def _ingest_many_ranges(spark, scratch, packets, name="x.pcap", split=700, **kw):
    path = os.path.join(scratch, name)
    write_pcap(path, packets, **kw)
    return path, ingest_captures(spark, [path], os.path.join(scratch, f"out-{name}"), split_bytes=split)


def test_zero_payloads_day_gaps_and_odd_lengths(spark, scratch):
    """Runs of zero bytes, steps of days, and records that look like header chains don't mislead split framing."""
    packets, t = [], 1_700_000_000.0
    for i in range(300):
        t += 86_400 * 3 if i % 7 == 0 else 0.01
        packets.append((round(t, 6), CASES["http"][0] + b"\0" * (1400 if i % 3 == 0 else 20)))
    _, res = _ingest_many_ranges(spark, scratch, packets, split=500)
    got = res.packets.agg(F.count("*").alias("n"), F.sum("packet_size").alias("b"), F.count_distinct("packet_no").alias("d"), F.max("packet_no").alias("hi")).first()
    assert got.n == got.d == got.hi == 300 and got.b == sum(len(p) for _, p in packets)
    assert res.rejected.count() == 0 and res.packets.filter("NOT is_http").count() == 0


def test_large_records_and_original_lengths_are_kept(spark, scratch):
    """A record of 300 kB, far above the snap length, and an original length of 2**32 - 1; only the corrupt file is rejected."""
    import struct

    small = CASES["syn"][0]
    packets = [(1.0 + i, small) for i in range(50)] + [(60.0, small + b"\1" * 300_000)] + [(70.0 + i, small) for i in range(50)]
    path, corrupt = os.path.join(scratch, "big.pcap"), os.path.join(scratch, "corrupt.pcap")
    write_pcap(path, packets)
    with open(path, "r+b") as f:
        f.seek(24 + 12)
        f.write(struct.pack("<I", 0xFFFFFFFF))
    write_pcap(corrupt, packets[:40])
    with open(corrupt, "r+b") as f:
        f.seek(24 + 10 * (16 + len(small)) + 8)
        f.write(struct.pack("<I", 0xFFFFFFF0))
    res = ingest_captures(spark, [path, corrupt], os.path.join(scratch, "out"), split_bytes=1000)
    got = res.packets.agg(F.count("*"), F.max("packet_size"), F.max("orig_len"), F.count_if("is_tcp")).first()
    assert tuple(got) == (101, len(small) + 300_000, 0xFFFFFFFF, 101)
    assert [(r.filename, r.status) for r in res.rejected.collect()] == [("corrupt.pcap", "framing_error")]


def test_wrong_guess_repairs_ranges_not_files(spark, scratch):
    """Payloads that hold whole captures: guesses go wrong there, and only those ranges are read again."""
    import struct

    inner = b"".join(struct.pack("<IIII", 1_700_000_000 + k, 5, 60, 60) + bytes(60) for k in range(40))
    packets = [(1_700_000_000.0 + i, CASES["dns_udp"][0] + (inner if i % 20 == 10 else b"\2" * 50)) for i in range(200)]
    path, res = _ingest_many_ranges(spark, scratch, packets, split=900)
    assert res.packets.count() == 200 and res.rejected.count() == 0
    out = os.path.join(scratch, "out-x.pcap")
    checked = spark.read.parquet(f"{out}/checked-1")
    wrong, ranges = checked.filter("wrong").count(), checked.count()
    assert 0 < wrong < ranges / 2 and os.path.getsize(path) / 900 <= ranges + 1


def test_large_pcapng_block_and_interface_offset(spark, scratch):
    import struct

    def block(kind: int, body: bytes) -> bytes:
        body += b"\0" * (-len(body) % 4)
        return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)

    def packet(data: bytes) -> bytes:
        return block(6, struct.pack("<IIIII", 0, 0, 5_000_000, len(data), len(data)) + data)

    interface = struct.pack("<HHI", 1, 0, 0) + struct.pack("<HHq", 14, 8, 1_000_000) + struct.pack("<HH", 0, 0)
    frame = CASES["http"][0]
    path = os.path.join(scratch, "n.pcapng")
    with open(path, "wb") as f:
        f.write(block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, interface))
        f.write(packet(frame) * 20 + packet(frame + b"\3" * (20 << 20)) + packet(frame) * 20)
    res = ingest_captures(spark, [path], os.path.join(scratch, "out"), split_bytes=1 << 20)
    got = res.packets.agg(F.count("*"), F.max("packet_size"), F.count_if("is_http"), F.min(F.unix_seconds(F.col("ts")))).first()
    assert tuple(got) == (41, len(frame) + (20 << 20), 41, 1_000_005)


def test_long_ipv6_header_chains(spark, scratch):
    def ext(nh: int, body_len8: int = 0) -> bytes:
        return bytes([nh, body_len8]) + b"\x01\x04\0\0\0\0" + b"\0" * (8 * body_len8)

    four = eth(0x86DD, ip6(0, ext(60) + ext(43) + ext(60) + ext(6) + tcp(1, 80, PSH | ACK, b"GET / HTTP/1.1\r\n")))
    large = eth(0x86DD, ip6(60, ext(60, 255) + ext(6, 100) + tcp(1, 443, SYN)))
    _, res = _ingest_many_ranges(spark, scratch, [(1.0, four), (2.0, large)])
    got = {r.packet_no: r for r in res.packets.collect()}
    assert got[1].is_http and got[2].is_tcp and got[2].tcp_flags == SYN


def test_gzip_captures(spark, scratch):
    import gzip

    pk = _mixed_packets(400, seed=5)
    plain, cut = os.path.join(scratch, "a.pcap"), os.path.join(scratch, "cut.pcap.gz")
    write_pcap(plain, pk)
    data = open(plain, "rb").read()
    zipped = os.path.join(scratch, "b.pcap.gz")
    with open(zipped, "wb") as f:
        f.write(gzip.compress(data[:5000]) + gzip.compress(data[5000:]))  # two members
    with open(cut, "wb") as f:
        f.write(gzip.compress(data[:-3]))  # a truncated last record
    res = ingest_captures(spark, [plain, zipped, cut], os.path.join(scratch, "out"), split_bytes=3000)
    rows = {r.filename: r for r in feature_table(res.packets, ["path", "filename"]).collect()}
    same = [{k: v for k, v in rows[n].asDict().items() if k not in ("path", "filename")} for n in ("a.pcap", "b.pcap.gz")]
    assert same[0] == same[1] and rows["cut.pcap.gz"].packet_count == 399


def test_a_path_listed_twice_is_two_captures(spark, scratch):
    a, b = os.path.join(scratch, "a.pcap"), os.path.join(scratch, "b.pcap")
    write_pcap(a, _mixed_packets(10))
    write_pcap(b, [])
    res = ingest_captures(spark, [a, a, b], os.path.join(scratch, "out"))
    table = feature_table(res.packets, ["capture_index", "path", "filename"], captures=res.captures)
    assert sorted((r.capture_index, r.packet_count) for r in table.collect()) == [(0, 10), (1, 10), (2, 0)]


def test_paths_and_statuses(spark, scratch):
    from wirelake.sources.capture import list_captures, stat_captures
    from wirelake.sources.files import arrow_uri, qualify

    assert arrow_uri("s3a://bucket/x.pcap") == "s3://bucket/x.pcap" and arrow_uri("abfss://c@a.example/x") == "abfss://c@a.example/x"
    assert arrow_uri("hdfs://nn:8020/x") == "hdfs://nn:8020/x" and arrow_uri("file:///a/b") == arrow_uri("file:/a/b") == arrow_uri("/a/b") == "/a/b"
    assert qualify(spark, "/a/b.pcap") == "file:/a/b.pcap" and qualify(spark, "s3a://bucket/x") == "s3a://bucket/x"
    good = os.path.join(scratch, "g.pcap")
    write_pcap(good, _mixed_packets(3))
    paths = [good, os.path.join(scratch, "none.pcap"), scratch, "nosuch://host/x.pcap"]
    got = {r.path: (r.status, r.detail) for r in list_captures(spark, paths).collect()}
    assert [got[p][0] for p in paths] == ["ok", "missing", "unreadable", "unreadable"]
    assert got[scratch][1].startswith("IsADirectoryError") and got["nosuch://host/x.pcap"][1]
    many = spark.createDataFrame([(i, f"{scratch}/{i}.pcap") for i in range(400)], "capture_index long, path string")
    assert stat_captures(many).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def _gre(inner: bytes, ethertype: int, bits: int = 0) -> bytes:
    import struct

    extra = sum(4 for b in (0x8000, 0x2000, 0x1000) if bits & b)
    return struct.pack(">HH", bits, ethertype) + b"\0" * extra + inner


def test_layers_inside_tunnels(spark, scratch):
    """Layers count at any depth; addresses, flags and ports are the outermost ones."""
    import struct

    web = tcp(1000, 80, PSH | ACK, b"GET / HTTP/1.1\r\n")
    inner = ip4("10.0.0.1", "10.0.0.2", 6, web)
    dns6 = ip6(17, udp(4000, 53, b"query"))
    mpls = lambda body, labels=2: b"".join(struct.pack(">I", (16 + k) << 12 | (k == labels - 1) << 8 | 64) for k in range(labels)) + body
    pppoe = lambda body, kind: struct.pack(">BBHHH", 0x11, 0, 1, len(body) + 2, kind) + body
    vxlan = lambda frame: udp(50000, 4789, b"\x08\0\0\0\0\0\x2a\0" + frame)
    out = lambda proto, body: ip4("192.0.2.1", "192.0.2.2", proto, body)
    deep = inner
    for _ in range(20):
        deep = out(4, deep)
    frames = {
        "ipip": eth(0x0800, out(4, inner)), "6in4": eth(0x0800, out(41, dns6)), "4in6": eth(0x86DD, ip6(4, inner)), "6in6": eth(0x86DD, ip6(41, dns6)),
        "gre": eth(0x0800, out(47, _gre(inner, 0x0800, 0xB000))), "gre_eth": eth(0x0800, out(47, _gre(eth(0x0800, inner, vlan=2), 0x6558))),
        "gre_arp": eth(0x0800, out(47, _gre(arp(), 0x0806))), "gre_v1": eth(0x0800, out(47, _gre(inner, 0x0800, 1))),
        "vxlan": eth(0x0800, out(17, vxlan(eth(0x0800, inner)))), "mpls": eth(0x8847, mpls(inner)), "mpls_vlan": eth(0x8847, mpls(dns6, 1), vlan=1),
        "pppoe": eth(0x8864, pppoe(inner, 0x0021)), "pppoe6": eth(0x8864, pppoe(dns6, 0x0057)), "pppoe_lcp": eth(0x8864, pppoe(b"\1" * 20, 0xC021)),
        "deep": eth(0x0800, deep), "fragment": eth(0x0800, ip4("192.0.2.1", "192.0.2.2", 4, inner, frag=5)), "short": eth(0x0800, out(4, inner))[:40],
        "icmp": eth(0x0800, out(47, _gre(ip4("10.0.0.1", "10.0.0.2", 1, icmp_echo()), 0x0800))), "plain": eth(0x0800, inner),
        "ext": eth(0x0800, out(41, ip6(0, bytes([6, 0]) + b"\0" * 6 + web))),
    }
    path = os.path.join(scratch, "t.pcap")
    write_pcap(path, [(1.0 + k, f) for k, f in enumerate(frames.values())])
    res = ingest_captures(spark, [path], os.path.join(scratch, "out"))
    rows = {name: r for name, r in zip(frames, res.packets.orderBy("packet_no").collect())}
    got = {name: "".join(c for c, on in zip("4tuidh", (r.has_ip, r.is_tcp, r.is_udp, r.is_icmp, r.is_dns, r.is_http)) if on) for name, r in rows.items()}
    assert got == {"ipip": "4th", "6in4": "4ud", "4in6": "4th", "6in6": "ud", "gre": "4th", "gre_eth": "4th", "gre_arp": "4", "gre_v1": "4", "vxlan": "4tuh",
                   "mpls": "4th", "mpls_vlan": "ud", "pppoe": "4th", "pppoe6": "ud", "pppoe_lcp": "", "deep": "4th", "fragment": "4", "short": "4", "icmp": "4i",
                   "plain": "4th", "ext": "4th"}
    assert (rows["gre"].src_ip, rows["mpls"].src_ip, rows["4in6"].dst_ip, rows["6in6"].src_ip) == ("192.0.2.1", "10.0.0.1", "10.0.0.2", None)
    assert (rows["vxlan"].src_port, rows["vxlan"].tcp_flags, rows["gre"].src_port, rows["gre"].tcp_flags) == (50000, PSH | ACK, 1000, PSH | ACK)


def test_a_bad_file_costs_itself_only(spark, scratch):
    """Gzip broken past its first 8 MB, lengths that can't be, and long last records that are cut off."""
    import gzip
    import random
    import struct

    rng = random.Random(3)
    good = [(1.0 + i, CASES["http"][0] + rng.randbytes(1300)) for i in range(9000)]
    paths = {n: os.path.join(scratch, n) for n in ("good.pcap", "broken.pcap.gz", "bogus.pcap.gz", "cut.pcap", "cut.pcap.gz", "cut.pcapng", "bogus.pcapng.gz")}
    write_pcap(paths["good.pcap"], good)
    plain = open(paths["good.pcap"], "rb").read()
    zipped = bytearray(gzip.compress(plain, 1))
    zipped[len(zipped) * 4 // 5 : len(zipped) * 4 // 5 + 2000] = b"\xff" * 2000
    few = plain[: 24 + 100 * (16 + len(good[0][1]))]
    cut = few + struct.pack("<IIII", 1, 0, 300_000, 300_000) + b"\0" * 1000
    block = lambda kind, body: struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)
    ng = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, struct.pack("<HHI", 1, 0, 0))
    ng += block(6, struct.pack("<IIIII", 0, 0, 5, 60, 60) + bytes(60)) * 7
    for name, data in (("broken.pcap.gz", bytes(zipped)), ("bogus.pcap.gz", gzip.compress(few + struct.pack("<IIII", 1, 0, 0xFFFFFFF0, 60) + bytes(60))),
                       ("cut.pcap", cut), ("cut.pcap.gz", gzip.compress(cut)), ("cut.pcapng", ng + struct.pack("<II", 6, 40 << 20) + bytes(5000)),
                       ("bogus.pcapng.gz", gzip.compress(ng + struct.pack("<II", 0x77777777, 0xFFFFFFF0) + bytes(5000)))):
        with open(paths[name], "wb") as f:
            f.write(data)
    res = ingest_captures(spark, list(paths.values()), os.path.join(scratch, "out"), split_bytes=1 << 20)
    rejected = {r.filename: (r.status, r.detail) for r in res.rejected.collect()}
    assert {n: s for n, (s, _) in rejected.items()} == {"broken.pcap.gz": "unreadable", "bogus.pcap.gz": "framing_error", "bogus.pcapng.gz": "framing_error"}
    assert "error" in rejected["broken.pcap.gz"][1]
    counts = {r.filename: r["count"] for r in res.packets.groupBy("filename").count().collect()}
    assert counts == {"good.pcap": 9000, "cut.pcap": 100, "cut.pcap.gz": 100, "cut.pcapng": 7}


def test_folders_do_not_grow_with_captures(spark, scratch):
    """Days and buckets instead of a folder per capture; a search reads the folders and row groups it needs."""
    from wirelake.sources.capture import compact_packets, packets_of, read_packets

    paths = [os.path.join(scratch, f"c{k}.pcap") for k in range(90)]
    for k, path in enumerate(paths):
        write_pcap(path, [(1_700_000_000.0 + 86_400 * (k % 2) + i, eth(0x0800, ip4(f"10.0.{k}.1", "10.1.0.1", 6, tcp(1, 2, SYN)))) for i in range(5)])
    res = ingest_captures(spark, paths, os.path.join(scratch, "out"), layout="buckets")
    folders = [d for d, _, files in os.walk(os.path.join(scratch, "out", "packets")) if any(f.endswith(".parquet") for f in files)]
    assert res.packets.count() == 450 and len(folders) <= 2 * 64
    stored = res.packets.select("path").first().path
    prefix = stored[: -len(os.path.basename(stored))]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    one = packets_of(res.packets, path=f"{prefix}c7.pcap", since="2023-11-15", address="10.0.7.1")
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "bucket" in filters and "day" in filters and "src_ip,10.0.7.1" in plan
    assert one.count() == 5 and packets_of(res.packets, until="2023-11-15 12:00:00").count() == 225
    compact_packets(res.packets, os.path.join(scratch, "folded"))
    folded = read_packets(spark, os.path.join(scratch, "folded"), res.packets.schema)
    files = lambda df: len(df.inputFiles())
    assert folded.count() == 450 and files(folded) <= files(res.packets)
    assert packets_of(folded, address="10.0.7.1").count() == 5
