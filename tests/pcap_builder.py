"""Test helper: build packet bytes and classic capture files."""

from __future__ import annotations

import struct


def mac() -> bytes:
    return bytes.fromhex("020000000002020000000001")


def eth(ethertype: int, payload: bytes, vlan: int = 0) -> bytes:
    tags = b"".join(struct.pack(">HH", 0x8100, 1) for _ in range(vlan))
    return mac() + tags + struct.pack(">H", ethertype) + payload


def ip4(src: str, dst: str, proto: int, payload: bytes, options: bytes = b"", frag: int = 0) -> bytes:
    ihl = 5 + len(options) // 4
    total = ihl * 4 + len(payload)
    head = struct.pack(">BBHHHBBH4s4s", 0x40 | ihl, 0, total, 0, frag & 0x1FFF, 64, proto, 0,
                       bytes(int(x) for x in src.split(".")), bytes(int(x) for x in dst.split(".")))
    return head + options + payload


def ip6(nh: int, payload: bytes) -> bytes:
    return struct.pack(">IHBB", 0x60000000, len(payload), nh, 64) + b"\x20\x01" + b"\0" * 13 + b"\1" \
        + b"\x20\x01" + b"\0" * 13 + b"\2" + payload


def tcp(sport: int, dport: int, flags: int, payload: bytes = b"") -> bytes:
    off_flags = (5 << 12) | (flags & 0x1FF)
    return struct.pack(">HHIIHHHH", sport, dport, 1, 0, off_flags, 65535, 0, 0) + payload


def udp(sport: int, dport: int, payload: bytes = b"") -> bytes:
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def icmp_echo() -> bytes:
    return struct.pack(">BBHHH", 8, 0, 0, 1, 1)


def arp() -> bytes:
    return bytes.fromhex("0001080006040001") + b"\0" * 20


def write_pcap(path: str, packets: list[tuple[float, bytes]], big_endian: bool = False, nanos: bool = False,
               linktype: int = 1, snaplen: int = 65535, truncate_last: int = 0, magic: int | None = None) -> None:
    e = ">" if big_endian else "<"
    magic = magic if magic is not None else (0xA1B23C4D if nanos else 0xA1B2C3D4)
    out = [struct.pack(e + "IHHiIII", magic, 2, 4, 0, 0, snaplen, linktype)]
    for ts, data in packets:
        sec = int(ts)
        frac = round((ts - sec) * (1e9 if nanos else 1e6))
        out.append(struct.pack(e + "IIII", sec, frac, len(data), len(data)) + data)
    blob = b"".join(out)
    if truncate_last:
        blob = blob[:-truncate_last]
    with open(path, "wb") as f:
        f.write(blob)


def _ng_block(e: str, btype: int, body: bytes) -> bytes:
    body = body + b"\0" * (-len(body) % 4)
    n = 12 + len(body)
    return struct.pack(e + "II", btype, n) + body + struct.pack(e + "I", n)


def write_pcapng(path: str, packets: list[tuple[float, bytes]], big_endian: bool = False, tsresol: int = 6,
                 linktype: int = 1, simple_every: int = 0, stats_every: int = 0) -> None:
    """pcapng: section header, one interface (10**-tsresol s units), enhanced packet blocks;
    every ``simple_every``-th packet as a simple packet block, a statistics block every
    ``stats_every`` packets."""
    e = ">" if big_endian else "<"
    out = [_ng_block(e, 0x0A0D0D0A, struct.pack(e + "IHHq", 0x1A2B3C4D, 1, 0, -1))]
    opts = struct.pack(e + "HH", 9, 1) + bytes([tsresol]) + b"\0\0\0" + struct.pack(e + "HH", 0, 0)
    out.append(_ng_block(e, 1, struct.pack(e + "HHI", linktype, 0, 0) + opts))
    for i, (ts, data) in enumerate(packets):
        if stats_every and i % stats_every == 0:
            out.append(_ng_block(e, 5, struct.pack(e + "III", 0, 0, 0)))
        if simple_every and i % simple_every == 0:
            out.append(_ng_block(e, 3, struct.pack(e + "I", len(data)) + data))
        else:
            units = round(ts * 10 ** tsresol)
            out.append(_ng_block(e, 6, struct.pack(e + "IIIII", 0, units >> 32, units & 0xFFFFFFFF,
                                                   len(data), len(data)) + data))
    with open(path, "wb") as f:
        f.write(b"".join(out))
