"""Distinct endpoints that merge across batches and runs.

Two forms, both small per capture and batch, both combined by one aggregation over what was stored:

* ``address_bitmaps``: exact. An IPv4 address is a 32-bit number; the addresses of a capture are bits, 2**15 of them
  per row (Spark's bitmap buckets), so distinct sources or destinations are a bit count, and merging is a bitwise or. A
  capture has at most 2**17 such rows of 4 KB a side, however many packets it has; addresses of one network share
  a row. (Pairs of addresses don't lie close together, so exact connections stay with the edge table.)
* ``endpoint_thetas``: approximate, with set operations. Theta sketches of sources, destinations and connections
  (directed pairs) can be united across batches and intersected across captures; up to ``2**lg_entries`` distinct
  values they are exact, beyond that the relative standard deviation is about ``1 / sqrt(2**lg_entries)`` (of the
  union, for an intersection).

Both aggregate partially before the shuffle, so a hot capture is combined where its packets are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_ENTRIES = 12
SIDES = {"src": "src_ip", "dst": "dst_ip"}


def address_number(ip: Column) -> Column:
    """A dotted quad as a number, null for anything else."""
    parts = [F.get(F.split(ip, r"\."), k).try_cast("long") for k in range(4)]
    number = parts[0]
    for part in parts[1:]:
        number = number * 256 + part
    return F.when(ip.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"), number)


def address_bitmaps(packets: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side (src or dst), bucket, bits: one row per 2**15 addresses that occur."""
    sides = F.array(*[F.struct(F.lit(side).alias("side"), address_number(F.col(c)).alias("address")) for side, c in SIDES.items()])
    seen = packets.select(*keys, F.explode(sides).alias("seen")).select(*keys, "seen.side", "seen.address").filter("address IS NOT NULL")
    position = F.bitmap_bit_position("address")
    return seen.groupBy(*keys, "side", F.bitmap_bucket_number("address").alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Stored bitmaps of any number of batches -> one set per ``keys``; can be stored and merged again."""
    return bitmaps.groupBy(*keys, "side", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def unique_addresses(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, unique_src_ips, unique_dst_ips, exactly, from merged or unmerged bitmaps."""
    counts = [F.coalesce(F.sum(F.when(F.col("side") == side, F.bitmap_count("bits"))), F.lit(0)).alias(f"unique_{column}s") for side, column in SIDES.items()]
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(*counts)


def endpoint_thetas(packets: DataFrame, keys: list[str], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """keys, src, dst, connections: a theta sketch each. Packets without IPv4 take no part."""
    pair = F.when(F.col("has_ip"), F.concat_ws(">", "src_ip", "dst_ip"))
    values = {"src": F.col("src_ip"), "dst": F.col("dst_ip"), "connections": pair}
    return packets.groupBy(*keys).agg(*[F.theta_sketch_agg(v, lg_entries).alias(name) for name, v in values.items()])


def merge_thetas(thetas: DataFrame, keys: list[str], lg_entries: int = LG_ENTRIES) -> DataFrame:
    return thetas.groupBy(*keys).agg(*[F.theta_union_agg(c, lg_entries).alias(c) for c in ("src", "dst", "connections")])


def theta_estimates(thetas: DataFrame, keys: list[str]) -> DataFrame:
    """keys, unique_src_ips, unique_dst_ips, connections."""
    names = {"src": "unique_src_ips", "dst": "unique_dst_ips", "connections": "connections"}
    return thetas.select(*keys, *[F.theta_sketch_estimate(c).alias(name) for c, name in names.items()])


def common_endpoints(thetas: DataFrame, pairs: DataFrame, key: str = "filename") -> DataFrame:
    """pairs (left, right) of captures -> left, right, common_src, common_dst, common_connections: how many both have.
    The sketches are joined, not the packets."""
    sides = [thetas.select(F.col(key).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("src", "dst", "connections")]) for side in ("left", "right")]
    both = pairs.join(sides[0], "left").join(sides[1], "right")
    return both.select("left", "right", *[F.theta_sketch_estimate(F.theta_intersection(f"left_{c}", f"right_{c}")).alias(f"common_{c}") for c in ("src", "dst", "connections")])
