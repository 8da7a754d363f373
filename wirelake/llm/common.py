"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wirelake.session import SHUFFLE_CLEANUP, drop_dir, setting, shared_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files) and lets Spark drop the shuffle
    files of the job that made the table as soon as it is written.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._materialised = path
    return out


def discard(*tables: DataFrame) -> None:
    """Drop the files of tables that ``materialise`` returned, once nothing reads them any more."""
    for table in tables:
        drop_dir(table.sparkSession, table._materialised)


def byte_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about ``limit`` bytes each (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def texts_of(column: pa.Array, start: int, stop: int) -> list[str]:
    """The rows' texts, null as the empty text."""
    return ["" if t is None else t for t in column.slice(start, stop - start).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


ODD = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD**i and its modular inverse power for i < n (mod 2**64), grown as needed."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(ODD, -1, 1 << 64))
        for name, base in (("up", np.uint64(ODD)), ("down", inverse)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for every span, independent of where the span stands."""
    up, down = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Index:
    """uint64 keys -> positions in the key array, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.at = np.full(1 << self.bits, -1, dtype=np.int64)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.at[slots] < 0
            self.at[slots[free]] = todo[free]  # of several for one slot the last stays; the others go on
            self.keys[slots[free]] = keys[todo[free]]
            go = self.keys[slots] != keys[todo]
            todo, slots = todo[go], (slots[go] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(ODD)) >> np.uint64(64 - self.bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions, -1 for keys that are not there."""
        slots = self._slot(keys)
        out = self.at[slots]
        todo = np.flatnonzero((out >= 0) & (self.keys[slots] != keys))
        slots = slots[todo]
        while len(todo):
            slots = (slots + np.uint64(1)) & self.mask
            out[todo] = self.at[slots]
            go = (out[todo] >= 0) & (self.keys[slots] != keys[todo])
            todo, slots = todo[go], slots[go]
        return out
