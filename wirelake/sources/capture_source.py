"""Captures as a Spark data source: ``format("capture")``, batch (A1) and stream (A5).

*Batch.* ``read_captures`` builds the range index (``capture.frame_index``, a Spark job) below the shared folder and
loads through it. The source plans its partitions from the index, about ``SPLIT_BYTES`` of file each, and its readers
yield Arrow batches of frames; decoding (``decode_packets``) follows as expressions. Filters on ``filename``, ``path``
and ``capture_index`` (equality, membership) and on ``ts`` (comparisons) are pushed down: they choose ranges by the index,
which has each range's first and last time, so files and ranges that can't match are not opened. Rows of the ranges that
are left are filtered by Spark as usual.

*Stream.* Capture files that grow in a folder. The offset is every file's size; a micro-batch has the records that end
in the bytes since the offset before, whole records only. Where the first of those starts, and its number, the task
that read the bytes before has noted under ``state`` (a shared folder, beside the checkpoint), so the driver looks at
names and sizes only, and a task reads new bytes only. Notes are written under final names when complete and have one
possible content, so a repeated task is harmless; without its note a task goes through the file from the start. A
file of which not even the header is there yet waits; one that isn't a capture, or goes wrong, gives nothing from there
on. pcapng files have the interfaces that stand before their first packet. Gzip files don't grow in a readable way
and are not followed.

The index and the offsets hold one entry per range or file. Defined cases: no captures, or none readable: no rows; empty
captures have no rows; a rejected capture (see ``capture``) has no rows and is listed by ``captures_of``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from wirelake.session import shared_dir
from wirelake.sources import capture as cap
from wirelake.sources.files import filesystem_of, qualify

PACKETS_SCHEMA = T.StructType([T.StructField("ts", T.TimestampType()) if f.name == "micros" else f for f in cap.FRAME_SCHEMA])
NAMED = ("filename", "path", "capture_index")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _timed(batch: pa.RecordBatch) -> pa.RecordBatch:
    at = batch.schema.get_field_index("micros")
    return batch.set_column(at, pa.field("ts", pa.timestamp("us", tz="UTC")), batch.column(at).cast(pa.timestamp("us", tz="UTC")))


class CaptureSource(DataSource):
    """Options: ``index`` (batch), or ``path`` of a folder and ``state`` (stream)."""

    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> T.StructType:
        return PACKETS_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Ranges(self.options["index"])

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Growing(self.options["path"], self.options["state"])


class _Ranges(DataSourceReader):
    def __init__(self, index: str):
        self.index, self.wanted, self.since, self.until = index, {}, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on names choose whole captures and need no second look; those on times choose ranges and do."""
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if isinstance(f, (EqualTo, In)) and column in NAMED:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
                continue
            if column == "ts" and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo, LessThan, LessThanOrEqual)):
                micros = int(np.datetime64(f.value.astimezone(_utc()).replace(tzinfo=None), "us").astype(np.int64))
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.since = micros if self.since is None else max(self.since, micros)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.until = micros if self.until is None else min(self.until, micros)
            yield f

    def partitions(self) -> Sequence[InputPartition]:
        import pyarrow.parquet as pq

        filesystem, folder = filesystem_of(self.index)
        rows = pq.read_table(folder, filesystem=filesystem).to_pylist()
        rows = [r for r in rows if all(r[c] in values for c, values in self.wanted.items())]
        rows = [r for r in rows if (self.since is None or r["high"] >= self.since) and (self.until is None or r["low"] <= self.until)]
        parts, held = [], 0
        for r in sorted(rows, key=lambda r: (r["capture_index"], r["range_no"])):
            size = min(r["end"], r["size"]) - min(r["first"], r["size"])
            if not parts or held + size > cap.SPLIT_BYTES:
                parts.append([])
                held = 0
            parts[-1].append(r)
            held += size
        return [InputPartition(p) for p in parts]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = cap._arrow(cap.FRAME_SCHEMA)
        for r in (partition.value or []) if partition is not None else []:
            for batch in cap._frames(r, schema):
                yield _timed(batch)


def _utc():
    from datetime import timezone

    return timezone.utc


class _Growing(DataSourceStreamReader):
    def __init__(self, folder: str, state: str):
        self.folder, self.state = folder, state

    def initialOffset(self) -> dict:
        return {"sizes": {}}

    def latestOffset(self) -> dict:
        from pyarrow import fs as pafs

        filesystem, inner = filesystem_of(self.folder)
        found = filesystem.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True))
        return {"sizes": {f.path: f.size for f in found if f.type == pafs.FileType.File and f.path.endswith((".pcap", ".pcapng", ".cap"))}}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        before = start["sizes"]
        return [InputPartition((path, before.get(path, 0), size)) for path, size in sorted(end["sizes"].items()) if size > before.get(path, 0)]

    def commit(self, end: dict) -> None:
        pass

    def _uri(self, path: str) -> str:
        """A listed path under the name by which the folder was given."""
        scheme, _, rest = self.folder.partition("://")
        if not rest:
            return path
        return f"{scheme}://{rest.split('/', 1)[0]}{path}" if path.startswith("/") else f"{scheme}://{path}"

    def _note(self, path: str, size: int) -> str:
        return f"{filesystem_of(self.state)[1].rstrip('/')}/{hashlib.md5(path.encode()).hexdigest()}-{size}.json"

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end = partition.value
        filesystem, _ = filesystem_of(self.folder)
        head = cap._header(self._uri(path), end)
        if head["status"] != "ok" or head["gzip"]:
            return
        r = dict(capture_index=0, path=path, filename=path.rsplit("/", 1)[-1], whole=False) | head
        notes, schema = filesystem_of(self.state)[0], cap._arrow(cap.FRAME_SCHEMA)
        place, number = head["data_start"], 0
        try:
            with notes.open_input_stream(self._note(path, start)) as f:
                place, number = json.loads(f.read())
        except FileNotFoundError:
            pass
        with filesystem.open_input_file(path) as f:
            for batch, ends in cap.growing_frames(r | dict(base=number), cap._Window(f, end), place, schema):
                place, number = int(ends[-1]), number + len(ends)
                fresh = int(np.searchsorted(ends, start, side="right"))  # records that ended before are out already
                if fresh < len(ends):
                    yield _timed(batch.slice(fresh))
        notes.create_dir(filesystem_of(self.state)[1], recursive=True)
        written = f"{self._note(path, end)}.{hashlib.md5(str(id(f)).encode()).hexdigest()[:8]}"
        with notes.open_output_stream(written) as f:
            f.write(json.dumps([place, number]).encode())
        notes.move(written, self._note(path, end))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureSource)
    spark.conf.set(PUSHDOWN, "true")


def write_index(spark: SparkSession, paths: list[str] | DataFrame, folder: str, split_bytes: int = cap.SPLIT_BYTES) -> str:
    """The index of some captures (paths, or a table of them) as Parquet below ``folder``; the folder to give to the
    source as ``index``. The capture list is beside it."""
    captures, index, failed = cap.indexed(spark, paths, folder, split_bytes)
    cap.numbered_ranges(index.join(failed, "capture_index", "left_anti")).write.mode("overwrite").parquet(f"{folder}/index")
    return f"{qualify(spark, folder)}/index"


def read_captures(spark: SparkSession, paths: list[str] | DataFrame | None = None, index: str | None = None, split_bytes: int = cap.SPLIT_BYTES) -> DataFrame:
    """Frames of captures through the source, from an index that is there (``index``) or is made now (``paths``)."""
    register(spark)
    return spark.read.format("capture").option("index", index or write_index(spark, paths, shared_dir(spark, "capture-index"), split_bytes)).load()


def captures_of(spark: SparkSession, folder: str) -> DataFrame:
    """The capture list that ``write_index`` left in ``folder``, with the status of every capture."""
    captures, failed = spark.read.parquet(f"{folder}/captures"), spark.read.parquet(f"{folder}/failed")
    status = F.when(F.col("of").isNull(), F.col("status")).when(F.col("message").isNull(), "framing_error").otherwise("unreadable")
    return captures.join(failed.withColumnRenamed("capture_index", "of"), F.col("capture_index") == F.col("of"), "left").select("capture_index", "path", "filename", status.alias("status"))


def stream_captures(spark: SparkSession, folder: str, state: str) -> DataFrame:
    """Frames of the capture files that grow in ``folder``, as a stream; ``state``: a shared folder that is kept as long
    as the query's checkpoint."""
    register(spark)
    return spark.readStream.format("capture").option("path", qualify(spark, folder)).option("state", qualify(spark, state)).load()
