"""Substring deduplication with content-defined chunking.

A gear hash rolls over a text's bytes; a chunk ends where the hash of the last ``WINDOW`` bytes falls into
one sixteenth of its range, unless another such place lies within the ``GAP`` bytes before. Where chunks end
depends on nothing further away, so an insertion changes the chunks around it and no others, and a passage
has the same inner chunks wherever it stands. Ends never split a character. Chunks average about 24 bytes;
a chunk's identity is the 64-bit digest of its bytes.

Pass 1 keeps the digests that occur in two or more documents, with the smallest id (minimum and maximum
id per digest, summed per task first, so a passage in every document costs one row per task). Pass 2 joins
the chunks to those digests (hot digests can be split) and merges neighbouring repeated chunks into spans.
A span counts from ``MIN_BYTES`` bytes of whole repeated chunks: the first 18 bytes of a passage and what
lies before its first and after its last chunk end are not part of it, so a passage of 300 bytes (about 50
words) gives a span in more than 99 % of cases, and one below ``MIN_BYTES`` never does.

The copy in the document with the smallest id stays; the others are cut by ``cut_repeats``.

Defined cases: a null text counts as empty and has no chunks; a text repeated inside one document is no
repeat; rows of equal id are one document, and rows of equal id and text are reported once; all rows with a
null id are one document; texts of any length are chunked whole; an empty table gives an empty result.
``repeated_spans`` reads only id and text; ``cut_repeats`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wirelake.llm.common import byte_slices, materialise, mix64, span_hashes, texts_of

WINDOW = 12
GAP = 6
CUT_BITS = 4       # a place ends a chunk with probability 2**-CUT_BITS
MIN_BYTES = 96
SLICE_BYTES = 1 << 20
GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """The positions in ``data`` (bytes) after which a chunk ends, the last position not included."""
    one = GEAR[data]

    def with_earlier(h: np.ndarray, earlier: np.ndarray, by: int) -> np.ndarray:
        out = h.copy()
        out[by:] += earlier[:-by] << np.uint64(by)
        return out

    two = with_earlier(one, one, 1)
    four = with_earlier(two, two, 2)
    eight = with_earlier(four, four, 4)
    rolled = with_earlier(eight, four, 8)
    places = np.flatnonzero((rolled * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - CUT_BITS) == 0)
    places = places[places + 1 < len(data)]
    places = places[(data[places + 1] & 0xC0) != 0x80]
    return places[np.diff(places, prepend=-GAP - 1) > GAP]


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end, digest) of every chunk of every text."""
    pad = b"\0" * WINDOW
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes + WINDOW) - sizes
    places = chunk_ends(data) + 1 if len(data) > WINDOW else np.zeros(0, dtype=np.int64)
    text = np.searchsorted(starts, places, side="right") - 1
    inside = (text >= 0) & (places > starts[text]) & (places < starts[text] + sizes[text])
    filled = np.flatnonzero(sizes)
    ends = np.sort(np.concatenate([places[inside], (starts + sizes)[filled]]))
    text = np.searchsorted(starts, ends, side="left") - 1
    first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, dtype=bool)
    begins = np.where(first, starts[text], np.concatenate([[0], ends[:-1]]) if len(ends) else ends)
    digest = span_hashes(data, begins, ends) if len(ends) else np.zeros(0, np.uint64)
    return text, begins - starts[text], ends - starts[text], digest.view(np.int64)


def _part(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _chunks(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """id, part (tells texts of equal id apart), start, end, digest."""
    picked = docs.select(F.col(id_col).alias("id"), _part(F.col(text_col)).alias("part"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                text, begin, end, digest = chunks_of([t.encode() for t in texts_of(batch.column(2), start, stop)])
                at = pa.array(text + start)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(digest)],
                                                 ["id", "part", "start", "end", "digest"])

    return picked.mapInArrow(run, T.StructType([picked.schema["id"], picked.schema["part"], T.StructField("start", T.IntegerType()),
                                                T.StructField("end", T.IntegerType()), T.StructField("digest", T.LongType())]))


def _spans(docs: DataFrame, min_bytes: int, text_col: str, id_col: str) -> DataFrame:
    """id, part, start, end, first_id, kept."""
    chunks = _chunks(docs, text_col, id_col)
    owners = chunks.groupBy("digest").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.max(F.col("id").isNull().cast("int")).alias("nulls"))
    owners = owners.filter("first_id <> last_id OR (nulls = 1 AND first_id IS NOT NULL)").select("digest", "first_id")
    owners = materialise(owners, "chunk-owners")
    met = chunks.join(owners, "digest").select("id", "part", "start", "end", "first_id", F.col("id").eqNullSafe(F.col("first_id")).alias("kept")).dropDuplicates(["id", "part", "start"])
    along = Window.partitionBy("id", "part").orderBy("start")
    apart = F.coalesce(F.lag("end").over(along) != F.col("start"), F.lit(True))
    turn = apart | F.coalesce(F.lag("kept").over(along) != F.col("kept"), F.lit(True))
    marked = met.withColumn("apart", apart.cast("int")).withColumn("turn", turn.cast("int"))
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = marked.select("*", F.sum("apart").over(so_far).alias("run"), F.sum("turn").over(so_far).alias("piece"))
    pieces = runs.groupBy("id", "part", "run", "piece").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_id").alias("first_id"), F.first("kept").alias("kept"))
    whole = Window.partitionBy("id", "part", "run")
    sized = pieces.withColumn("run_bytes", F.sum(F.col("end") - F.col("start")).over(whole))
    return sized.filter(F.col("run_bytes") >= min_bytes).select("id", "part", "start", "end", "first_id", "kept")


def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per repeated span of a document: id, start_byte, end_byte, first_id (smallest id of a document
    that shares a chunk of it), kept (this document's copy is the one that stays). Documents without repeats have no row."""
    spans = _spans(docs, min_bytes, text_col, id_col)
    return spans.select(F.col("id").alias(id_col), F.col("start").cast("long").alias("start_byte"), F.col("end").cast("long").alias("end_byte"),
                        F.col("first_id").alias(f"first_{id_col}"), "kept")


def cut_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents without the repeated spans that don't stay; all columns as they came, the text shortened."""
    spans = _spans(docs, min_bytes, text_col, id_col).filter("NOT kept")
    cuts = spans.groupBy("id", "part").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")).withColumnRenamed("id", "cut_id").withColumnRenamed("part", "cut_part")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(materialise(cuts, "chunk-cuts"), F.col(f"row.{id_col}").eqNullSafe(F.col("cut_id")) & (_part(F.col(f"row.{text_col}")) == F.col("cut_part")), "left")
    data = F.col(f"row.{text_col}").cast("binary")
    # what stands before each cut and after the cut before it, then the rest
    before = F.transform("cuts", lambda c, i: F.substring(data, F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0)) + 1, c["start"] - F.coalesce(F.get("cuts", i - 1)["end"], F.lit(0))))
    rest = F.substring(data, F.element_at("cuts", -1)["end"] + 1, F.octet_length(data))
    shortened = F.concat(F.aggregate(before, F.lit(b""), lambda acc, x: F.concat(acc, x)), rest).cast("string")
    text = F.when(F.col("cuts").isNull(), F.col(f"row.{text_col}")).otherwise(shortened)
    return joined.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
