"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are split by the tokenizer's pattern. Distinct new pre-tokens of a slice are put into matrices by
length class, one row each, padded on the right. Every round each row merges its leftmost pair of minimum
rank; ranks come from a hash table over token pairs held in two numpy arrays, rows without a mergeable
pair leave the matrix, and columns close up. A pre-token that is itself a vocabulary entry is that one
token, as in the public library. Pre-tokens longer than the widest matrix class merge the same pairs in
the same order on a linked list with a heap, so a text without spaces costs n log n, not n squared.

Defined cases: a null text counts as empty and has no ids; texts of any length are encoded whole, special
strings as ordinary text; repeated rows each get their row; an empty table gives an empty result; other
columns are not read. No shuffle; the rank file is the only thing broadcast, its size is fixed.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from wirelake.llm.common import byte_slices, texts_of

WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128, 256)
CELLS = 1 << 20       # most cells in one matrix
MEMORY = 400_000      # distinct pre-tokens that a worker remembers before it starts anew
SLICE_BYTES = 2 << 20
NONE = np.int32(2**31 - 1)


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def split_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every way to join two vocabulary entries into a third: left ids, right ids, joined ids."""
    pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    return tuple(np.array(pairs, dtype=np.int64).reshape(-1, 3).T)


class PairTable:
    """(left id, right id) -> id of the joined token, which is also its rank; open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(len(rank) * 3).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        self._pairs: dict[int, int] | None = None
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = slots[todo]
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = keys[todo[free]]  # of several rows for one slot the last stays; the others go on
            mine = self.keys[at] == keys[todo]
            self.values[at[mine]] = rank[todo[mine]]
            todo = todo[~mine]
            slots[todo] = (slots[todo] + np.uint64(1)) & self.mask

    @property
    def pairs(self) -> dict[int, int]:
        """The same as a dictionary, made when the first very long piece needs it."""
        if self._pairs is None:
            used = self.values != NONE
            self._pairs = dict(zip(self.keys[used].tolist(), self.values[used].tolist()))
        return self._pairs

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks for arrays of pairs; a negative id is padding and pairs with nothing."""
        out = np.full(left.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[todo].astype(np.uint64) << np.uint64(32)) | right.ravel()[todo].astype(np.uint64)
        slots, flat = self._slot(keys), out.ravel()
        while len(todo):
            there = self.keys[slots]
            hit = there == keys
            flat[todo[hit]] = self.values[slots[hit]]
            go = ~hit & (there != np.uint64(2**64 - 1))
            todo, keys, slots = todo[go], keys[go], (slots[go] + np.uint64(1)) & self.mask
        return flat.reshape(left.shape)


def merge_matrix(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """Merge every row of a matrix of byte ids (padding -1) until no pair of it has a rank; same shape, padding -1."""
    out = np.full_like(ids, -1)
    where, columns = np.arange(len(ids)), np.arange(ids.shape[1])
    ranks = table.ranks_of(ids[:, :-1], ids[:, 1:])
    while len(where):
        width = ids.shape[1]
        if width < 2:
            out[where, :width] = ids
            break
        every = np.arange(len(where))
        at = ranks.argmin(axis=1)  # the first of equal minima: the leftmost
        best = ranks[every, at]
        ended = best == NONE
        if ended.any():
            out[where[ended], :width] = ids[ended]
            ids, ranks, where, at, best = ids[~ended], ranks[~ended], where[~ended], at[~ended], best[~ended]
            every = every[: len(where)]
        ids[every, at] = best  # a joined token's id is its rank
        later = columns[: width - 1] > at[:, None]
        ids = np.where(later, ids[:, 1:], ids[:, :-1])
        ranks = np.where(later[:, : width - 2], ranks[:, 1:], ranks[:, :-1])
        has = at < width - 2
        r, c = every[has], at[has]
        ranks[r, c] = table.ranks_of(ids[r, c], ids[r, c + 1])
        has = at > 0
        r, c = every[has], at[has] - 1
        ranks[r, c] = table.ranks_of(ids[r, c], ids[r, c + 1])
    return out


def merge_long(ids: list[int], pairs: dict[int, int]) -> np.ndarray:
    """The same merges for one very long piece: a linked list of tokens and a heap of (rank, position)."""
    n, ids = len(ids), list(ids)
    after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank = pairs.get(ids[i] << 32 | ids[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue  # one of the two tokens has been merged meanwhile
        ids[i], ids[j] = rank, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return np.array([t for t in ids if t >= 0], dtype=np.int32)


def merge_pieces(pieces: list[bytes], byte_ids: np.ndarray, table: PairTable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in ``pieces``, their ids one after another, ids per piece), by length class."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    classes = np.searchsorted(WIDTHS, sizes)
    for k in np.unique(classes):
        members = np.flatnonzero(classes == k)
        if k == len(WIDTHS):
            for i in members:
                merged = merge_long(byte_ids[np.frombuffer(pieces[i], dtype=np.uint8)].tolist(), table.pairs)
                yield np.array([i]), merged, np.array([len(merged)])
            continue
        width = WIDTHS[k]
        for at in range(0, len(members), CELLS // width):
            part = members[at : at + CELLS // width]
            block = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in part.tolist()]), dtype=np.uint8).reshape(-1, width)
            merged = merge_matrix(np.where(np.arange(width) < sizes[part, None], byte_ids[block], -1).astype(np.int32), table)
            filled = merged >= 0
            yield part, merged[filled], filled.sum(axis=1)


class Codec:
    """Lives in a Python worker: the tables of a rank file and the ids of the pre-tokens met so far."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        self.ranks = read_ranks(raw)
        self.find = regex.compile(pattern).findall
        self.table = PairTable(*split_pairs(self.ranks))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        words = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            words[r] = t
        self.word_bytes = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.word_lens = np.array([len(w) for w in words], dtype=np.int64)
        self.word_starts = np.cumsum(self.word_lens) - self.word_lens
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.store = np.zeros(1 << 16, dtype=np.int32)
        self.starts, self.lens = np.zeros(1 << 15, dtype=np.int64), np.zeros(1 << 15, dtype=np.int64)
        self.used = 0

    def _remember(self, new: list[str]) -> None:
        pieces = [p.encode() for p in new]
        whole = [self.ranks.get(p, -1) for p in pieces]
        entry = np.array(whole, dtype=np.int64)
        rest = np.flatnonzero(entry < 0).tolist()
        entry = np.flatnonzero(entry >= 0)
        self._store([new[i] for i in entry.tolist()], np.array(whole, dtype=np.int32)[entry], np.ones(len(entry), dtype=np.int64))
        names = [new[i] for i in rest]
        for part, ids, lens in merge_pieces([pieces[i] for i in rest], self.byte_ids, self.table):
            self._store([names[i] for i in part.tolist()], ids, lens)

    def _store(self, names: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        count = len(self.known)
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while count + len(names) > len(self.starts):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
        self.store[self.used : self.used + len(ids)] = ids
        self.starts[count : count + len(names)] = self.used + np.cumsum(lens) - lens
        self.lens[count : count + len(names)] = lens
        self.known.update(zip(names, range(count, count + len(names))))
        self.used += len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and each text's number of ids."""
        if len(self.known) > MEMORY:
            self._forget()
        pieces = [self.find(t) for t in texts]
        new = set().union(*pieces).difference(self.known) if pieces else set()
        if new:
            self._remember(list(new))
        per_text = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        rows = np.fromiter(map(self.known.__getitem__, chain.from_iterable(pieces)), dtype=np.int64, count=int(per_text.sum()))
        lens = self.lens[rows]
        ids = self.store[ragged(self.starts[rows], lens)]
        bounds = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.word_bytes[ragged(self.word_starts[ids], self.word_lens[ids])].tobytes()


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions start, start+1, ... of every span, one span after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    return np.arange(total) + np.repeat(starts - (np.cumsum(lens) - lens), lens)


_codecs: dict[int, Codec] = {}


def _codec(spec: tuple[bytes, str]) -> Codec:
    key = hash(spec)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(*spec)
    return _codecs[key]


def _shared(docs: DataFrame, ranks_path: str, pattern: str | None):
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(ranks_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast((f.read(), pattern))


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, token_ids (array of int)."""
    shared = _shared(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                ids, sizes = codec.encode(texts_of(batch.column(1), start, stop))
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.ListArray.from_arrays(bounds, pa.array(ids))], ["id", "token_ids"])

    picked = _picked(docs, id_col, text_col)
    schema = T.StructType([picked.schema["id"], T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "token_ids", id_col: str = "doc_id") -> DataFrame:
    """One row per encoded document: id, data (the bytes the ids stand for)."""
    shared = _shared(encoded, ranks_path, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            data = [codec.decode(np.asarray(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "data"])

    picked = encoded.select(encoded[f"`{id_col}`"].alias("id"), encoded[f"`{ids_col}`"].alias("ids"))
    schema = T.StructType([picked.schema["id"], T.StructField("data", T.BinaryType())])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str | None = None, text_col: str = "text", id_col: str = "doc_id",
               with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass; one row per document: id, n_tokens, ids_sha256, decoded_sha256, and token_ids if wanted."""
    shared = _shared(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                ids, sizes = codec.encode(texts_of(batch.column(1), start, stop))
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                raw, spans = ids.astype("<u4"), list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                columns = [batch.column(0).slice(start, stop - start), pa.array(sizes, pa.int64()),
                           pa.array([hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in spans], pa.string()),
                           pa.array([hashlib.sha256(codec.decode(ids[a:b])).hexdigest() for a, b in spans], pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"][: len(columns)])

    picked = _picked(docs, id_col, text_col)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
              T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
    return picked.mapInArrow(run, T.StructType([picked.schema["id"], *fields[: 4 if with_ids else 3]])).withColumnRenamed("id", id_col)
