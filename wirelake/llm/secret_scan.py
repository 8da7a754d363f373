"""Secret scans: fixed base patterns, and a linear-chain conditional random field for what they miss.

Tokens are maximal runs of non-space characters. The field tags each as secret begin (B), inside (I) or
outside (O) from its shape, length and character mix, the hashes of its neighbours, and features of its
file (length, share of digits, presence of assignments). It is trained here, by gradient ascent on the
conditional likelihood, on windows of a bounded sample: ``SAMPLE`` rows, half of them with what may be a base span
and half without, those with the smallest hashes of their ids, at most ``WINDOWS`` windows each, labelled by the
base patterns, and as many with the labelled spans' characters replaced by mixed ones. Its own spans are added to the base
spans where they touch none of them; base spans always stay.

Decoding is exact Viterbi. A token whose outside score leads by more than twice the range of the
transition scores is outside in every best path, so only the runs between such tokens need the dynamic
programme; runs of similar length are decoded together.

Base kinds, each leftmost and non-overlapping, with code point spans, end exclusive: ``assign`` (the value,
group 2, of at least 12 characters), ``access`` (at least 18 characters), ``hex`` (at least 16).

Defined cases: a null text counts as empty; texts without tokens have no spans; texts of any length are
scanned whole; repeated rows each get their row; an empty table, or one without any base span, leaves
the field untrained, and it then adds nothing; ids may be null; other columns are not read. Scanning needs
no shuffle; the broadcast model has a fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from wirelake.llm.common import byte_slices, materialise, mix64, span_hashes, texts_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so the length can stand in the pattern
CUES = ("passw", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "crf")
SAMPLE = 6000      # most texts to train on
WINDOWS = 4        # most windows a training text gives
REACH = 10         # tokens on either side of a window's centre
SLICE_BYTES = 1 << 20
HASHED = 4096
O, B, I = 0, 1, 2

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    out = []
    lowered = text.lower()
    if any(cue in lowered for cue in CUES):
        out += [(m.start(2), 0, m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


# character classes: 0 space, 1 digit, 2 lower a-z, 3 upper A-Z, 4 other letter, 5 punctuation
_CLASS = np.full(128, 5, dtype=np.uint8)
_CLASS[:33] = 0
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 1, 2, 3
_SPACES = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], dtype=np.uint32)

# feature families: name, number of buckets
FAMILIES = [("bias", 1), ("length", 24), ("mix", 6 * 8 * 2), ("changes", 8 * 24), ("shape", HASHED), ("vowels", 6 * 24), ("hex", 2 * 24),
            ("before", HASHED), ("before2", HASHED), ("after", HASHED), ("before_ends", 6 * 24), ("file", 16 * 5 * 2)]
OFFSETS = np.cumsum([0] + [n for _, n in FAMILIES])
WIDTH = int(OFFSETS[-1])


@dataclass
class Tokens:
    start: np.ndarray     # code point offsets inside the text
    end: np.ndarray
    text: np.ndarray      # which text of the slice
    features: np.ndarray  # [tokens, families], weight rows


def tokenise(texts: list[str]) -> Tokens:
    chars = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    text_end = np.cumsum([len(t) + 1 for t in texts])
    kind = np.where(chars < 128, _CLASS[np.minimum(chars, 127)], 4).astype(np.uint8)
    high = np.flatnonzero(chars >= 128)
    kind[high[np.isin(chars[high], _SPACES)]] = 0
    edge = np.diff(np.concatenate([[0], (kind > 0).view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.searchsorted(text_end, start, side="right")

    def per_token(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[end] - total[start]

    size = end - start
    digits, lower, upper, punct = (per_token(kind == k) for k in (1, 2, 3, 5))
    folded = np.where(kind == 3, chars + 32, chars)
    vowels = per_token(np.isin(folded, np.array([97, 101, 105, 111, 117], dtype=np.uint32)))
    hexes = per_token((kind == 1) | ((chars >= 97) & (chars <= 102)))
    new_run = np.concatenate([[True], kind[1:] != kind[:-1]])
    runs = per_token(new_run)
    run_at = np.flatnonzero(new_run)
    run_start = np.searchsorted(run_at, start)
    shape = span_hashes(kind[run_at], run_start, run_start + np.minimum(runs, 8)) if len(start) else np.zeros(0, np.uint64)
    word = span_hashes(folded, start, end) if len(start) else np.zeros(0, np.uint64)

    length = np.where(size < 16, size, np.minimum(23, 12 + np.log2(np.maximum(size, 1)).astype(np.int64)))
    safe = np.maximum(size, 1)
    mix = ((digits * 5 + safe - 1) // safe) * 16 + ((lower > 0) * 4 + (upper > 0) * 2 + (lower + upper + digits + punct < size)) * 2 + (punct > 0)
    first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
    hashed = (word % np.uint64(HASHED - 1)).astype(np.int64) + 1  # 0: no neighbour

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        if by > 0:
            out[by:] = values[:-by]
            out[by:][text[by:] != text[:-by]] = 0
        else:
            out[:by] = values[-by:]
            out[:by][text[:by] != text[-by:]] = 0
        return out

    tail = chars[end - 1] if len(end) else chars[:0]
    ends = np.select([tail == 61, tail == 58, tail == 34, tail == 46, kind[end - 1] == 5], [1, 2, 3, 4, 5], 0) if len(end) else np.zeros(0, np.int64)
    text_len = np.diff(np.concatenate([[0], text_end]))
    text_digits = np.add.reduceat((kind == 1).astype(np.int32), np.concatenate([[0], text_end[:-1]])) if texts else np.zeros(0, np.int32)
    text_equals = np.add.reduceat((chars == 61).astype(np.int32), np.concatenate([[0], text_end[:-1]])) if texts else np.zeros(0, np.int32)
    share = np.searchsorted([0.0, 0.01, 0.05, 0.2], text_digits / text_len, side="left")
    file = (np.minimum(15, np.log2(text_len).astype(np.int64)) * 5 + share) * 2 + (text_equals > 0)
    buckets = [np.zeros_like(size), length, mix, np.minimum(runs - 1, 7) * 24 + length, (shape % np.uint64(HASHED)).astype(np.int64),
               ((vowels * 5 + safe - 1) // safe) * 24 + length, (hexes == size) * 24 + length, shifted(hashed, 1), shifted(hashed, 2), shifted(hashed, -1),
               np.where(first, 0, shifted(ends, 1)) * 24 + length, file[text]]
    features = np.stack(buckets, axis=1) + OFFSETS[:-1]
    offset = np.concatenate([[0], text_end[:-1]])[text] if len(text) else text
    return Tokens(start - offset, end - offset, text, features)


def labels_of(tokens: Tokens, k: int, spans: list[Span]) -> np.ndarray:
    """B, I, O of text ``k``'s tokens: a token belongs to a base span that covers half of it or more."""
    lo, hi = np.searchsorted(tokens.text, [k, k + 1])
    start, end, out = tokens.start[lo:hi], tokens.end[lo:hi], np.zeros(hi - lo, dtype=np.int64)
    for a, _, b in spans:
        i, j = np.searchsorted(end, a, side="right"), np.searchsorted(start, b, side="left")
        covered = [t for t in range(i, j) if 2 * (min(b, end[t]) - max(a, start[t])) >= end[t] - start[t]]
        for n, t in enumerate(covered):
            out[t] = max(out[t], I) if n else B
    return out


@dataclass(frozen=True)
class Field:
    weights: np.ndarray      # [WIDTH, 3]
    transitions: np.ndarray  # [from, to]
    first: np.ndarray        # scores of a text's first tag

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for column in features.T:
            out += self.weights[column]
        return out

    def tags(self, tokens: Tokens) -> np.ndarray:
        """The best path's tag of every token, exactly."""
        score = self.emissions(tokens.features)
        out = np.zeros(len(score), dtype=np.int64)
        if not len(score):
            return out
        first = np.concatenate([[True], tokens.text[1:] != tokens.text[:-1]])
        last = np.concatenate([first[1:], [True]])
        spread = np.concatenate([self.transitions.ravel(), self.first])
        certain = score[:, O] - score[:, 1:].max(axis=1) > 2 * (spread.max() - spread.min())
        open_ = np.flatnonzero(~certain)
        if not len(open_):
            return out
        breaks = np.concatenate([[True], (np.diff(open_) > 1) | first[open_[1:]]])
        begin = open_[breaks]
        size = np.diff(np.concatenate([np.flatnonzero(breaks), [len(open_)]]))
        for bucket in np.unique(np.ceil(np.log2(size))):
            members = np.flatnonzero(np.ceil(np.log2(size)) == bucket)
            self._decode(score, begin[members], size[members], first, last, out)
        return out

    def _decode(self, score, begin, size, first, last, out) -> None:
        steps = int(size.max())
        best = score[begin] + np.where(first[begin][:, None], self.first, self.transitions[O])
        back = np.zeros((steps, len(begin), 3), dtype=np.int8)
        final = np.zeros((len(begin), 3))
        for t in range(steps):
            if t:
                via = best[:, :, None] + self.transitions
                back[t] = via.argmax(axis=1)
                best = via.max(axis=1) + score[np.minimum(begin + t, len(score) - 1)]
            ending = size == t + 1
            final[ending] = best[ending]
        final += np.where(last[begin + size - 1][:, None], 0.0, self.transitions[:, O])
        tag = final.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            inside = size > t
            out[begin[inside] + t] = tag[inside]
            if t:
                tag = np.where(inside, back[t][np.arange(len(begin)), tag], tag)


def fit(features: np.ndarray, tags: np.ndarray, sizes: np.ndarray, steps: int = 80, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Conditional likelihood by full-batch Adam. features: [windows, tokens, families], tags and sizes alike."""
    n, length, families = features.shape
    inside = np.arange(length) < sizes[:, None]
    w, trans, first = np.zeros((WIDTH, 3)), np.zeros((3, 3)), np.zeros(3)
    params = [w, trans, first]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    flat, used = features[inside], inside.sum()
    truth = np.zeros((n, length, 3))
    truth[np.arange(n)[:, None], np.arange(length), tags] = inside
    true_pairs = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    for step in range(1, steps + 1):
        score = np.zeros((n, length, 3))
        for k in range(families):
            score += w[features[:, :, k]]
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[:, 0] = first + score[:, 0]
        for t in range(1, length):
            go = lse(alpha[:, t - 1, :, None] + trans, 1) + score[:, t]
            alpha[:, t] = np.where(inside[:, t, None], go, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            go = lse(trans + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(inside[:, t + 1, None], go, 0.0)
        total = lse(alpha[:, -1], 1)
        belief = np.exp(alpha + beta - total[:, None, None]) * inside[:, :, None]
        pair = np.zeros((3, 3))
        for t in range(1, length):
            joint = np.exp(alpha[:, t - 1, :, None] + trans + (score[:, t] + beta[:, t])[:, None, :] - total[:, None, None])
            pair += (joint * inside[:, t, None, None]).sum(axis=0)
        slope = (truth - belief)[inside]
        gw = np.empty_like(w)
        for s in range(3):
            gw[:, s] = np.bincount(flat.ravel(), weights=np.repeat(slope[:, s], families), minlength=WIDTH)
        grads = [gw / used - decay * w / 10, (true_pairs - pair) / used - decay * trans, (truth[:, 0] - belief[:, 0]).sum(axis=0) / used - decay * first]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(w, trans, first)


BASE62 = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def disguised(text: str, spans: list[Span]) -> str:
    """The text with the letters and digits of its base spans replaced by hashed ones of all 62 kinds, so
    that the field learns mixed alphabets as well as the base patterns' own."""
    out = list(text)
    for a, _, b in spans:
        draw = mix64(np.arange(a, b, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(sum(map(ord, text[a:b]))))
        for k in range(a, b):
            if out[k].isalnum():
                out[k] = BASE62[int(draw[k - a] % np.uint64(62))]
    return "".join(out)


def _windows(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, tags) of at most WINDOWS windows per text, around its first base spans, then at hashed
    places; and as many again of a text with base spans, for its disguised form."""
    spans = [base_spans(t) for t in texts]
    texts = texts + [disguised(t, s) for t, s in zip(texts, spans) if s]
    spans = spans + [s for s in spans if s]
    tokens = tokenise(texts)
    for k in range(len(texts)):
        lo, hi = np.searchsorted(tokens.text, [k, k + 1])
        if lo == hi:
            continue
        tags = labels_of(tokens, k, spans[k])
        centres = np.flatnonzero(tags == B)[: WINDOWS - 1].tolist()
        places = mix64(np.arange(WINDOWS, dtype=np.uint64) + np.uint64(hi - lo)) % np.uint64(hi - lo)
        taken = np.zeros(hi - lo, dtype=bool)
        for c in (centres + places.tolist())[:WINDOWS]:
            a, b = max(0, int(c) - REACH), min(hi - lo, int(c) + REACH + 1)
            if not taken[a:b].any():
                taken[a:b] = True
                yield tokens.features[lo + a : lo + b], tags[a:b]


# A text without a match of this (Java's syntax) holds no base span.
MAY_HOLD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Field | None:
    """A field for these documents, or None where no document with an id holds a base span. Half of the sample are
    documents that may hold one, so it has examples however rare they are."""
    ids = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.coalesce(F.col(text_col).rlike(MAY_HOLD), F.lit(False))).alias("holds"))
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    halves = [ids.filter(F.col("holds") == side).select("id").orderBy(*order).limit(SAMPLE // 2) for side in (True, False)]
    chosen = materialise(halves[0].unionByName(halves[1]), "crf-ids")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id").agg(F.min("text").alias("text"))
    size = 2 * REACH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0), []
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                for row in range(start, stop):
                    found += [(ids[row].as_py(), f.astype(np.int16).tobytes(), t.astype(np.int8).tobytes()) for f, t in _windows(texts_of(batch.column(1), row, row + 1))]
            yield pa.RecordBatch.from_arrays([pa.array([str(x[0]) for x in found], pa.string()), pa.array([x[1] for x in found], pa.binary()), pa.array([x[2] for x in found], pa.binary())], ["id", "features", "tags"])

    rows = texts.mapInArrow(run, "id string, features binary, tags binary").toPandas()  # at most 2 x SAMPLE x WINDOWS small windows
    rows = rows.sort_values(["id", "features"])
    if not any(1 in t for t in rows["tags"]):
        return None
    features = np.zeros((len(rows), size, len(FAMILIES)), dtype=np.int64)
    tags, sizes = np.zeros((len(rows), size), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for k, (f, t) in enumerate(zip(rows["features"], rows["tags"])):
        sizes[k] = len(t)
        features[k, : len(t)] = np.frombuffer(f, dtype=np.int16).reshape(-1, len(FAMILIES))
        tags[k, : len(t)] = np.frombuffer(t, dtype=np.int8)
    return fit(features, tags, sizes)


_EDGE = re.compile(r"[A-Za-z0-9](?:.*[A-Za-z0-9])?", re.DOTALL)


def scan(texts: list[str], field: Field | None) -> list[list[Span]]:
    """All spans of every text, by start, then kind."""
    found = [base_spans(t) for t in texts]
    if field is None:
        return found
    tokens = tokenise(texts)
    tags = field.tags(tokens)
    tagged, t = np.flatnonzero(tags != O), 0
    while t < len(tagged):
        at, k = tagged[t], tokens.text[tagged[t]]
        stop = t + 1
        while stop < len(tagged) and tagged[stop] == tagged[stop - 1] + 1 and tags[tagged[stop]] == I and tokens.text[tagged[stop]] == k:
            stop += 1
        a, b = int(tokens.start[at]), int(tokens.end[tagged[stop - 1]])
        core = _EDGE.search(texts[k][a:b])  # without quotes and punctuation around it
        if core:
            a, b = a + core.start(), a + core.end()
            if all(b <= s or a >= e for s, kind, e in found[k] if kind != 3):
                found[k].append((a, 3, b))
        t = stop
    return [sorted(spans) for spans in found]


def find_secrets(docs: DataFrame, field: Field | None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, spans (array of start, kind, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                spans = [[{"start": a, "kind": KINDS[kind], "end": b} for a, kind, b in row] for row in scan(texts_of(batch.column(1), start, stop), shared.value)]
                kind = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(spans, pa.list_(kind))], ["id", "spans"])

    picked = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())])
    return picked.mapInArrow(run, T.StructType([picked.schema["id"], T.StructField("spans", T.ArrayType(span))])).withColumnRenamed("id", id_col)


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans (text), n_crf from find_secrets' rows."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col(id_col), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), count("crf").alias("n_crf"))
