"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic rows of the training folds are the positives; all texts of the training folds, whatever
their labels, are the unlabelled sample. A linear model over presence and density of word and word-prefix
hashes is fitted with numpy on the non-negative risk estimate

    risk = prior * mean_pos(loss+) + max(0, mean_unl(loss-) - prior * mean_pos(loss-))

where ``prior`` is the share of toxic rows, estimated from the training folds' labels. Rows whose
``crc32(doc_id as text) mod 3`` is 1 are held out: neither their labels nor their texts are used.

The fit uses a bounded, documented sample: the ``POSITIVES`` toxic rows and ``UNLABELLED`` rows with the
smallest hash of their id. Feature selection runs as a Spark aggregation over that sample; only the
``FEATURES`` chosen hashes and the sample's small matrix of their counts reach the driver. Scoring reads
every whole text where it lies, without a shuffle; the broadcast model has a fixed size.

Defined cases: a null text counts as empty; texts without words get the score of the bias alone; a null
id is in the training folds but has no label; without any positive example every score is the prior;
repeated rows each get their row; labels repeated for an id count as toxic if any of them is; an empty
table gives an empty result. ``score`` reads only id and text, ``reject`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wirelake.llm.common import byte_slices, materialise, mix64, span_hashes, texts_of

POSITIVES = 4000     # most toxic rows to learn from
UNLABELLED = 8000    # most unlabelled rows to learn from
FEATURES = 512       # hashes kept by the feature selection
PREFIXES = (3, 4, 5, 6, 7)
HASH_BITS = 22
MOST_COUNTED = 255   # more occurrences of a hash in a text count as so many, in the fit and in scores
THRESHOLD = 0.7
HELD_OUT = 1         # remainder modulo 3 of the rows never learnt from
SLICE_BYTES = 1 << 20

_LETTER = np.zeros(128, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True


def fold(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, feature hash), how often, and the number of words per text."""
    lowered = [t.lower() for t in texts]
    chars = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    letter = np.where(chars < 128, _LETTER[np.minimum(chars, 127)], (chars < 0x2000) | (chars > 0x206F)) & (chars != 0xA0) & (chars != 0x3000)
    edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(ends, starts, side="right")
    words = np.bincount(doc, minlength=len(texts))
    parts = [span_hashes(chars, starts, stops)]
    docs = [doc]
    for n in PREFIXES:
        long = stops - starts > n
        parts.append(span_hashes(chars, starts[long], starts[long] + n) + np.uint64(n))
        docs.append(doc[long])
    bucket = mix64(np.concatenate(parts)) >> np.uint64(64 - HASH_BITS)
    both = (np.concatenate(docs).astype(np.uint64) << np.uint64(HASH_BITS)) | bucket
    keys, counts = np.unique(both, return_counts=True)
    return (keys >> np.uint64(HASH_BITS)).astype(np.int64), (keys & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64), counts, words


def inputs(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Model inputs from the chosen features' counts: presence, and share among the text's words."""
    density = np.minimum(1.0, 2.0 * counts / np.sqrt(np.maximum(words, 1.0))[:, None])
    return np.concatenate([(counts > 0).astype(np.float32), density.astype(np.float32)], axis=1)


@dataclass(frozen=True)
class Model:
    features: np.ndarray   # sorted feature hashes
    weights: np.ndarray    # presence weights, then density weights
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        k = len(self.features)
        doc, feature, count, words = word_features(texts)
        logit = np.full(len(texts), self.bias)
        if k and len(feature):
            at = np.minimum(np.searchsorted(self.features, feature), k - 1)
            hit = self.features[at] == feature
            doc, at, count = doc[hit], at[hit], np.minimum(count[hit], MOST_COUNTED)
            density = np.minimum(1.0, 2.0 * count / np.sqrt(np.maximum(words[doc], 1.0)))
            logit += np.bincount(doc, weights=self.weights[at] + self.weights[k + at] * density, minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 1200, rate: float = 0.05, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the non-negative risk with the logistic loss. When the negative part of the
    estimate falls below zero, only its gradient is followed upwards, as in non-negative PU learning."""
    w, b = np.zeros(pos.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        zp, zu = np.clip(pos @ w + b, -30, 30), np.clip(unl @ w + b, -30, 30)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
        gp_neg, gu_neg = -prior * sp / len(zp), su / len(zu)  # slopes of the negative part
        if negative >= 0:
            gp, gu = prior * (sp - 1) / len(zp) + gp_neg, gu_neg
        else:
            gp, gu = -gp_neg, -gu_neg
        grad = np.concatenate([gp @ pos + gu @ unl + decay * prior * w, [gp.sum() + gu.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def _sample(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, float | None]:
    """The bounded training rows (positive: boolean, text), and the prior. Ids are chosen first, on
    narrow rows; the at most POSITIVES + UNLABELLED chosen ids are then small enough to broadcast."""
    train = fold(F.col("id")) != HELD_OUT
    marks = labels.select(F.col(id_col).alias("id"), "toxic").filter("id IS NOT NULL AND toxic IS NOT NULL").filter(train)
    marks = marks.groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    prior = marks.agg(F.avg("toxic")).first()[0]
    order = F.xxhash64(F.col("id").cast("string"))
    there = docs.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").filter(train)
    toxic = marks.filter("toxic = 1").join(there.distinct(), "id", "left_semi")
    toxic = toxic.select("id", F.lit(True).alias("positive")).orderBy(order, "id").limit(POSITIVES)
    plain = there.distinct().select("id", F.lit(False).alias("positive")).orderBy(order, "id").limit(UNLABELLED)
    chosen = materialise(toxic.unionByName(plain), "pu-ids")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "positive").agg(F.min("text").alias("text"))
    return materialise(rows.select("positive", "text"), "pu-sample"), prior


def _feature_counts(sample: DataFrame) -> DataFrame:
    """In how many positive and unlabelled sample texts each hash occurs, summed per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << HASH_BITS), dtype=np.int32)
        for batch in batches:
            positive = np.asarray(batch.column(0), dtype=bool)
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                doc, feature, _, _ = word_features(texts_of(batch.column(1), start, stop))
                for side in (0, 1):
                    np.add.at(total[side], feature[positive[start:stop][doc] == bool(side)], 1)
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[1][seen].astype(np.int64)), pa.array(total[0][seen].astype(np.int64))], ["feature", "pos", "unl"])

    return sample.mapInArrow(run, "feature long, pos long, unl long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))


def _sample_matrix(sample: DataFrame, features: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                doc, feature, count, words = word_features(texts_of(batch.column(1), start, stop))
                at = np.minimum(np.searchsorted(features, feature), len(features) - 1)
                hit = features[at] == feature
                block = np.zeros((stop - start, len(features)), dtype=np.uint8)
                block[doc[hit], at[hit]] = np.minimum(count[hit], MOST_COUNTED)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array([r.tobytes() for r in block], pa.binary()), pa.array(words.astype(np.int64))],
                                                 ["positive", "counts", "words"])

    return sample.mapInArrow(run, "positive boolean, counts binary, words long")


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    sample, prior = _sample(docs, labels, text_col, id_col)
    n_pos, n_unl = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    prior = min(max(prior or 0.0, 1e-9), 1 - 1e-9)  # it is the method's correction: only its logarithms need a guard
    bare = Model(np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    if not n_pos or not n_unl:
        return bare
    # log-likelihood ratio of the feature's share among positives against its share among unlabelled texts
    p, u = (F.col("pos") + 0.5) / (n_pos + 1.0), (F.col("unl") + 0.5) / (n_unl + 1.0)
    gain = F.col("pos") * F.log(p / u) + (F.lit(n_pos) - F.col("pos")) * F.log((1 - p + 1e-9) / (1 - u + 1e-9))
    ranked = _feature_counts(sample).filter((F.col("pos") >= 3) & (p > u)).select("feature", gain.alias("gain"))
    features = np.sort(np.array([r.feature for r in ranked.orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()], dtype=np.int64))
    if not len(features):
        return bare
    rows = _sample_matrix(sample, features).toPandas()  # at most (POSITIVES + UNLABELLED) x FEATURES bytes
    counts = np.frombuffer(b"".join(rows["counts"]), dtype=np.uint8).reshape(-1, len(features))
    order = np.lexsort((*counts.T[:8], rows["words"].to_numpy(), rows["positive"].to_numpy()))  # sums must not depend on the order of arrival
    x, positive = inputs(counts[order].astype(np.float64), rows["words"].to_numpy()[order]), rows["positive"].to_numpy(dtype=bool)[order]
    w, b = fit_nnpu(x[positive].astype(np.float64), x[~positive].astype(np.float64), prior)
    return Model(features, w, b)


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    return _scored(docs.select(id_col, text_col), model, text_col).select(
        F.col(f"row.{id_col}").alias(id_col), (fold(F.col(f"row.{id_col}")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    return _scored(docs, model, text_col).filter(F.col("score") < threshold).select("row.*")


def _scored(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field(at)
            for start, stop in byte_slices(texts, SLICE_BYTES):
                scores = shared.value.scores(texts_of(texts, start, stop))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(scores, pa.float64())], ["row", "score"])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())]))
