"""Quality by perplexity under an interpolated modified Kneser-Ney character model of trusted text.

Every language has its own model of order ``ORDER``, counted over all trusted texts (labels.quality = 1) of
the language, but for the held-out fifth from which the thresholds are taken. Texts are padded with a start
mark and an end mark, so every character and the end are predicted.

*Blocks.* Documents are dealt into blocks by a hash of their id and of their text (``SALTS`` blocks for an id, so that
an id with very many rows is spread), compressed by the tasks that read them; that is the only move of texts, once
for counting and once for scoring. *Counting.* Next to the trusted ids of its block, a task finds the block's distinct
n-grams, far fewer than its characters, and how often each occurs in trusted texts. The counts are added up by
n-gram; lower orders, context totals and discounts are aggregations of that table. *Scoring.* The blocks'
n-grams are joined with the count tables, each sharded by its own key. The tasks of that join pack their answers by
block, so that few rows are moved and sorted. The answers are written as one row per block: a number for each of its
n-grams, in the order of their hashes, and no n-grams, so the files of that join are gone before the texts move again.
The block then lists its n-grams anew, in the same order, and adds the numbers up along every whole text. The volume
of n-grams grows with the number of blocks.
*Threshold.* A language's threshold is the ``QUANTILE`` of the perplexity of its n held-out trusted texts, times
1 + 1/n: a quantile of a dozen texts is uncertain, and of hundreds is not. There is no other margin, since junk
made of a repeated word lies close above the quantile (character n-grams hardly see the repeats).

Characters rather than words: at 30 GB the distinct word n-grams of all documents alone are several times
the disk that scoring may take, as nearly every word trigram of a text is new.

Defined cases: a null text counts as empty; empty texts have a null perplexity and are not kept; the null
language is a language of its own; documents of a language without trusted text have a null perplexity and
threshold and are kept, since nothing is known against them; labels repeated for an id count as trusted if
any is; rows of equal id are scored one by one, as are repeated rows; rows without an id are dealt by their text;
U+0000 is taken for U+0001, and U+0002 and U+0003 in a text are the same characters as its marks; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wirelake.llm.common import Index, byte_slices, discard, materialise, mix64

ORDER = 5
QUANTILE = 0.95
HELD_OUT_OF = 5            # one trusted text in so many sets thresholds instead of being counted
BLOCK_BYTES = 16 << 20     # text in one block, about
PACK_BYTES = 4 << 20       # text that is sorted into blocks and compressed at a time
SLICE_BYTES = 1 << 20
GATHERED = 1 << 20         # answers that a task holds to pack them by block
CHUNK = 1 << 14            # n-grams that are hashed at a time, so that they stay in a core's cache
SALTS = 8                  # blocks over which the rows of one id are spread
START, END = "\x02", "\x03"
NUL = "\x01"  # stands for U+0000, which numpy drops at the end of a string
PAD = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with its marks, and how many n-grams each text has."""
    lead = START * (ORDER - 1)
    joined = "".join([f"{lead}{t}{END}" for t in texts]).replace("\0", NUL)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return chars, np.array([len(t) + 1 for t in texts], dtype=np.int64)


def _gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of chars[i : i + ORDER] for every i."""
    n = max(0, len(chars) - ORDER + 1)
    out = np.zeros(n, dtype=np.uint64)
    for at in range(0, n, CHUNK):
        some = out[at : at + CHUNK]
        for k in range(ORDER):
            some *= PAD
            some += chars[at + k : at + k + len(some)]
        some[:] = mix64(some)
    return out


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Whether an n-gram stands at each position; those that would reach from one text into the next are left out."""
    ends = np.cumsum(sizes + ORDER - 1)
    inside = np.ones(int(ends[-1]) if len(ends) else 0, dtype=bool)
    for k in range(1, ORDER):
        inside[ends - k] = False
    return inside[: max(0, len(inside) - ORDER + 1)]


def _unique(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often each occurs; a plain sort is several times faster than np.unique."""
    ordered = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[first], np.diff(np.append(first, len(ordered)))


class _Distinct:
    """Hash (in order), n-gram and count of the distinct n-grams of the texts added so far."""

    def __init__(self):
        self.hashes, self.grams, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=f"<U{ORDER}"), np.zeros(0, dtype=np.int64)

    def add(self, texts: list[str], counted: bool) -> None:
        chars, sizes = _codes(texts)
        inside = _starts(sizes)
        hashes = _gram_hashes(chars)[inside]
        found, counts = _unique(hashes)
        place = np.searchsorted(self.hashes, found)
        old = np.zeros(len(found), dtype=bool)
        within = place < len(self.hashes)
        old[within] = self.hashes[place[within]] == found[within]
        if counted:
            self.counts[place[old]] += counts[old]
        new = found[~old]
        if len(new):  # n-grams are made of these only, from one of the places of each
            top = np.zeros(1 << 20, dtype=bool)
            top[new >> np.uint64(44)] = True
            maybe = np.flatnonzero(top[hashes >> np.uint64(44)])
            which = np.minimum(np.searchsorted(new, hashes[maybe]), len(new) - 1)
            same = new[which] == hashes[maybe]
            at = np.zeros(len(new), dtype=np.int64)
            at[which[same]] = maybe[same]
            windows = np.ascontiguousarray(chars[np.flatnonzero(inside)[at][:, None] + np.arange(ORDER)])
            place = place[~old]
            self.hashes = np.insert(self.hashes, place, new)
            self.grams = np.insert(self.grams, place, windows.view(f"<U{ORDER}").ravel())
            self.counts = np.insert(self.counts, place, counts[~old] if counted else 0)


def _languages(langs) -> list:
    """Distinct languages in a fixed order, the null language last."""
    return sorted(set(langs), key=lambda x: (x is None, x))


def _by_language(langs: list, texts: list) -> Iterator[tuple]:
    """(language, its texts' positions, its texts), the null language last."""
    for lang in _languages(langs):
        at = [k for k, x in enumerate(langs) if x == lang]
        yield lang, at, [texts[k] or "" for k in at]


class _Blocks:
    """The documents dealt into blocks; ``dealt`` (block, packed) is planned anew for each job that reads it."""

    def __init__(self, docs: DataFrame, text_col: str, id_col: str, lang_col: str):
        self.rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES))

    def block_of(self, *key: Column) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.count))

    def dealt(self) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            for batch in batches:
                for start, stop in byte_slices(batch.column(3), PACK_BYTES):
                    part = batch.slice(start, stop - start)
                    block = np.asarray(part.column(0))
                    part = pa.RecordBatch.from_arrays(part.columns[1:], ["id", "lang", "text"]).take(pa.array(np.argsort(block, kind="stable")))
                    names, sizes = np.unique(block, return_counts=True)
                    packed = []
                    for at, n in zip(np.cumsum(sizes) - sizes, sizes):
                        sink = pa.BufferOutputStream()
                        with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                            out.write_batch(part.slice(int(at), int(n)))
                        packed.append(sink.getvalue().to_pybytes())
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(packed, pa.binary())], ["block", "packed"])

        block = F.when(F.col("id").isNull(), self.block_of(F.col("text"))).otherwise(self.block_of(F.col("id"), F.pmod(F.xxhash64("text"), F.lit(SALTS))))
        return self.rows.select(block.alias("block"), "id", "lang", "text").mapInArrow(pack, "block long, packed binary").repartition(self.count, "block")


def _unpacked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The documents (id, lang, text) of a block, a slice at a time."""
    for packed in table.column("packed"):
        for batch in pa.ipc.open_stream(packed.as_buffer()):
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                yield batch.slice(start, stop - start)


def gram_counts(blocks: _Blocks, trusted_ids: DataFrame) -> DataFrame:
    """block, at, lang, gram, count: a block's distinct n-grams, numbered by language and hash, and how often they occur
    in its trusted texts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        trusted, found = set(right.column("id").to_pylist()), {}
        for batch in _unpacked(left):
            ids, langs, texts = (c.to_pylist() for c in batch.columns)
            for lang, at, _ in _by_language(langs, texts):
                for is_trusted in (True, False):
                    some = [texts[k] for k in at if texts[k] and (ids[k] in trusted) == is_trusted]
                    if some:
                        found.setdefault(lang, _Distinct()).add(some, is_trusted)
        langs = _languages(found)
        merged = [_Distinct(), *[found[lang] for lang in langs]]  # an empty one, for blocks without texts
        of = pa.array(np.repeat(np.arange(len(langs)), [len(m.hashes) for m in merged[1:]]), pa.int64())
        block = left.column("block")[0].as_py() if left.num_rows else 0
        return pa.table({"block": pa.array(np.full(len(of), block, dtype=np.int64)), "at": pa.array(np.arange(len(of), dtype=np.int32)), "lang": pa.array(langs, pa.string()).take(of),
                         "gram": pa.array(np.concatenate([m.grams for m in merged]), pa.string()), "count": pa.array(np.concatenate([m.counts for m in merged]))})

    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    ids = trusted_ids.filter("id IS NOT NULL").select("id", salts).select("id", blocks.block_of(F.col("id"), F.col("salt")).alias("block"))
    seen = blocks.dealt().groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(run, "block long, at int, lang string, gram string, count long")
    return seen.withColumn("lang", _lang_key())


def _lang_key(col: str = "lang") -> Column:
    """A key that joins null with null."""
    return F.when(F.col(col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(col)))


class Model:
    """For every order n: ``grams[n]`` (lang, gram, share: discounted probability) and ``contexts[n]``
    (lang, context, back: weight of the lower order), and ``floor`` (lang, uniform)."""

    def __init__(self, counts: DataFrame):
        counts = materialise(counts, "kn-counts")
        self.levels = [counts]
        self.grams, self.contexts, level = {}, {}, counts
        for n in range(ORDER, 0, -1):
            of = F.least(F.col("count"), F.lit(4))
            tally = level.groupBy("lang").agg(*[F.count_if(of == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
            y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

            def discount(k: int) -> Column:
                """Modified Kneser-Ney's k - (k + 1) Y n(k+1) / n(k), kept inside (0, k]; half a count where there is too little to tell."""
                raw = F.lit(float(k)) - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0))
                return F.when((F.col(f"n{k}") > 0) & (raw > 0) & (raw <= k), raw).otherwise(F.lit(0.5 if k == 1 else 0.75)).alias(f"d{k}")

            discounts = tally.select("lang", discount(1), discount(2), discount(3))  # one row for each language
            rows = level.join(discounts, "lang").withColumn("context", F.expr(f"left(gram, {n - 1})"))
            rows = rows.withColumn("d", F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2")).otherwise(F.col("d3")))
            contexts = rows.groupBy("lang", "context").agg(F.sum("count").cast("double").alias("total"), F.sum("d").alias("held"))
            self.grams[n] = materialise(rows.join(contexts, ["lang", "context"]).select("lang", "gram", ((F.col("count") - F.col("d")) / F.col("total")).alias("share")), f"kn-grams-{n}")
            self.contexts[n] = materialise(contexts.select("lang", "context", (F.col("held") / F.col("total")).alias("back")), f"kn-contexts-{n}")
            if n > 1:  # continuation counts: how many different characters precede
                level = materialise(level.groupBy("lang", F.expr(f"right(gram, {n - 1})").alias("gram")).agg(F.count(F.lit(1)).alias("count")), f"kn-level-{n - 1}")
                self.levels.append(level)
        self.floor = materialise(level.groupBy("lang").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("uniform")), "kn-floor")

    def log_probabilities(self, wanted: DataFrame) -> DataFrame:
        """lang, gram (distinct, of the highest order) -> lang, gram, logp; languages without a model drop out.

        Order by order from the lowest: an order's distinct n-grams are joined with its shares, its back-off
        weights, and the probability of their suffix one order below."""
        levels = {ORDER: wanted}
        for n in range(ORDER - 1, 0, -1):
            levels[n] = levels[n + 1].select("lang", F.expr(f"right(gram, {n})").alias("gram")).distinct()
        below = self.floor.select("lang", F.lit("").alias("gram"), F.col("uniform").alias("p"))
        for n in range(1, ORDER + 1):
            rows = levels[n].select("lang", "gram", F.expr(f"left(gram, {n - 1})").alias("context"), F.expr(f"right(gram, {n - 1})").alias("suffix"))
            rows = rows.join(self.grams[n], ["lang", "gram"], "left").join(self.contexts[n], ["lang", "context"], "left")
            rows = rows.join(below.withColumnRenamed("gram", "suffix"), ["lang", "suffix"])
            below = rows.select("lang", "gram", (F.coalesce("share", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")).alias("p"))
            if n < ORDER:
                below = materialise(below, f"kn-p-{n}")
                self.levels.append(below)
        return below.select("lang", "gram", F.log("p").alias("logp"))

    def discard(self) -> None:
        """Drop the files of all tables; the model can't be used afterwards."""
        discard(*self.levels, *self.grams.values(), *self.contexts.values(), self.floor)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, at, logp -> block, n, packed: a row for each block and GATHERED answers of the task, a third of the bytes to move."""
    held, rows = [], 0

    def flush() -> pa.RecordBatch:
        block, at, logp = (np.concatenate([np.asarray(batch.column(k)) for batch in held]) for k in range(3))
        order = np.lexsort((at, block))
        block, at, logp = block[order], at[order], logp[order]
        names, first, counts = np.unique(block, return_index=True, return_counts=True)
        packed = []
        for start, n in zip(first, counts):
            steps = np.diff(at[start : start + n], prepend=np.int32(0)).astype("<i4")
            packed.append(pa.compress(steps.tobytes() + logp[start : start + n].astype("<f4").tobytes(), codec="zstd", asbytes=True))
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "n", "packed"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED:
            yield flush()
            held, rows = [], 0
    if rows:
        yield flush()


def _spread(n: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places (ascending) and numbers of a row of ``_gathered``."""
    both = pa.decompress(packed, decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(both, dtype="<i4", count=n)), np.frombuffer(both, dtype="<f4", offset=4 * n)


def perplexities(docs: DataFrame, trusted_ids: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, lang, perplexity under the model of the trusted texts (``trusted_ids``: id), empty."""
    blocks = _Blocks(docs, text_col, id_col, lang_col)
    seen = materialise(gram_counts(blocks, trusted_ids), "kn-seen")
    totals = seen.groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    model = Model(totals.filter("count > 0"))
    known = materialise(model.log_probabilities(totals.select("lang", "gram")), "kn-known")
    model.discard()
    answers = seen.join(known, ["lang", "gram"]).select("block", "at", F.col("logp").cast("float").alias("logp")).mapInArrow(_gathered, "block long, n int, packed binary")

    def numbered(rows: pa.Table) -> pa.Table:
        parts = [_spread(n, packed) for n, packed in zip(rows.column("n").to_pylist(), rows.column("packed").to_pylist())]
        numbers = np.full(int(max(at[-1] for at, _ in parts)) + 1, np.nan, dtype=np.float32)
        for at, logp in parts:
            numbers[at] = logp
        return pa.table({"block": rows.column("block").slice(0, 1), "numbers": pa.array([numbers.tobytes()], pa.binary())})

    answers = materialise(answers.groupBy("block").applyInArrow(numbered, "block long, numbers binary"), "kn-answers")
    discard(seen, known)  # what is read below are the answers and the documents

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        found, slices = {}, []
        for batch in _unpacked(left):  # the block's n-grams, numbered as they were before
            texts, hashed = batch.column(2).to_pylist(), []
            for lang, at, some in _by_language(batch.column(1).to_pylist(), texts):
                at, some = [k for k, t in zip(at, some) if t], [t for t in some if t]
                if some:
                    chars, sizes = _codes(some)
                    hashes = _gram_hashes(chars)[_starts(sizes)]
                    hashed.append((lang, at, hashes, sizes))
                    parts = found.setdefault(lang, [])
                    parts.append(_unique(hashes)[0])
                    if len(parts) > 8:
                        found[lang] = [_unique(np.concatenate(parts))[0]]
            slices.append((batch.column(0), batch.column(1), [not t for t in texts], hashed))
        numbers = np.frombuffer(right.column("numbers")[0].as_py() if right.num_rows else b"", dtype=np.float32).astype(np.float64)
        tables, first = {}, 0
        for lang in _languages(found):
            hashes = _unique(np.concatenate(found.pop(lang)))[0]
            mine = numbers[first : first + len(hashes)]
            first += len(hashes)
            if len(mine) and not np.isnan(mine[0]):  # else the language has no model
                tables[lang] = (Index(hashes), mine)
        out = []
        for ids, langs, empty, hashed in slices:
            perplexity = [None] * len(empty)
            for lang, at, hashes, sizes in hashed:
                if lang in tables:
                    logp = tables[lang][1][tables[lang][0].find(hashes)]
                    for k, value in zip(at, np.exp(-np.add.reduceat(logp, np.cumsum(sizes) - sizes) / sizes)):
                        perplexity[k] = float(value)
            hashed.clear()
            out.append(pa.RecordBatch.from_arrays([ids, langs, pa.array(perplexity, pa.float64()), pa.array(empty, pa.bool_())], ["id", "lang", "perplexity", "empty"]))
        return pa.Table.from_batches(out, schema=to_arrow_schema(schema))

    schema = T.StructType([blocks.rows.schema["id"], blocks.rows.schema["lang"], T.StructField("perplexity", T.DoubleType()), T.StructField("empty", T.BooleanType())])
    return blocks.dealt().groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, schema)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, text_col: str = "text",
            id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, lang, perplexity, threshold (of its language), keep."""
    trusted = labels.filter("quality = 1").select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    held_out = F.pmod(F.xxhash64("id"), F.lit(HELD_OUT_OF)) == 0
    scored = materialise(perplexities(docs, trusted.filter(~held_out), text_col, id_col, lang_col), "kn-scored")
    limits = scored.join(trusted.filter(held_out), "id", "left_semi").filter("perplexity IS NOT NULL").groupBy("lang").agg(
        (F.percentile_approx("perplexity", quantile, 10000) * (1 + 1 / F.count("perplexity"))).alias("threshold"))
    rows = scored.join(limits.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")), "left")
    keep = ~F.col("empty") & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return rows.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), "perplexity", "threshold", keep.alias("keep"))
