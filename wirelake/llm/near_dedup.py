"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text is its words (lower case, split at white space); its k-mers are runs of ``K`` words, numbered by
occurrence so that repeats stay apart. For each of ``BANDS`` hash functions the sketch takes the ``TAKE``
smallest numbered k-mers and hashes them in their text order: two texts agree in a band when they share
those k-mers in the same order, which falls with edit distance, not only with set overlap. Texts that
agree in a band are candidates. A candidate pair is a link when its alignment similarity,
``1 - edit_distance(words) / max(words)``, is ``SIMILARITY`` or more. Alignment is exact: a band of diagonals,
column by column as bit-vectors, stopped as soon as no path can stay within the limit, and widened until it
covers the distance or the limit.

Equal texts are one node throughout (numbered, 8 bytes), so a group of copies costs one row. With each node goes a
profile, counts of its words in ``BINS`` bins: words that only one side has must be edited, so most pairs that can't
be alike are dropped by their profiles, before any words move. Candidates are covered in three steps:

1. every member of a bucket against the bucket's smallest node (a minimum per bucket, joined back: no bucket is
   gathered), here and below only where the numbers of their words allow the similarity;
2. among the nodes whose profiles passed in step 1, every member against one more node of its bucket, drawn by
   hash, so that the buckets of a large group have different ones: few texts of a group stay apart by chance;
3. among the texts in buckets that still hold several components, every pair across components that can have the
   similarity, found by an exact prefix filter on rare runs of ``RUN`` words, so that no link is lost and texts that
   share no more than a common passage make few pairs. The order of the runs may be any fixed one for the filter to be
   exact; it comes from a fixed number of hashed counters, so each task picks its texts' rarest runs by itself, and
   only those are shuffled. A run that both texts have once must stand at about the same place in both, a pair is
   made at the first such runs that its texts share, not at each, and only if enough runs follow those, and where the
   texts' signs (a bit per bin of words, odd or even) can be those of texts that are alike. Of the
   pairs of short texts, and those of longer ones whose profiles pass, those whose bags (as profiles, with two to four
   bins per word) can't be alike are dropped before any words move: texts of one vocabulary have similar profiles,
   and words are two to four times as large. Among texts of one vocabulary the runs that two share by chance, and with
   them the pairs, still grow faster than the texts; most end at the signs, in the join. What is left are texts just
   below the similarity; every two of them from different components are a pair, so the pairs of a large group of such
   texts grow with its square.

Pairs inside one component can't change any class and are skipped.

Pairs with scattered word edits agree in about 0.14 of the bands at alignment similarity 0.8, 0.23 at 0.85 and
0.37 at 0.9; all 32 bands miss with a probability of about 0.8%, 0.02% and 4e-7. In 250 simulated pairs for each
of 60 and 300 words, 0.992 and 0.996 were candidates at 0.8, and all at 0.85 and 0.9. Edits that stand together
leave more k-mers whole, so such pairs are missed more rarely.

Defined cases: a null text counts as empty; texts without words are equal to each other only when their
characters are; texts of less than K words have one k-mer, all their words; ids may repeat or be null (a
class's id is its smallest id, null when all are); repeated rows share a class; an empty table gives an
empty result. ``near_classes`` reads only id and text; ``near_dedup`` keeps all columns.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wirelake.llm.common import byte_slices, discard, materialise, mix64, span_hashes, texts_of
from wirelake.llm.components import components

K = 3
TAKE = 2
BANDS = 32
SIMILARITY = 0.8
BINS = 128
RUN = 2             # words of a run in step 3
COUNTERS = 1 << 22  # of the order of runs in step 3
PLACES = 1 << 20    # places in a text that are told apart; runs further on count as runs that occur again
EARLIER = 4         # rare runs before one that are compared, so that a pair isn't made again at each of its runs
SIGNS = 8           # 64-bit numbers of a text's signs in step 3
MOST_BAG_BITS = 20  # a bag has 2^20 bins at most, half a megabyte
SHORT = 1024        # words of a text whose bag, a kilobyte at most, is tested without its profile
SLICE_BYTES = 1 << 20
PAIR_ROWS = 4096
SEEDS = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def text_key(text_col: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of a text."""
    chars = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(chars):
        return np.zeros(0, dtype=np.uint64)
    gaps = np.flatnonzero(chars == 32)
    return span_hashes(chars, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(chars)]]))


def numbered_kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers in text order, each told apart by how often it occurred before."""
    return _numbered_kmers(words, k)[0]


def _numbered_kmers(words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``numbered_kmers``, and which of them occur once."""
    if not len(words):
        return words, np.zeros(0, dtype=bool)
    n = max(1, len(words) - k + 1)
    starts = np.arange(n)
    kmers = span_hashes(words, starts, np.minimum(starts + k, len(words)))
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    run_start = np.maximum.accumulate(np.where(first, starts, 0))
    number, once = np.empty(n, dtype=np.uint64), np.empty(n, dtype=bool)
    number[order] = starts - run_start
    once[order] = first & np.append(first[1:], True)
    return mix64(kmers + number * np.uint64(0xC2B2AE3D27D4EB4F)), once


def sketch(words: np.ndarray) -> np.ndarray:
    """One value per band: the TAKE smallest numbered k-mers under the band's hash, in text order."""
    kmers = numbered_kmers(words)
    if not len(kmers):
        return np.zeros(0, dtype=np.int64)
    out = np.empty(BANDS, dtype=np.uint64)
    step = max(1, (1 << 20) // len(kmers))
    for at in range(0, BANDS, step):
        seeds = SEEDS[at : at + step]
        if len(kmers) > TAKE:
            ranks, every = mix64(kmers[None, :] ^ seeds[:, None]), np.arange(len(seeds))
            picked = np.empty((len(seeds), TAKE), dtype=np.int64)
            for k in range(TAKE):
                picked[:, k] = ranks.argmin(axis=1)
                ranks[every, picked[:, k]] = np.uint64(2**64 - 1)
            picked.sort(axis=1)
            chosen = kmers[picked]
        else:
            chosen = np.repeat(kmers[None, :], len(seeds), axis=0)
        value = seeds.copy()
        for column in chosen.T:
            value = mix64(value * np.uint64(31) + column)
        out[at : at + step] = value
    return out.view(np.int64)


def profile(words: np.ndarray) -> bytes:
    """How many words fall in each bin; a byte each, as counts beyond 255 may stay there without making two texts less alike."""
    return np.minimum(np.bincount((words >> np.uint64(57)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def bag(words: np.ndarray) -> bytes:
    """How many words (32 bits each) fall in each of two to four times as many bins: four bits each, which stop at 15 as profiles do at 255."""
    bins = 1 << min(MOST_BAG_BITS, max(7, len(words).bit_length() + 1))
    counts = np.minimum(np.bincount(words & np.uint32(bins - 1), minlength=bins), 15).astype(np.uint8)
    return (counts[: bins // 2] | counts[bins // 2 :] << 4).tobytes()


def signs(words: np.ndarray) -> np.ndarray:
    """A bit for each of 64 * SIGNS bins: is the number of words (32 bits each) in it odd? A word that one text has and
    another has not changes one bit at most."""
    counts = np.bincount(words >> np.uint32(33 - (64 * SIGNS).bit_length()), minlength=64 * SIGNS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def bag_distance(one: bytes, two: bytes) -> int:
    """Edits that two texts with these bags differ by at least; bins of the larger bag are added up to those of the other."""
    sides = []
    for packed in (one, two):
        halves = np.frombuffer(packed, dtype=np.uint8)
        counts = np.concatenate([halves & 15, halves >> 4])
        sides.append(counts.reshape(-1, 2 * min(len(one), len(two))).sum(axis=0, dtype=np.int64))
    more = sides[0] - sides[1]
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def _sketches(docs: DataFrame) -> DataFrame:
    """docs: id, key, text -> id, key, size (words), profile, bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                words = [word_hashes(t) for t in texts_of(batch.column(2), start, stop)]
                rows = [sketch(w) for w in words]
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rows).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start), pa.array([len(w) for w in words], pa.int32()),
                                                  pa.array([profile(w) for w in words], pa.binary()), bands], ["id", "key", "size", "profile", "bands"])

    return docs.mapInArrow(run, T.StructType([docs.schema["id"], docs.schema["key"], T.StructField("size", T.IntegerType()), T.StructField("profile", T.BinaryType()),
                                              T.StructField("bands", T.ArrayType(T.LongType()))]))


def edits_allowed(size: np.ndarray, similarity: float) -> np.ndarray:
    """Most edits with which a pair whose longer side has ``size`` words keeps the similarity."""
    return ((1.0 - similarity) * size + 1e-9).astype(np.int64)


def edit_distances(pairs: list[tuple[np.ndarray, np.ndarray]], limits: list[int]) -> np.ndarray:
    """Edit distance of every pair, or -1 where it is above the pair's limit."""
    out = np.full(len(pairs), -1, dtype=np.int64)
    for k, ((a, b), limit) in enumerate(zip(pairs, limits)):
        if abs(len(a) - len(b)) > limit:
            continue
        short = min(len(a), len(b))
        differ = np.flatnonzero(a[:short] != b[:short])
        head = int(differ[0]) if len(differ) else short
        a, b = a[head:], b[head:]
        short = min(len(a), len(b))
        differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
        tail = int(differ[0]) if len(differ) else short
        a, b = a[: len(a) - tail], b[: len(b) - tail]
        if not len(a) or not len(b):
            out[k] = len(a) + len(b)
            continue
        bins = np.bincount(a & 1023, minlength=1024) - np.bincount(b & 1023, minlength=1024)
        least = int(max(bins[bins > 0].sum(), -bins[bins < 0].sum()))  # words that only one side has must be edited
        if least > limit:
            continue
        a, b, width = a.tolist(), b.tolist(), min(limit, 8 + least + least // 4)
        while (d := _banded(a, b, width)) > width and width < limit:
            width = min(limit, 4 * width)
        if d <= width:
            out[k] = d
    return out


def _banded(a: list, b: list, w: int) -> int:
    """Edit distance of a and b, more than w where it is above w; len(a) and len(b) differ by w at most.

    The table's columns follow b. Of each column only the rows within w of the diagonal are held, as integers with a
    bit per row, lowest first: ``plus`` and ``minus`` have the rows that are one more and one less than the row above.
    From column to column the window moves down by one row. ``score`` follows the window's lowest row, then the last
    row of the table; distances never fall along a diagonal and by one at most along a row, which ends hopeless pairs."""
    m, n = len(a), len(b)
    low = 1 << (2 * w)
    full = 2 * low - 1
    places: dict = {}  # word -> (column, its rows as bits of that column's window)
    for row in range(1, min(w, m) + 1):
        places[a[row - 1]] = (0, places.get(a[row - 1], (0, 0))[1] | 1 << (row + w))
    plus, minus, score = full ^ ((1 << w) - 1), 0, min(w, m)
    for column in range(1, n + 1):
        row = column + w
        if row <= m:
            since, bits = places.get(a[row - 1], (column, 0))
            places[a[row - 1]] = (column, bits >> (column - since) | low)
            if len(places) > 4 * w + 1024:  # words that have left the window
                places = {x: p for x, p in places.items() if column - p[0] <= 2 * w}
        since, bits = places.get(b[column - 1], (column, 0))
        match = bits >> (column - since)
        level = ((((match & plus) + plus) ^ plus) | match | minus) & full  # rows equal to their upper left neighbour
        right = minus | (full ^ (level | plus))  # rows one more than their left neighbour
        left = level & plus  # one less
        if row <= m:
            score += not level & low
            if score > 2 * w + n - m:
                return w + 1
        else:
            bit = 1 << (m - column + w)
            score += bool(right & bit) - bool(left & bit)
            if score > w + n - column:
                return w + 1
        half = level >> 1
        plus, minus = left | (full ^ (half | right)), half & right
    return score


def _alike_sizes(one: str, two: str, similarity: float) -> Column:
    """Whether texts of so many words can have the similarity: the longer one's further words must be edited."""
    return F.abs(F.col(one) - F.col(two)) <= F.floor(F.lit(1.0 - similarity) * F.greatest(one, two) + 1e-9)


def _alike_profiles(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """pairs (a, b) of nodes -> those whose profiles allow the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAIR_ROWS):
                part = batch.slice(start, PAIR_ROWS)
                sizes = np.maximum(np.asarray(part.column(2)), np.asarray(part.column(4)))
                one, two = (np.frombuffer(b"".join(part.column(k).to_pylist()), dtype=np.uint8).reshape(-1, BINS).astype(np.int16) for k in (3, 5))
                more = one - two
                apart = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
                yield part.select(["a", "b"]).filter(pa.array(apart <= edits_allowed(sizes, similarity)))

    sides = [nodes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("profile").alias(f"profile_{x}")) for x in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "profile_a", "size_b", "profile_b").mapInArrow(run, "a long, b long")


def _alike_bags(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """pairs (a, b) of nodes -> those whose bags allow the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(3), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                limits = edits_allowed(np.maximum(np.asarray(part.column(2)), np.asarray(part.column(4))), similarity)
                apart = np.array([bag_distance(x, y) for x, y in zip(part.column(3).to_pylist(), part.column(5).to_pylist())], dtype=np.int64)
                yield part.select(["a", "b"]).filter(pa.array(apart <= limits))

    sides = [words.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("bag").alias(f"bag_{x}")) for x in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "bag_a", "size_b", "bag_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """pairs (a, b) of nodes -> those with the similarity or more, as (u, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                both = [(np.frombuffer(x, dtype=np.uint32).astype(np.int64), np.frombuffer(y, dtype=np.uint32).astype(np.int64))
                        for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                limits = edits_allowed(np.array([max(len(x), len(y)) for x, y in both]), similarity).tolist()
                ok = pa.array(edit_distances(both, limits) >= 0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["u", "v"]).filter(ok)

    left, right = words.select(F.col("node").alias("a"), F.col("words").alias("wa")), words.select(F.col("node").alias("b"), F.col("words").alias("wb"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb")
    return met.mapInArrow(run, "u long, v long")


def _packed_words(texts: DataFrame) -> DataFrame:
    """node, text -> node, words (32 bits of each word's hash), size (words), bag."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(1), SLICE_BYTES):
                rows = [(word_hashes(t) >> np.uint64(32)).astype(np.uint32) for t in texts_of(batch.column(1), start, stop)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([len(r) for r in rows], pa.int32()),
                                                  pa.array([bag(r) for r in rows], pa.binary())], ["node", "words", "size", "bag"])

    return texts.mapInArrow(run, "node long, words binary, size int, bag binary")


def _links(nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Verified links (u, v) between ``nodes`` (node, key, size, profile, bands), enough to join every class.
    ``texts``: key and text of every input row."""
    bands = nodes.select("node", "size", F.explode("bands").alias("sig"))  # a band's value is seeded by the band
    ends = bands.groupBy("sig").agg(F.min(F.struct("node", "size")).alias("low"), F.max("node").alias("high")).filter("low.node <> high")
    ends = ends.select("sig", F.col("low.node").alias("low"), F.col("low.size").alias("low_size"))
    members = materialise(bands.join(ends, "sig"), "omh-members")  # buckets of two or more texts only
    needed = nodes.join(members.select("node").distinct(), "node").select("key", "node")
    words = materialise(_packed_words(texts.join(needed, "key").groupBy("node").agg(F.first("text").alias("text"))), "omh-words")
    pair = [F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")]

    def tested(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        alike = materialise(_alike_profiles(pairs, nodes, similarity), "omh-alike")
        return alike, materialise(_verified(alike, words, similarity), "omh-links")

    # every member against its bucket's smallest
    first = members.filter(F.expr("node <> low") & _alike_sizes("size", "low_size", similarity)).withColumnRenamed("low", "pivot").select(*pair).distinct()
    alike, links = tested(first)
    # nodes of pairs that are about alike, against one of their bucket drawn by hash
    roots = components(links, "omh-components")
    close = alike.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    close = _with_roots(members.select("sig", "node", "size").join(close, "node"), roots)
    drawn = F.struct(F.xxhash64("sig", "node").alias("draw"), "node", "root", "size")
    pivots = close.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min(drawn).alias("drawn")).filter("r0 <> r1")
    pivots = pivots.select("sig", F.col("drawn.node").alias("pivot"), F.col("drawn.root").alias("pivot_root"), F.col("drawn.size").alias("pivot_size"))
    second = close.join(pivots, "sig").filter(F.expr("root <> pivot_root") & _alike_sizes("size", "pivot_size", similarity)).select(*pair).distinct().join(alike, ["a", "b"], "left_anti")
    alike_too, more = tested(second)
    links, alike = links.unionByName(more), alike.unionByName(alike_too)
    # whatever still stands in different components of a bucket
    roots = components(links, "omh-components")
    marked = _with_roots(members.select("sig", "node"), roots)
    opened = marked.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("sig")
    still = marked.join(opened, "sig").select("node", "root").distinct()
    third = _sharing_a_rare_word(still, words, similarity, ("size_a", "size_b")).join(alike, ["a", "b"], "left_anti")
    third = materialise(third, "omh-alike")  # of long texts by their profiles first, as a bag is larger than those
    short = (F.col("size_a") < SHORT) & (F.col("size_b") < SHORT)
    third = _alike_profiles(third.filter(~short).select("a", "b"), nodes, similarity).unionByName(third.filter(short).select("a", "b"))
    third = materialise(_alike_bags(third, words, similarity), "omh-alike")  # the words below are shuffled for few of them
    return links.unionByName(materialise(_verified(third, words, similarity), "omh-links"))


def run_words(similarity: float) -> int:
    """How many words the runs of step 3 have: single ones for a similarity at which alike texts may have no longer run in common."""
    return RUN if RUN * (1.0 - similarity) <= 0.5 else 1


def _tokens(words: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of k words of a packed text, each told apart by how often it occurred before, and which occur once."""
    return _numbered_kmers(np.frombuffer(words, dtype=np.uint32).astype(np.uint64), k)


def _sharing_a_rare_word(nodes: DataFrame, words: DataFrame, similarity: float, sizes: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (a, b, and of their ``sizes`` size_a and size_b) of ``nodes`` (node, root) of different roots that can have the similarity, by the prefix filter.

    An edit of a word breaks the runs of k words that it stands in, k at most, and a word put in between breaks k - 1.
    Texts of n and m words that are alike, n <= m, differ by (1 - similarity) * m edits at most, m - n of which put a
    word into the shorter, so all but k * (1 - similarity) * n run occurrences of either are in both. Among each one's
    k * (1 - similarity) * n + 1 first occurrences in any fixed order there is then one that both have: no
    pair above the similarity is left out. In an order by rarity, what very many texts share, such as a common
    passage, is among the first only of texts with little else, so texts that only share that make few pairs. Rarity is
    that of COUNTERS hashed counters: one aggregation, and an array of fixed size that goes to the tasks.

    The smallest occurrence that an alignment of such a pair matches is among those first ones of both. If its run
    stands once in each text, the two places are matched with each other, so they differ by the allowed edits at
    most. Of the occurrences that two texts share in this way, one with another of them among the EARLIER shared
    ones before it makes no pair; the first has none before it, so every pair is made at least once. Whatever stands
    before the first in either text has no match, so a pair needs a first that is early enough in both, the more so in
    the shorter one. An edit changes two signs at most, one of those by which the sizes differ changes one."""
    k = run_words(similarity)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                tokens = np.concatenate([_tokens(w, k)[0] for w in batch.column(2).slice(start, stop - start).to_pylist()])
                sums += np.bincount((tokens % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(sums[seen])], ["counter", "n"])

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in byte_slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(start, stop - start)
                firsts, places, sizes = [], [], []
                for packed in part.column(2).to_pylist():
                    tokens, once = _tokens(packed, k)
                    sizes.append(len(packed) // 4)
                    keep = int(k * (1.0 - similarity) * sizes[-1] + 1e-9) + 1
                    first = np.lexsort((tokens, often[(tokens % np.uint64(COUNTERS)).astype(np.int64)]))[:keep]
                    firsts.append(tokens[first].view(np.int64))
                    places.append(np.where(once[first] & (first < PLACES - 1), first, -1).astype(np.int32))  # -1: the run occurs again
                counts = [len(f) for f in firsts]
                at = pa.array(np.repeat(np.arange(len(firsts)), counts))
                ranks = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(sizes, pa.int32()).take(at), pa.array(np.concatenate(firsts)),
                                                  pa.array(np.concatenate(places)), pa.array(ranks)], ["node", "root", "size", "token", "place", "rank"])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([signs(np.frombuffer(w, dtype=np.uint32)) for w in batch.column(2).to_pylist()], dtype=np.int64).reshape(-1, SIGNS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in found.T]], ["node", *bits])

    bits = [f"signs{i}" for i in range(SIGNS)]
    nodes = materialise(nodes.join(words, "node").select("node", "root", "words"), "omh-open")
    often = np.zeros(COUNTERS, dtype=np.uint8)  # eight steps for each power of two
    level = F.least(F.floor(8 * F.log2(F.sum("n"))), F.lit(254)).cast("short") + F.lit(1).cast("short")
    levels = nodes.mapInArrow(counted, "counter int, n long").groupBy("counter").agg(level.alias("level")).toArrow()  # COUNTERS rows of 6 bytes at most
    often[np.asarray(levels.column("counter"))] = np.asarray(levels.column("level"))
    prefix = materialise(nodes.mapInArrow(rarest, "node long, root long, size int, token long, place int, rank int"), "omh-prefix")
    shared = prefix.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("token")
    before = Window.partitionBy("node").orderBy("rank").rowsBetween(-EARLIER, -1)  # a text's own rows
    packed = F.col("token").bitwiseAND(F.lit(-PLACES)).bitwiseOR(F.col("place").bitwiseAND(F.lit(PLACES - 1)).cast("long"))  # token, place; all ones: none
    marked = prefix.join(shared, "token").withColumn("before", F.collect_list(packed).over(before))
    marked = materialise(marked.join(nodes.mapInArrow(signed, ", ".join(["node long", *[f"{c} long" for c in bits]])), "node"), "omh-shared")
    discard(nodes, prefix)
    x, y = (marked.select("token", *[F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "size", "place", "rank", "before", *bits)]) for k in "ab")
    allowed = F.floor(F.lit(1.0 - similarity) * F.greatest("size_a", "size_b") + 1e-9)
    apart = F.abs(F.col("size_a") - F.col("size_b"))

    early = (F.greatest("size_a", "size_b") - F.least(F.col("size_a") - F.col("rank_a"), F.col("size_b") - F.col("rank_b"))) <= k * allowed
    odd = functools.reduce(operator.add, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in bits])

    def matched(one: Column, other: Column) -> Column:
        return (one < 0) | (other < 0) | (F.abs(one - other) <= allowed)

    def place(x: Column) -> Column:
        number = x.bitwiseAND(F.lit(PLACES - 1))
        return F.when(number == PLACES - 1, F.lit(-1)).otherwise(number)

    again = F.exists("before_a", lambda u: F.exists("before_b", lambda v: (u.bitwiseXOR(v).bitwiseAND(F.lit(-PLACES)) == 0) & matched(place(u), place(v))))
    met = x.join(y, "token").filter(F.expr("node_a < node_b AND root_a <> root_b") & (apart <= allowed) & early
                                    & matched(F.col("place_a"), F.col("place_b")) & (odd <= 2 * allowed - apart) & ~again)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), *sizes).distinct()


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _classes(keyed: DataFrame, similarity: float) -> DataFrame:
    """keyed: id, key, text -> id, key, class_id, class_size, copies (rows of that id and key)."""
    sketches = materialise(_sketches(keyed.select("id", "key", "text")), "omh-sketches")
    nodes = sketches.groupBy("key").agg(*[F.first(c).alias(c) for c in ("size", "profile", "bands")])
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "omh-nodes")
    roots = components(_links(nodes, keyed.select("key", "text"), similarity), "omh-components")
    rows = sketches.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies")).join(_with_roots(nodes.select("key", "node"), roots), "key")
    rows = materialise(rows, "omh-rows")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    classes = rows.groupBy("root").agg(F.min("id").alias("class_id"), F.min(first).alias("stays"), F.sum("copies").alias("class_size"))
    return rows.join(classes, "root").select("id", "key", "class_id", "class_size", "copies", first.eqNullSafe(F.col("stays")).alias("kept"))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, class_id (the class's smallest id), class_size (rows), kept."""
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = _classes(keyed, similarity)
    repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(F.col("id").alias(id_col), "class_id", "class_size", (F.col("kept") & (F.col("copy") == 1)).alias("kept"))


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of every class: that with the smallest id; all columns as they came."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                        text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    stays = _classes(keyed.select("id", "key", "text"), similarity).filter("kept").select(F.col("id").alias("kept_id"), F.col("key").alias("kept_key"), "copies")
    stays = materialise(stays, "omh-kept")
    kept = keyed.select("row", "id", "key").join(stays, (F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("kept_id")))
    repeated = kept.filter("copies > 1").groupBy("key").agg(F.first("row").alias("row"))
    return kept.filter("copies = 1").select("row.*").unionByName(repeated.select("row.*"))
