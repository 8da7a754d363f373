"""Filter interaction audit by min-plus removal ranks: which filter removes what, under every order of the filters.

A document fails a set of the filters, its mask. Over an order of the filters, the filter at the smallest position
among those it fails removes it. For all masks and orders at once this is a matrix product under (min, +): the mask
matrix (masks x filters: 0 where the filter fails, infinite elsewhere) with the inverse permutations (filters x
orders: a filter's position in an order) gives the removal step of every mask in every order. Counts then are weighted
scatters: documents per mask are added at their mask's removal step (removed), and at the positions of the other
filters that the mask fails (redundant).

Documents are reduced to counts per (part, mask) by Spark's partial aggregation before anything else, so that what
reaches numpy is at most 2**filters rows of counts per part, and a hot part is summed where its rows are. The filter
"equal to an earlier text" needs no group of copies in one place: the smallest id of a text comes from a partial
minimum, and each row then asks whether it is that one, by (digest, id); other than repeated rows, which are summed
before, no two rows have the same key there.

Defined cases: a null text counts as empty, and empty texts are equal to each other; a null source is the empty
part; a row without id is never later than another, and no row is later than it (it fails no duplicate filter and
has no label); rows that agree in id and text have the same fate, so both or none are duplicates of a smaller id;
several labels of one id: it is good if one says quality 1 and toxic if one says toxic 1; null labels say nothing;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wirelake.llm.common import materialise

SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5  # words; distinct words and capitals in per cent
MARKS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides by itself."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * MIN_DISTINCT,
        "C": capitals * 100 > F.char_length(text) * MAX_CAPITALS,
        "D": text.rlike(MARKS),
    }


def failures(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "source") -> DataFrame:
    """part, A to E (fails that filter), good, toxic, n: so many documents of that kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), *[c.alias(k) for k, c in text_filters(text).items()])
    rows = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "audit-rows")  # texts are read once
    first = rows.groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("first"))
    rows = rows.join(first, (F.col("digest") == F.col("same")) & (F.col("id") == F.col("first")), "left")
    marks = labels.groupBy(F.col(id_col).alias("labelled")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(marks, F.col("id") == F.col("labelled"), "left")
    known = [F.coalesce(F.col(k), F.lit(False)).alias(k) for k in ("good", "toxic")]
    return rows.select("part", "A", "B", "C", "D", (F.col("id").isNotNull() & F.col("same").isNull()).alias("E"), *known, "n")


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Step (1 to filters; filters + 1: kept) at which each order removes each mask: min-plus product of
    masks (masks x filters, boolean) with positions (filters x orders)."""
    n = positions.shape[0]
    cost = np.where(masks, 0, n + 1)
    steps = np.full((len(masks), positions.shape[1]), n + 1)
    for f in range(n):
        np.minimum(steps, cost[:, f, None] + positions[None, f], out=steps)
    return steps


def _positions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders (orders x steps: the filter) and their inverses (filters x orders: the position, from 1)."""
    orders = np.array(list(permutations(range(n))))
    return orders, np.argsort(orders, axis=1).T + 1


def tabulate(part: np.ndarray, mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Counts (parts x orders x steps) from rows of (part number, mask bits, documents, good and toxic ones)."""
    orders, positions = _positions(filters)
    parts, kinds = int(part.max()) + 1, np.arange(1 << filters)
    fails = (kinds[:, None] >> np.arange(filters)) & 1 == 1
    steps = removal_steps(fails, positions)
    shape = (parts, len(orders), filters + 1)
    every = np.arange(len(orders))[None, :]
    out = {}
    for name, weight in (("removed", n), ("good_lost", good), ("toxic_lost", toxic)):
        out[name] = np.zeros(shape, dtype=np.int64)
        np.add.at(out[name], (part[:, None], every, steps[mask] - 1), weight[:, None])
    redundant = np.zeros(shape, dtype=np.int64)
    unique = np.zeros((parts, filters), dtype=np.int64)
    shares = np.zeros((parts, filters), dtype=np.int64)
    for f in range(filters):
        late = fails[mask, f, None] & (steps[mask] < positions[f])
        np.add.at(redundant, (part[:, None], every, positions[f][None, :] - 1), np.where(late, n[:, None], 0))
        alone = mask == 1 << f
        np.add.at(unique[:, f], part[alone], n[alone])
        shares[:, f] = np.take_along_axis(out["removed"], positions[f][None, :, None] - 1, axis=2)[:, :, 0].sum(axis=1)
    total = out["removed"].sum(axis=2)[:, :, None]
    out |= {"redundant": redundant, "kept": total - np.cumsum(out["removed"], axis=2)}
    out = {k: v[:, :, :filters] for k, v in out.items()}
    return out | {"unique_fails": unique[:, orders], "shapley": shares[:, orders]}


def audit(flags: DataFrame, filters: Sequence[str], part_col: str = "part") -> DataFrame:
    """One row per part, order of the filters and step. flags: part, a boolean column per filter (named by one
    letter), good, toxic, n. The filters' number decides the size: n! orders, 2**n masks."""
    mask = sum((F.col(f).cast("int") * (1 << k) for k, f in enumerate(filters)), F.lit(0))
    weights = [F.sum("n").alias("n"), *[F.sum(F.when(F.col(k), F.col("n")).otherwise(0)).alias(k) for k in ("good", "toxic")]]
    counts = flags.groupBy(F.col(part_col).alias("part"), mask.alias("mask")).agg(*weights)
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))  # 2**filters at most
    names = ["".join(p) for p in permutations(filters)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                lists = some.column(1)
                rows = lists.flatten()
                number = np.repeat(np.arange(some.num_rows), np.diff(np.asarray(lists.offsets)))
                table = tabulate(number, *[np.asarray(rows.field(k)).astype(np.int64) for k in range(4)], len(filters))
                cells = len(names) * len(filters)
                of = pa.array(np.repeat(np.arange(some.num_rows), cells))
                order = pa.array(np.tile(np.repeat(np.arange(len(names)), len(filters)), some.num_rows))
                step = np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), some.num_rows * len(names))
                yield pa.RecordBatch.from_arrays([some.column(0).take(of), pa.array(names).take(order), pa.array(step), *[pa.array(table[c].ravel()) for c in COUNTS]],
                                                 ["part", "filter_order", "step", *COUNTS])

    return per_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over documents, by source."""
    return audit(failures(docs, labels), "ABCDE")


ORACLE = rf"""
WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(words) < {MIN_WORDS}, 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words),
    100 * (length(text) - length(translate(text, '{CAPITALS}', ''))) > {MAX_CAPITALS} * length(text),
    regexp_matches(text, '{MARKS}'), coalesce(worded.doc_id > first, false)] AS fails
  FROM worded LEFT JOIN marks ON worded.doc_id = marks.doc_id
), kinds AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 3, 4, 5]) AS k
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS seq
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), cells AS (
  SELECT part, good, toxic, fails, n, filter_order, seq, unnest([1, 2, 3, 4, 5]) AS step FROM kinds, orders
), fates AS (
  SELECT *, seq[step] AS filter, fails[seq[step]] AS fails_here,
         (step > 1 AND fails[seq[1]]) OR (step > 2 AND fails[seq[2]]) OR (step > 3 AND fails[seq[3]]) OR (step > 4 AND fails[seq[4]]) AS gone
  FROM cells
), counted AS (
  SELECT part, filter_order, step, any_value(filter) AS filter,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails_here), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails_here), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails_here), 0) AS redundant,
         coalesce(sum(n) FILTER (fails_here AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (NOT gone AND fails_here AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (NOT gone AND fails_here AND toxic), 0) AS toxic_lost
  FROM fates GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""
