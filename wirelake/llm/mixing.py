"""Mixing sources to target weights.

``mix_plan`` counts the words of every document, adds them up per source, shares a word budget
over the sources and derives for every document how often the mix takes it: ``floor(rate)`` times
plus one copy drawn with probability ``rate - floor(rate)`` from a hash of the document's id.

Defined cases: a null text has size 0; the null source is a source of its own, last in order; a
source without words has target and rate 0; rows that repeat are mixed one by one, rows of equal
id share their draw; an empty table gives an empty result. ``mix`` keeps all input columns, whatever
their names, and repeats rows; ``mix_plan`` returns only the id and its own columns.

At scale: one aggregation with map-side partial sums (a hot source costs one row per task), a
source table written out, and a join that Spark broadcasts only when that table is small enough;
otherwise the sort-merge join's skew handling splits the hot source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wirelake.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5   # words of the mix, as a multiple of all words
CAP = 2.0     # most words taken from a source, as a multiple of its words
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Water filling over one row per source: target = least(cap * size, level * weight).

    Sources fill up in the order of cap * size / weight. The level is read at the first source
    that the words left over, shared by weight, do not fill. The windows run over the source
    table only, never over documents.
    """
    by_name = Window.orderBy(F.col("source").isNotNull().desc(), F.col("source"))
    by_need = Window.orderBy("fill_level", "rank")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = ranked.withColumn("weight", weight).withColumn("fill_level", F.lit(cap) * F.col("source_size") / F.col("weight"))
    whole = Window.partitionBy()
    filled = F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.lit(share) * F.sum("source_size").over(whole) - filled) / left)
    open_level = F.when(F.col("level") < F.col("fill_level"), F.struct("fill_level", "rank", "level"))
    rows = rows.withColumn("open_level", F.min(open_level).over(whole)["level"])
    target = F.least(F.lit(cap) * F.col("source_size"), F.coalesce(F.col("open_level") * F.col("weight"), F.lit(cap) * F.col("source_size")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def unit_draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest of seed and id."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _with_plan(docs: DataFrame, weights, share, cap, seed, text_col, id_col, source_col) -> DataFrame:
    """``docs`` as one struct column ``row`` next to size, source_size, target, copies."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), unit_draw(F.col(id_col), seed).alias("draw"))
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(word_count(F.col(text_col))).alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, cap), "mix-targets").withColumnRenamed("source", "target_source")
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("target_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = (F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")).cast("long")
    return joined.withColumn("copies", copies)


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
             text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies."""
    plan = _with_plan(docs.select(id_col, text_col, source_col), weights, share, cap, seed, text_col, id_col, source_col)
    return plan.select(F.col("row")[id_col].alias(id_col), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
        text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The mixed documents: every input row ``copies`` times, columns as they came."""
    plan = _with_plan(docs, weights, share, cap, seed, text_col, id_col, source_col)
    repeated = plan.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM sums
), weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM ranked
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS fill_level FROM weighed
), shared AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY fill_level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY fill_level, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM levels
), opened AS (
  SELECT arg_min(level, rank_in_need) AS open_level FROM (
    SELECT level, fill_level, row_number() OVER (ORDER BY fill_level, rank) AS rank_in_need FROM shared) WHERE level < fill_level
), targets AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, coalesce(open_level * weight, 2.0::DOUBLE * source_size)) AS target
  FROM levels CROSS JOIN opened
), drawn AS (
  SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copied AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies FROM drawn
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM copied
"""
