"""Exact deduplication by two-pass Bloom filtering (built-in expressions only).

Pass 1 sets one bit per row and hash function in a filter of ``2**word_bits`` 64-bit words, kept as a
table: a word's row says which of its bits were set by more than one row. One aggregation finds that: of the
rows' one-bit masks it takes ``bit_or`` (bits set), ``bit_xor`` (bits set an odd number of times) and the
count. Bits in the first and not in the second were set two, four, ... times; if they account for all rows
beyond the first of a bit, they are the repeated bits; otherwise some bit was set three times or more, and all
bits of the word count as repeated. Pass 2 looks up every row's own bits: a row both of whose bits are
repeated may be a repeat and goes to the shuffle on its digest; every other row is proven unique and passes
straight through.

The filter is sized from the number of rows, ``ROWS_PER_WORD`` rows to a word at most, up to ``2**WORD_BITS`` words;
only words with repeated bits are broadcast, at most ``2 * 2**WORD_BITS`` small rows, whatever the data size. A filter
too small for its rows only lets more rows shuffle (their digests and ids; of texts only the winners'): of rows that
are all different less than 1 % up to five million, about 3 % at ten million, 16 % at 20 million and nearly all above 50 million, where
a filter that tells them apart takes more memory than a broadcast may.

Within the shuffle, groups are counted with map-side partial aggregation. Their rows meet the one winner row of a
group in a join on (digest, salt), so a hot group is dealt over ``SALTS`` tasks. Where whole documents are wanted,
the winners' (digest, id) make a second filter of the same kind, and texts of other copies don't move.

Defined cases: a null text counts as empty, empty texts are equal to each other; letters A-Z and a-z are
equal, no others; of equal texts the row with the largest id stays, a null id counting as the smallest;
rows that agree in text and id stay or go together in ``exact_groups`` and are reduced to one in
``exact_dedup``; an empty table gives an empty result; other columns are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirelake.llm.common import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS_PER_WORD = 4     # rows for each word of 64 bits, for each of the two hash functions
MIN_WORD_BITS, WORD_BITS = 10, 20  # 2**20 words at most
SALTS = 16


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does that unless it changes a non-ASCII character;
    only texts where it would go through the slower ``translate``."""
    foreign = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    plain = (F.octet_length(text) == F.char_length(text)) | (F.lower(foreign) == foreign)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _digest(text_col: str) -> Column:
    return F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)


def _places(digest: Column, word_bits: int) -> list[Column]:
    """(word, bit) for two hash functions, from separate parts of the digest."""
    out = []
    for k in (0, 1):
        h = F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("long")
        out += [h.bitwiseAND(F.lit((1 << word_bits) - 1)).cast("int").alias(f"word{k}"),
                F.shiftright(h, 50).bitwiseAND(F.lit(63)).cast("int").alias(f"bit{k}")]
    return out


def _sized(rows: int) -> int:
    return min(WORD_BITS, max(MIN_WORD_BITS, (rows // ROWS_PER_WORD).bit_length()))


def _repeated_bits(narrow: DataFrame, k: int, word_bits: int) -> DataFrame:
    """(flag, mask): the filter's words that have bits set by more than one row, and those bits."""
    placed = narrow.select(*_places(F.col("digest"), word_bits))
    mask = F.expr(f"shiftleft(1L, bit{k})")
    words = placed.groupBy(F.col(f"word{k}").alias(f"flag{k}")).agg(F.bit_or(mask).alias("bits"), F.bit_xor(mask).alias("odd"), F.count(F.lit(1)).alias("rows"))
    even = F.col("bits").bitwiseAND(F.bitwise_not("odd"))
    repeated = F.when(F.bit_count(even) == F.col("rows") - F.bit_count("bits"), even).otherwise(F.col("bits"))
    return words.filter(F.bit_count("bits") < F.col("rows")).select(f"flag{k}", repeated.alias(f"mask{k}"))


def _split(keyed: DataFrame, narrow: DataFrame, word_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``keyed`` proven unique, and those that may repeat. ``narrow``: the digests of all rows."""
    probed = keyed.select("*", *_places(F.col("digest"), word_bits))
    for k in (0, 1):
        probed = probed.join(F.broadcast(_repeated_bits(narrow, k, word_bits)), F.col(f"word{k}") == F.col(f"flag{k}"), "left")
    maybe = [F.coalesce(F.expr(f"shiftright(mask{k}, bit{k}) & 1 = 1"), F.lit(False)) for k in (0, 1)]
    return probed.filter(~(maybe[0] & maybe[1])).select(*keyed.columns), probed.filter(maybe[0] & maybe[1]).select(*keyed.columns)


def _narrow(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, digest) of every row, written once: the texts are read and hashed a single time for it."""
    return materialise(docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest")), "digests")


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", word_bits: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    narrow = _narrow(docs, text_col, id_col)
    unique, maybe = _split(narrow, narrow, word_bits or _sized(narrow.count()))
    groups = maybe.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = maybe.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(groups, ["digest", "salt"])
    out = [F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
           F.col("digest").alias("text_sha256")]
    straight = unique.withColumn("keep_id", F.col("id")).withColumn("group_size", F.lit(1).cast("long"))
    return straight.select(*out).unionByName(met.select(*out))


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", word_bits: int | None = None) -> DataFrame:
    """The input without repeats: of equal texts one row with the largest id stays, all columns as they came."""
    narrow = _narrow(docs, text_col, id_col)
    bits = word_bits or _sized(narrow.count())

    def named(rows: DataFrame) -> DataFrame:
        """With a digest of (digest, id), which tells a group's winner from its other rows."""
        return rows.withColumn("name", F.sha2(F.concat_ws(":", "digest", "id").cast("binary"), 256))

    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), _digest(text_col).alias("digest"))
    unique, maybe = _split(keyed, narrow, bits)
    winners = named(_split(narrow, narrow, bits)[1].groupBy("digest").agg(F.max("id").alias("id")))
    winners = materialise(winners.select("name"), "winners")
    word, bit = (p.alias(n) for p, n in zip(_places(F.col("name"), bits)[:2], ("word", "bit")))
    set_bits = winners.select(word, bit).groupBy(F.col("word").alias("flag")).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    some = named(maybe).select("*", word, bit).join(F.broadcast(set_bits), F.col("word") == F.col("flag")).filter("shiftright(mask, bit) & 1 = 1")
    kept = some.select("row", "name").join(winners, "name")
    one = kept.groupBy("name").agg(F.first("row").alias("row"))  # rows that agree in text and id
    return unique.select("row.*").unionByName(one.select("row.*"))


ORACLE = """
WITH norm AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM norm
"""
