"""Document fingerprints by Order MinHash, in built-in expressions only.

A text is its white-space separated words. Its k-mers (``K`` words) are numbered by occurrence, so a repeat
is a k-mer of its own. Numbered k-mers are hashed into ``BINS * TAKE`` cells by the leading bits of one
64-bit hash; the smallest hash of each cell is selected. The ``TAKE`` selected k-mers of a bin are put back
into text order and hashed as a tuple: one signature value per bin. Two texts agree in a bin when they
share its selected k-mers and have them in the same order, so moving text lowers likeness as well as
replacing it. ``likeness`` is the ``1/TAKE`` power of the share of agreeing bins: an estimate of the share
of k-mers that both texts keep.

Everything about one text is computed inside its row with array functions: no k-mer is exploded or
shuffled, and memory is bounded by the text. ``let`` binds an intermediate array as a lambda variable, so
that the optimiser can't copy its expression into inner loops.

``with_next`` puts every row next to its successor in descending id order. Rows are cut into ranges of about
``RANGE_ROWS`` rows, each range is sorted on its own, and only the first row of each range crosses to the range
before it. The cuts follow the rows, not the id values: ids are cut at up to ``GROUP`` percentiles, each piece
between two of them into ranges of equal width; an id that fills a percentile or more, and the rows without id, are cut by
a hash of the text. So outliers, hot ids and nulls make no large range. The texts are shuffled once, each with its
signature; a range's first text crosses without it and gets it there again, a signature per range.

Defined cases: a null text counts as empty; a text without words has the empty fingerprint, whose likeness
is 1 to another empty one and 0 to any other; texts of less than K words have one k-mer; rows of equal id
are ordered by a hash of their text, then the text, descending; a null id comes last; the successor of the last row is the
first, so a single row succeeds itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
TAKE = 2         # a power of two, as is BINS
BINS = 32
PLACE_BITS = 24  # k-mers keep 40 bits of hash; positions count modulo 2**24
RANGE_ROWS = 2000
GROUP = 4096  # pieces of the ids, at most; the first rows of a piece's ranges are ordered together


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _each(length: Column, body: Callable[[Column], Column]) -> Column:
    """body(0), ..., body(length - 1)."""
    return F.transform(F.sequence(F.lit(0), length - 1), body)


def _packed(hashed: Column, position: Column) -> Column:
    """The upper bits of a hash and, in the lower ``PLACE_BITS``, a position: one number, so that arrays of them
    sort as primitive values."""
    return hashed.bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(position.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _changes(values: Column, key: Callable[[Column], Column]) -> Column:
    """The indexes of a sorted array at which ``key`` differs from that of the value before."""
    return F.filter(F.sequence(F.lit(0), F.size(values) - 1), lambda i: (i == 0) | (key(F.get(values, i)) != key(F.get(values, i - 1))))


def _numbered(kmers: Column) -> Column:
    """Every k-mer's hash with its occurrence number hashed in, packed with its position. Texts without repeats,
    by far the most, need no sorting for it: all their numbers are 0."""
    first = F.transform(kmers, lambda h, i: _packed(F.xxhash64(_hash_of(h), F.lit(0)), i))

    def counted(s: Column) -> Column:
        return let(_changes(s, _hash_of), lambda starts: F.flatten(F.transform(
            starts, lambda at, j: _each(F.coalesce(F.get(starts, j + 1), F.size(s)) - at,
                                        lambda o: _packed(F.xxhash64(_hash_of(F.get(s, at)), o), _place_of(F.get(s, at + o)))))))

    repeats = F.size(F.array_distinct(F.transform(kmers, _hash_of))) < F.size(kmers)
    return F.when(repeats, let(F.sort_array(F.transform(kmers, lambda h, i: _packed(h, i))), counted)).otherwise(first)


def signature(text: Column) -> Column:
    """Array of at most BINS signature values, in bin order; empty for a text without words."""
    cell_shift = 64 - (BINS * TAKE).bit_length() + 1

    def cell(x: Column) -> Column:
        return F.shiftrightunsigned(x, cell_shift)

    def bin_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, cell_shift + TAKE.bit_length() - 1)

    def tuples(chosen: Column) -> Column:
        def value(at: Column) -> Column:
            members = F.filter(F.slice(chosen, at + 1, TAKE), lambda x: bin_of(x) == bin_of(F.get(chosen, at)))
            in_order = F.sort_array(F.transform(members, lambda x: F.struct(_place_of(x).alias("place"), _hash_of(x).alias("hash"))))
            return F.xxhash64(bin_of(F.get(chosen, at)), F.transform(in_order, lambda x: x["hash"]))
        return F.transform(_changes(chosen, bin_of), value)

    def selected(ordered: Column) -> Column:
        """The smallest packed value of every cell: the first of its run in the sorted array."""
        return F.filter(ordered, lambda x, i: (i == 0) | (cell(x) != cell(F.get(ordered, i - 1))))

    def from_words(w: Column) -> Column:
        n = F.size(w)
        kmers = _each(F.greatest(n - (K - 1), F.lit(1)), lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(K)]))
        chosen = let(F.sort_array(let(kmers, _numbered)), selected)
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(let(chosen, tuples))

    return let(F.array_remove(F.split(text, r"\s+"), ""), from_words)


def fingerprint(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    bins = F.greatest(F.size(a), F.size(b))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.pow(F.size(F.array_intersect(a, b)) / bins, F.lit(1.0 / TAKE)))


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the text's code points replaced by the first as many of the following text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))


def _ranges(rows: DataFrame) -> Column:
    """(piece, part): numbers that put the rows (id, digest) into ranges, ascending as ids and digests descend."""
    count, nulls, low, high = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id").isNull()), F.min("id"), F.max("id")).first()
    pieces = min(GROUP, max(1, -(-count // RANGE_ROWS)))
    cuts = []
    if low is not None and pieces > 1:
        cuts = rows.agg(F.percentile_approx("id", [k / pieces for k in range(1, pieces)], 20 * pieces)).first()[0]
    hot = {x: n for x in set(cuts) if (n := cuts.count(x)) > 1}
    starts = sorted({low or 0, *cuts, *hot, *[x + 1 for x in hot if x < 2**63 - 1]})  # of the pieces, ascending; a hot id is one of its own
    ends = [*starts[1:], (high or 0) + 1]
    parts = [max(1, -(-count * hot.get(x, 1) // (pieces * RANGE_ROWS))) for x in starts]
    widths = [max(1, -(-(y - x) // n)) for x, y, n in zip(starts, ends, parts)]

    def array(numbers: list, kind: str) -> Column:
        return F.expr(f"cast(split('{','.join(map(str, numbers))}', ',') as array<{kind}>)")

    steps = [1 << k for k in reversed(range(len(starts).bit_length()))]

    def found(tables: Column) -> Column:
        """How many pieces start at or below the id, less one, by bisection."""
        return F.aggregate(array(steps, "int"), F.lit(-1), lambda at, step: F.when(F.get(tables["starts"], at + step) <= F.col("id"), at + step).otherwise(at))

    def by_hash(n: Column) -> Column:
        """0 for the largest digests, n - 1 for the smallest."""
        return n - 1 - F.floor((F.shiftright("digest", 32) + (1 << 31)) * n / (1 << 32)).cast("long")

    def placed(tables: Column) -> Column:
        def of(at: Column) -> Column:
            start, width, n = (F.get(tables[c], at) for c in ("starts", "widths", "parts"))
            by_id = F.floor((F.get(tables["ends"], at) - 1 - F.col("id").cast("decimal(38,0)")) / width).cast("long")
            return F.struct((F.lit(len(starts)) - at).cast("long").alias("piece"), F.when(F.array_contains(tables["hot"], start), by_hash(n)).otherwise(by_id).alias("part"))

        return let(found(tables), of)

    tables = F.struct(array(starts, "bigint").alias("starts"), array(ends, "decimal(38,0)").alias("ends"), array(widths, "decimal(38,0)").alias("widths"),
                      array(parts, "bigint").alias("parts"), (array(sorted(hot), "bigint") if hot else F.array().cast("array<bigint>")).alias("hot"))
    without = F.struct(F.lit(len(starts) + 1).cast("long").alias("piece"), by_hash(F.lit(max(1, -(-nulls // RANGE_ROWS))).cast("long")).alias("part"))
    return F.when(F.col("id").isNull(), without).otherwise(let(tables, placed))


def with_next(rows: DataFrame, bare: DataFrame | None = None, complete: Callable[[Column], Column] | None = None) -> DataFrame:
    """rows: id and value (a struct whose first field is the text); adds ``next``, the successor's value. ``bare``: the
    same rows without what is dear to compute in their values, and ``complete``, which computes it from such a value."""
    bare, complete = (rows, lambda value: value) if bare is None else (bare, complete)

    def hashed(some: DataFrame) -> DataFrame:
        return some.withColumn("digest", F.xxhash64("value.text"))

    where = _ranges(hashed(bare).select("id", "digest"))
    order = [F.col("id").desc_nulls_last(), F.col("digest").desc(), F.col("value.text").desc()]

    def placed(some: DataFrame) -> DataFrame:
        return hashed(some).withColumn("where", where).select("id", "value", "digest", "where.piece", "where.part")

    inside = Window.partitionBy("piece", "part").orderBy(*order)
    seen = placed(rows).withColumn("inner", F.lead("value").over(inside))
    heads = placed(bare).withColumn("rank", F.row_number().over(inside)).filter("rank = 1").select("piece", "part", "value")
    in_piece = Window.partitionBy("piece").orderBy("part")
    heads = heads.select("*", F.lead("value").over(in_piece).alias("later"), F.row_number().over(in_piece).alias("place"))
    firsts = heads.filter("place = 1").select("piece", "value")
    over_pieces = Window.orderBy("piece")  # one row for each piece
    firsts = firsts.select("piece", F.coalesce(F.lead("value").over(over_pieces),
                                               F.first("value").over(over_pieces.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("piece_next"))
    crossing = heads.join(firsts, "piece").select("piece", "part", F.coalesce("later", "piece_next").alias("outer"))
    return seen.join(crossing, ["piece", "part"]).select("id", "value", F.coalesce("inner", complete(F.col("outer"))).alias("next"))


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    def valued(text: Column) -> Column:
        return F.struct(text.alias("text"), signature(text).alias("sig"))

    text, key = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).alias("id")
    paired = with_next(docs.select(key, valued(text).alias("value")), docs.select(key, F.struct(text.alias("text")).alias("value")), lambda value: valued(value["text"]))
    edited = edited_text(F.col("value.text"), F.col("next.text"))
    out = paired.select(F.col("id"), F.char_length("value.text").cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
                        F.col("value.sig").alias("sig"), signature(edited).alias("edited_sig"), F.col("next.sig").alias("next_sig"))
    return out.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint(F.col("sig")).alias("fingerprint"),
                      let(F.col("edited_sig"), lambda e: F.struct(fingerprint(e).alias("f"), likeness(F.col("sig"), e).alias("l"))).alias("edited"),
                      likeness(F.col("sig"), F.col("next_sig")).alias("near_next")).select(
        id_col, "n_chars", "edited_sha256", "fingerprint", F.col("edited.f").alias("edited_fingerprint"), F.col("edited.l").alias("near_edited"), "near_next")
