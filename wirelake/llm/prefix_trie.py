"""Conversation prefix trie by depth-band rollup.

Every distinct sequence of a conversation's first d turns (role, text) is a node at depth d, under a textless root.
Subtree totals (leaves; tokens saved by storing a shared prefix once) are rolled up without walking the tree level
by level and without giving a node to all of its ancestors:

* Depths are cut into bands of ``HEIGHT``. A node explodes to its ancestors within its band only (``HEIGHT`` rows at
  most), and sums over those rows are the in-band totals, with partial aggregation before the shuffle.
* The roots of the bands, with their in-band totals as values, are a tree of 1/HEIGHT of the depth. It is rolled up in
  the same way (bands of bands), so the rounds grow with the logarithm of the depth.
* A completed band root's total then goes to the nodes above it in the band before, again ``HEIGHT`` rows at most.

Turns are numbered and prefixes hashed without gathering a conversation: rows (of digests, texts never move) are
sorted over range partitions by (conversation, turn), and a conversation that spans several partitions gets its
offsets from one row per partition. A prefix is named by the xor of 2 x 64 bits over its (place, turn) hashes, so
that prefixes combine across partitions. Paths are collected per (conversation, band), ``HEIGHT`` + 1 keys at most.
The ids under a node's ``ends_sha256`` are sorted over range partitions too, joined in pieces there, and hashed piece
by piece.

Defined cases: null role or text: empty; rows without conv_id are left out, as no member could be named; null turns
come first; rows that agree in turn are ordered by a digest of role and text, and repeated rows are turns of their
own; very long texts stay whole; a conversation without turns is a member of the root; an empty table has no nodes,
not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wirelake.llm.common import materialise

HEIGHT = 8
WORD = r"[^\x20\x09-\x0D]+"
NO_TURNS = "0" * 32  # the empty prefix's key, in hex


def numbered(rows: DataFrame, key: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``place`` (from 1, within ``key`` by ``order``), ``rows_of_key`` and ``block`` (the sorted
    partition); no key is gathered. Rows that agree in key and order are numbered as they come."""
    ordered = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    ordered = materialise(ordered.withColumn("at", F.monotonically_increasing_id()), purpose)
    ordered = ordered.withColumn("block", F.shiftright("at", 33))
    blocks = ordered.groupBy(F.col(key).alias("of_key"), F.col("block").alias("of_block")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("of_key").orderBy("of_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("of_key", "of_block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                           F.sum("n").over(Window.partitionBy("of_key")).alias("rows_of_key"))
    met = ordered.join(blocks, (F.col(key) == F.col("of_key")) & (F.col("block") == F.col("of_block")))
    return met.select(*rows.columns, "block", (F.col("at") - F.col("first") + F.col("offset") + 1).alias("place"), "rows_of_key")


def _key(a: str, b: str) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (a, b)]))


def _members(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent, words, ends: one row for every conversation and prefix, the empty one included."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = numbered(rows, "conv_id", ["turn", "digest"], "trie-turns")
    parts = {f"x{k}": F.xxhash64(F.lit(k), "place", "digest") for k in (0, 1)}
    within = Window.partitionBy("conv_id", "block").orderBy("place")
    rows = rows.withColumns(parts).withColumns({f"y{k}": F.bit_xor(f"x{k}").over(within) for k in (0, 1)})
    rows = materialise(rows.drop("digest", "turn"), "trie-prefixes")
    sums = rows.groupBy("conv_id", "block").agg(*[F.bit_xor(f"x{k}").alias(f"s{k}") for k in (0, 1)])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"s{k}").over(before), F.lit(0).cast("long")).alias(f"base{k}") for k in (0, 1)])
    rows = rows.join(sums, ["conv_id", "block"])
    rows = rows.withColumns({f"z{k}": F.col(f"y{k}").bitwiseXOR(F.col(f"base{k}")) for k in (0, 1)})
    rows = rows.withColumns({f"p{k}": F.col(f"z{k}").bitwiseXOR(F.col(f"x{k}")) for k in (0, 1)})
    prefixes = rows.select("conv_id", F.col("place").alias("depth"), _key("z0", "z1").alias("key"), _key("p0", "p1").alias("parent"),
                           "words", (F.col("place") == F.col("rows_of_key")).alias("ends"))
    ids = conversations.filter("conv_id IS NOT NULL").select("conv_id").distinct()
    turned = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").alias("turned")).distinct()
    roots = ids.join(turned, F.col("conv_id") == F.col("turned"), "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(NO_TURNS)).alias("key"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"), F.col("turned").isNull().alias("ends"))
    return prefixes.unionByName(roots)


def _placed(members: DataFrame, height: int, levels: int) -> DataFrame:
    """One row per (level, below, key): of level 0 and not ``below`` the nodes, with their counts. ``path`` holds the
    keys from the band's root to the node; of rows ``below`` a band, which are roots of the next one, those of the
    band above them. Level l has the nodes at depths that are multiples of height**l."""
    step = F.element_at(F.array(*[F.lit(height**k).cast("long") for k in range(levels)]), F.col("level") + 1)
    at = F.floor(F.col("depth") / step).cast("long")
    rows = members.withColumn("level", F.explode(F.array(*[F.lit(k) for k in range(levels)]))).filter(F.col("depth") % step == 0).withColumn("at", at)
    band = F.floor(F.col("at") / height).cast("long")
    own, above = F.struct(band.alias("band"), F.lit(False).alias("below")), F.struct((band - 1).alias("band"), F.lit(True).alias("below"))
    edge = (F.col("at") % height == 0) & (F.col("at") > 0) & (F.col("level") < levels - 1)
    rows = rows.withColumn("stand", F.explode(F.when(edge, F.array(own, above)).otherwise(F.array(own)))).select("*", "stand.*").drop("stand")
    window = Window.partitionBy("conv_id", "level", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("path", F.collect_list("key").over(window))
    rows = rows.withColumn("path", F.when(F.col("below"), F.slice("path", F.lit(1), F.size("path") - 1)).otherwise(F.col("path")))
    return rows.groupBy("level", "below", "key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"),
        F.count(F.lit(1)).alias("n_convs"), F.count_if("ends").alias("n_ends"), F.first("path").alias("path"))


def _totals(placed: DataFrame, levels: int) -> DataFrame:
    """key, n_children, n_leaves, saved_tokens, over whole subtrees."""
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]

    def up(values: DataFrame) -> DataFrame:
        return values.select(F.explode("path").alias("key"), "n_leaves", "saved_tokens").groupBy("key").agg(*sums)

    nodes = placed.filter("level = 0 AND NOT below").withColumns({
        "n_leaves": (F.col("n_ends") == F.col("n_convs")).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    in_band = [materialise(up(nodes), "trie-band")]
    for level in range(1, levels):
        paths = placed.filter((F.col("level") == level) & ~F.col("below")).select("key", "path")
        in_band.append(materialise(up(in_band[-1].join(paths, "key")), "trie-band"))
    whole = in_band.pop()
    while in_band:
        paths = placed.filter((F.col("level") == len(in_band) - 1) & F.col("below")).select("key", "path")
        handed = whole.join(paths, "key").select(F.explode("path").alias("key"), "n_leaves", "saved_tokens")
        whole = materialise(in_band.pop().unionByName(handed).groupBy("key").agg(*sums), "trie-whole")
    zero = F.lit(0).cast("long")
    children = nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("key"), zero.alias("n_leaves"), zero.alias("saved_tokens"), (zero + 1).alias("n_children"))
    return whole.withColumn("n_children", zero).unionByName(children).groupBy("key").agg(*sums, F.sum("n_children").alias("n_children"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(key, conv_id) -> key, ends_sha256: hex digest of the ids, ascending, comma-joined."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
            joined = [",".join(map(str, ids[a:b])) for a, b in zip(starts, [*starts[1:], len(keys)])]
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in starts], pa.binary()), pa.array([ids[k] for k in starts], pa.int64()), pa.array(joined, pa.string())],
                                             ["key", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key == last:
                    state.update(b"," + ids.encode())
                else:
                    if state:
                        done.append((last, state.hexdigest()))
                    last, state = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
            done = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])

    joined = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. turns: conv_id, turn, role, text. ``conversations`` (conv_id) names those without
    turns too; else they are those that have turns."""
    members = materialise(_members(turns, turns if conversations is None else conversations), "trie-members")
    deepest = members.agg(F.max("depth")).first()[0] or 0
    levels = 1
    while height**levels <= deepest:
        levels += 1
    placed = materialise(_placed(members, height, levels), "trie-nodes")
    totals = _totals(placed, levels)
    ends = _end_digests(members.filter("ends").select("key", "conv_id"))
    nodes = placed.filter("level = 0 AND NOT below").select("key", "conv_id", "depth", "parent", "n_convs")
    above = nodes.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(totals, "key").join(ends, "key", "left").join(above, F.col("parent") == F.col("above"), "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


# -- the query's input: conversations rebuilt so that they share first turns, as its contract says --------------------

FAMILY, SHARED = 20, 4


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) of the rebuilt conversations: conversation c - c % 20's first h turns, then
    c's own after its first h; h = crc32(c) % 4."""
    shared = F.crc32(F.col("conv_id").cast("string")) % SHARED
    rows = numbered(conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text"), "conv_id", ["turn", "role", "text"], "trie-input")
    own = rows.filter(F.col("place") > shared).select("conv_id", F.col("place").alias("turn"), "role", "text")
    ids = conversations.filter("conv_id IS NOT NULL").select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"), shared.alias("h")).filter("h > 0")
    heads = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED)).select(F.col("conv_id").alias("head"), F.col("place").alias("turn"), "role", "text")
    return own.unionByName(ids.join(heads, "head").filter("turn <= h").select("conv_id", "turn", "role", "text"))


ORACLE = r"""
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS head, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM numbered
), rebuilt AS (
  SELECT c.conv_id, n.place, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.head AND n.place <= c.h
  UNION ALL SELECT n.conv_id, n.place, n.role, n.text FROM numbered n JOIN convs c ON c.conv_id = n.conv_id AND n.place > c.h
), keyed AS (
  SELECT conv_id, place, md5(md5(role) || md5(text)) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
), whole AS (
  SELECT c.conv_id, coalesce(list(k.turn ORDER BY k.place) FILTER (k.turn IS NOT NULL), []) AS turns,
         coalesce(list(k.words ORDER BY k.place) FILTER (k.turn IS NOT NULL), []) AS words
  FROM convs c LEFT JOIN keyed k ON k.conv_id = c.conv_id GROUP BY c.conv_id
), members AS (
  SELECT conv_id, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth, turns, words FROM whole
), nodes AS (
  SELECT depth, array_to_string(turns[1:depth], '') AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM members GROUP BY depth, key
), children AS (
  SELECT n.depth, n.key, count(c.key) AS n_children FROM nodes n
  LEFT JOIN nodes c ON c.depth = n.depth + 1 AND substr(c.key, 1, CAST(32 * n.depth AS BIGINT)) = n.key GROUP BY n.depth, n.key
), subtrees AS (
  SELECT n.depth, n.key, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved_tokens
  FROM nodes n JOIN nodes m ON m.depth >= n.depth AND substr(m.key, 1, CAST(32 * n.depth AS BIGINT)) = n.key
  JOIN children c ON c.key = m.key GROUP BY n.depth, n.key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, c.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN children c ON c.key = n.key JOIN subtrees s ON s.key = n.key
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.key = substr(n.key, 1, CAST(32 * (n.depth - 1) AS BIGINT))
"""
