"""Mixing, exact dedup, token counts and byte-level BPE against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.fixtures import CLASH, SCHEMA, awkward, awkward_rows, empty, prose, table
from tests.oracle_check import compare, duck
from wirelake.llm import byte_bpe, exact_dedup, mixing, token_count
from wirelake.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_sql(spark, name):
    ok, message = compare(spark, duck(SF), name, llm_queries()[name], llm_oracles()[name], SF)
    assert ok, message


def plain_targets(sizes: dict) -> dict:
    """Share by weight; stop what is above twice its size, share its excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 2 * sizes[s] + 1e-9]
        if not above:
            return stopped | {s: left * weight[s] / total for s in free}
        for s in above:
            stopped[s] = 2 * sizes[s]
            left -= 2 * sizes[s]


def test_mix_plan(spark):
    rows = awkward_rows()
    got = mixing.mix_plan(awkward(spark)).collect()
    assert len(got) == len(rows)
    size = {id(r): len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[id(r)]
    target = plain_targets(sizes)
    want = Counter((r[0], size[id(r)], sizes[r[3]], round(target[r[3]], 6)) for r in rows)
    assert Counter((g.doc_id, g["size"], g.source_size, round(g.target, 6)) for g in got) == want
    assert all(0 <= g.taken <= 2 * g["size"] and g.taken == g["size"] * g.copies for g in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_plan(awkward(spark)).collect()))


def test_mix_reaches_targets_and_keeps_columns(spark):
    docs = table(spark, [(k, prose(20 + k % 7, k), "en", "hot" if k % 3 else f"s{k % 5}") for k in range(1500)])
    plan = mixing.mix_plan(docs).toPandas()
    for _, part in plan.groupby("source_size"):
        goal = part.drop_duplicates("target").target.sum()
        assert abs(part.taken.sum() - goal) < 0.15 * goal
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == plan.copies.sum()
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mix_plan(empty(spark)).count() == 0


def test_exact_groups(spark):
    rows = awkward_rows()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(low)].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    for bits in (1, exact_dedup.WORD_BITS):  # a filter far too small changes nothing but the work
        got = exact_dedup.exact_groups(awkward(spark), word_bits=bits).collect()
        assert Counter(tuple(g) for g in got) == want
    kept = exact_dedup.exact_dedup(awkward(spark))
    assert kept.schema.simpleString() == awkward(spark).schema.simpleString()
    assert Counter(r.doc_id for r in kept.collect()) == Counter(max((i for i in ids if i is not None), default=None) for ids in groups.values())
    assert exact_dedup.exact_groups(empty(spark)).count() == exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_is_native(spark):
    for df in (exact_dedup.exact_groups(awkward(spark)), exact_dedup.exact_dedup(awkward(spark))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_unique_rows_do_not_shuffle(spark):
    """A filter of the right size lets no unique row into the shuffle."""
    docs = table(spark, [(k, f"text {k}", "en", "s") for k in range(500)] + [(1000 + k, "copy", "en", "s") for k in range(200)])
    narrow = exact_dedup._narrow(docs, "text", "doc_id")
    unique, maybe = exact_dedup._split(narrow, narrow, exact_dedup.WORD_BITS)
    assert maybe.count() == 200 and unique.count() == 500


def test_few_unique_rows_shuffle_at_millions(spark):
    """Of 2.5 million different digests, under 5 % may repeat by the filter that is sized for them; triples flag a word, no more."""
    narrow = spark.range(2_500_000).selectExpr("id", "sha2(cast(id as string), 256) AS digest")
    bits = exact_dedup._sized(2_500_000)
    unique, maybe = exact_dedup._split(narrow, narrow, bits)
    assert bits <= exact_dedup.WORD_BITS and maybe.count() < 0.05 * 2_500_000


def test_repeated_bits(spark):
    """Words tell which of their bits were set twice, however many rows they have."""
    digests = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(60)]
    rows = [(d,) for k, d in enumerate(digests) for _ in range([1, 1, 1, 2, 3][k % 5])]
    narrow = spark.createDataFrame(rows, "digest string")
    for bits in (1, 4, 12):
        unique, maybe = exact_dedup._split(narrow, narrow, bits)
        repeated = {d for k, d in enumerate(digests) if k % 5 >= 3}
        assert repeated <= {r.digest for r in maybe.collect()} and not repeated & {r.digest for r in unique.collect()}
    assert {r.digest for r in maybe.collect()} == repeated


def test_a_hot_group_is_dealt_over_tasks(spark):
    docs = table(spark, [(k, "copy", "en", "s") for k in range(3000)] + [(5000 + k, f"text {k}", "en", "s") for k in range(100)])
    got = exact_dedup.exact_groups(docs).collect()
    assert sum(r.group_size == 3000 and r.keep_id == 2999 for r in got) == 3000 and sum(r.kept for r in got) == 101
    assert {r.doc_id for r in exact_dedup.exact_dedup(docs).collect()} == {2999, *range(5000, 5100)}


def test_token_counts(spark):
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = Counter()
    for r in awkward_rows():
        n = len(tok.encode(r[1] or "", add_special_tokens=False).ids)
        want[r[0], len((r[1] or "").encode()), n, n > 512] += 1
    assert Counter(tuple(g) for g in token_count.count_tokens(awkward(spark), path).collect()) == want
    assert token_count.count_tokens(empty(spark), path).count() == 0


def test_whole_tokens_are_proven(spark):
    spec = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
    whole, tok = token_count.prove_whole_tokens(spec), Tokenizer.from_str(spec)
    some = sorted(whole)[::97]
    assert len(whole) > 40000 and all(len(e.ids) == 1 for e in tok.encode_batch(some, add_special_tokens=False))


def plain_encoding():
    ranks = byte_bpe.read_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark):
    path, plain = P.path("byte_bpe_multi_50k.tiktoken"), plain_encoding()
    want = Counter()
    for r in awkward_rows():
        ids = plain.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(g) for g in byte_bpe.round_trip(awkward(spark), path).collect()) == want
    coded = byte_bpe.encode(awkward(spark), path)
    assert Counter((g.doc_id, bytes(g.data).decode()) for g in byte_bpe.decode(coded, path).collect()) == Counter((r[0], r[1] or "") for r in awkward_rows())
    assert byte_bpe.round_trip(empty(spark), path).count() == 0


def test_long_pieces_merge_like_short_ones():
    ranks = byte_bpe.read_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    table_, byte_ids = byte_bpe.PairTable(*byte_bpe.split_pairs(ranks)), np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
    pieces = [prose(12, k).replace(" ", "").encode()[:200] for k in range(60)] + [b"ab" * 80, b"a" * 255, "日本語".encode() * 20]
    for part, ids, lens in byte_bpe.merge_pieces(pieces, byte_ids, table_):
        ends = np.cumsum(lens)
        for i, a, b in zip(part, ends - lens, ends):
            raw = byte_ids[np.frombuffer(pieces[i], dtype=np.uint8)].tolist()
            assert byte_bpe.merge_long(raw, table_.pairs).tolist() == ids[a:b].tolist()


def test_schema_names_clash():
    assert set(CLASH) <= {c.split(" ")[0].strip("`") for c in SCHEMA.split(", ")}
