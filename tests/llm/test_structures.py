"""Filter audit, prefix trie and chat formatting against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import pytest

from tests.llm.fixtures import awkward, awkward_rows, empty, labels, table
from wirelake.llm import chat_format, filter_audit, prefix_trie

CHAT = "conv_id long, turn long, role string, text string, `key` string, `place` long, `block` long, `path` string, `turns` string, `level` int, `formatted` string"


def chat_table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 7, "clash", "clash", 7, "clash") for r in rows], CHAT).repartition(3)


def sorted_turns(rows):
    """Turns by conversation, in order: null turn, role, text."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in out.items()}


AWKWARD_CHATS = [
    (1, 0, "user", "hello </s>"), (1, 1, "assistant", "a [/INST] b"), (1, 2, "assistant", "\\[INST] [\\INST] <\\\\/s> <s><s>"), (1, 3, "user", None),
    (2, None, "system", ""), (2, 0, None, "no role"), (2, 0, None, "no role"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"),
    (3, 5, "assistant", "[[INST]["), (3, 6, "assistant", "<</s"), (3, 7, "assistant", "/INST]"), (3, 8, "[SAYS]", "s>"), (4, 0, "user", "é😀\x00\n" * 3000),
    (None, 1, "user", "lost"), (None, 2, "assistant", "too"), (5, 0, None, None), (6, 0, "assistant", "x" * 200000), (-7, 1, "user", "neg"),
]


def test_chats_read_back(spark):
    rng = random.Random(1)
    bits = ["[INST]", "</s>", "<s>", "[", "<", "\\", "[NEXT]", "[SAYS]", "[/INST]", "word ", "INST]", "s>", "/s>", "é"]
    rows = AWKWARD_CHATS + [(100 + c, t, rng.choice(["user", "assistant", "tool<s>"]), "".join(rng.choices(bits, k=rng.randrange(9)))) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(900, t, ["user", "assistant"][t % 3 == 0], f"turn {t}") for t in range(700)]  # more than one chunk of offsets
    chats = chat_format.format_chats(chat_table(spark, rows))
    want = sorted_turns(rows)
    got = {r.conv_id: r for r in chat_format.read_chats(chats).collect()}
    assert {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()} == want
    assert {c: r.loss_text for c, r in got.items()} == {c: "".join(t for r, t in v if r == "assistant") for c, v in want.items()}
    digests = {r.conv_id: r for r in chat_format.digest_columns(chats).collect()}
    for c, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert digests[c].n_turns == len(turns) and digests[c].loss_chars == len(said) and digests[c].formatted_chars == len(got[c].formatted)
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert digests[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    for r in chats.collect():  # one begin, one end; as many headers as runs of a role; spans are whole texts
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == 1
        turns = want[r.conv_id]
        assert r.formatted.count("[INST]") == r.formatted.count("[/INST]") == sum(k == 0 or turns[k - 1][0] != turns[k][0] for k in range(len(turns)))
        octets = r.formatted.encode()
        assert all(octets[s.start - 1 : s.start] == b"]" and octets[s.stop : s.stop + 1] == b"[" for s in r.loss)
        assert len(r.loss) == sum(role == "assistant" for role, _ in turns)


def test_chats_native_and_empty(spark):
    made = chat_format.digest_columns(chat_format.format_chats(chat_format.with_planted(chat_table(spark, AWKWARD_CHATS))))
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    planted = made.filter("conv_id = -1").first()
    assert planted.n_turns == 2 and planted.loss_chars == len(chat_format.PLANTED)
    assert planted.formatted_chars == len(r"<s>[INST]user[SAYS]<\/s>[\INST] ok [\/INST][/INST][INST]assistant[SAYS]<\/s>[\INST] ok [\/INST][/INST]</s>")
    assert chat_format.digest_columns(chat_format.format_chats(chat_table(spark, []))).count() == 0


@pytest.fixture
def many_partitions(spark):
    """Small tables, too, are dealt over all partitions, so that conversations span several."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def plain_trie(turns: dict) -> set:
    """turns: conv_id -> [(role, text)] -> rows as the operator returns them."""
    members, ends = defaultdict(set), defaultdict(set)
    for c, seq in turns.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
        ends[tuple(seq)].add(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * words(node)
    return {(min(of), len(n), min(members[n[:-1]]) if n else None, len(of), children[n], leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, of in members.items()}


@pytest.mark.parametrize("height", [2, 3, 8])
def test_trie(spark, many_partitions, height):
    rng = random.Random(height)
    turns = {}
    for c in range(60):
        seq = list(rng.choice(list(turns.values()))) if turns and rng.random() < 0.7 else []
        seq = seq[: rng.randrange(len(seq) + 1)]
        turns[c * 7 - 50] = seq + [(rng.choice(["user", "assistant"]), rng.choice(["a b", "a  b", "c", "", "x y z"])) for _ in range(rng.randrange(6))]
    turns[1000] = [("user", f"turn {t}") for t in range(45)]
    turns[1001] = turns[1000][:30] + [("user", "other")] * 11
    rows = [(c, t, *turn) for c, seq in turns.items() for t, turn in enumerate(seq)]
    ids = spark.createDataFrame([(c,) for c in turns], "conv_id long")
    got = prefix_trie.prefix_trie(chat_table(spark, rows), ids, height)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain_trie(turns)


def test_trie_awkward(spark):
    def order(c):
        """As the operator orders ties: by a digest of role and text."""
        mine = [((t is not None, t or 0), hashlib.md5(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), (r or "", x or "")) for k, t, r, x in AWKWARD_CHATS if k == c]
        return [m[2] for m in sorted(mine)]

    turns = {c: order(c) for c in {r[0] for r in AWKWARD_CHATS} - {None}}
    assert {tuple(r) for r in prefix_trie.prefix_trie(chat_table(spark, AWKWARD_CHATS)).collect()} == plain_trie(turns)
    assert prefix_trie.prefix_trie(chat_table(spark, [])).count() == 0


def test_trie_of_rebuilt_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}") for c in [*range(55), -3, -25] for t in range(rng.randrange(1, 6)) if c != 20]
    own = sorted_turns(rows)
    turns = {}
    for c, seq in own.items():
        h, head = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        turns[c] = own.get(head, [])[:h] + seq[h:]
    assert any(not t for t in turns.values())
    docs = chat_table(spark, rows)
    assert {tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.rebuilt(docs), docs).collect()} == plain_trie(turns)


def test_numbering_splits_a_conversation(spark, many_partitions):
    rows = spark.range(5000).selectExpr("1L AS conv_id", "(id * 7919) % 5000 AS turn", "cast(id as string) AS text").repartition(4)
    got = prefix_trie.numbered(rows, "conv_id", ["turn"], "test").cache()
    assert got.filter("place = turn + 1 AND rows_of_key = 5000").count() == 5000
    assert got.select("block").distinct().count() > 1


def plain_audit(rows, marks):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = defaultdict(lambda: [0] * 7)
    orders = list(permutations("ABCDE"))
    for i, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                                               re.search("[#$%&*|]", text), i is not None and i > first[text]]) if bad}
        good, toxic = (any(m[0] == i is not None and m[k] == 1 for m in marks) for k in (1, 2))
        for order in orders:
            gone = False
            for step, f in enumerate(order, 1):
                cell = out[source or "", "".join(order), step]
                here = f in fails and not gone
                cell[2] += f in fails and gone
                gone |= here
                for k, x in ((0, not gone), (1, here), (3, fails == {f}), (4, here and good), (5, here and toxic)):
                    cell[k] += bool(x)
    sums = defaultdict(int)
    for (part, order, step), cell in out.items():
        sums[part, order[step - 1]] += cell[1]
    return {(part, order, step, *cell[:6], sums[part, order[step - 1]]) for (part, order, step), cell in out.items()}


def test_audit(spark):
    rng = random.Random(2)
    rows = awkward_rows()
    for k in range(120):
        text = " ".join(rng.choice(["alpha", "Beta", "GAMMA", "d%", f"w{rng.randrange(400)}", f"v{rng.randrange(400)}"]) for _ in range(rng.choice([5, 49, 50, 80])))
        rows += [(1000 + k, text, "en", rng.choice(["s1", "s2", None, ""]))] + [(2000 + k, text, "en", "s3")] * (k % 5 == 0) + [(1000 + k, text, "en", "s4")] * (k % 7 == 0)
    rows += [(3000 + k, " ".join(f"w{k * 60 + j}" for j in range(60)), "en", "s5") for k in range(5)]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(1000, 1100)] + [(1001, 1, 1), (None, 1, 1), (1001, 0, 0)]
    got = filter_audit.audit_documents(table(spark, rows), labels(spark, marks))
    assert {f.name: f.dataType.simpleString() for f in got.schema}["step"] == "int"
    found = [tuple(r) for r in got.collect()]
    want = plain_audit(rows, marks)
    assert len(found) == len(want) and set(found) == want


def test_audit_awkward(spark):
    found = [tuple(r) for r in filter_audit.audit_documents(awkward(spark), labels(spark)).collect()]
    assert set(found) == plain_audit(awkward_rows(), []) and len(found) == 600 * len({r[3] or "" for r in awkward_rows()})
    assert filter_audit.audit_documents(empty(spark), labels(spark)).count() == 0


def test_removal_steps_are_a_min_plus_product():
    import numpy as np

    orders, positions = filter_audit._positions(3)
    masks = np.array([[False, False, False], [True, False, True]])
    steps = filter_audit.removal_steps(masks, positions)
    for o, order in enumerate(orders):
        assert steps[0, o] == 4 and steps[1, o] == min(list(order).index(f) + 1 for f in (0, 2))
