"""Token counts with a whole-token shortcut.

Before the job, ``prove_whole_tokens`` establishes which vocabulary strings the tokenizer encodes, alone
and as one pre-token, as exactly one token. Tasks split texts into pre-tokens with the tokenizer's own
split pattern; a pre-token from the proven set counts 1 without any merging, and only the other distinct
pre-tokens are merged, once per worker while its bounded memory holds them, by the numpy merge rounds of
``byte_bpe`` over the tokenizer file's own merge list. A text that
contains a special token's string goes to the tokenizer whole, which treats such strings in its own way.

Defined cases: a null text counts as empty; empty texts have 0 tokens; texts of any length are counted
whole; repeated rows each get their count; an empty table gives an empty result; other columns are not
read, so clashing names do no harm. No shuffle: every row is counted where it is read. The vocabulary is
the only thing broadcast, and its size doesn't depend on the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from wirelake.llm.byte_bpe import PairTable, merge_pieces
from wirelake.llm.common import byte_slices, texts_of

LIMIT = 512
MEMORY = 400_000      # distinct merged pre-tokens that a worker remembers before it starts anew
SLICE_BYTES = 4 << 20


def split_pattern(tokenizer_json: str) -> str:
    """The split pattern of a byte-level tokenizer file; only that layout is supported."""
    spec = json.loads(tokenizer_json)
    pre = spec["pre_tokenizer"]
    plain = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre["type"] == "ByteLevel"
             and not pre.get("add_prefix_space") and pre.get("use_regex", True)
             and not any(t["normalized"] and not t["special"] for t in spec["added_tokens"]))
    if not plain:
        raise ValueError("a byte-level BPE tokenizer without normalizer and prefix space is needed")
    import public_tokenizers

    return public_tokenizers.PATTERN


def prove_whole_tokens(tokenizer_json: str) -> frozenset[str]:
    """Vocabulary strings that the pattern keeps whole and the merges turn into one token."""
    import regex
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    tok = Tokenizer.from_str(tokenizer_json)
    pattern, decoder = regex.compile(split_pattern(tokenizer_json)), ByteLevel()
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    strings = [s for v in tok.get_vocab(with_added_tokens=False) if "�" not in (s := decoder.decode([v]))]
    strings = [s for s in strings if s not in special and pattern.fullmatch(s)]
    found = tok.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, found) if len(e.ids) == 1)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself,
    the other bytes, in order, for the characters from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_table(tokenizer_json: str) -> tuple[np.ndarray, PairTable]:
    """Ids of the 256 bytes, and the file's merge list as a pair table; ids must follow the merges' order."""
    model = json.loads(tokenizer_json)["model"]
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    byte_ids = np.zeros(256, dtype=np.int32)
    for char, b in byte_alphabet().items():
        byte_ids[b] = vocab[char]
    joined = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
    if not (np.diff(joined) > 0).all():
        raise ValueError("token ids must grow along the merge list")
    return byte_ids, PairTable(*(np.array([vocab[m[k]] for m in merges], dtype=np.int64) for k in (0, 1)), joined)


class _Counter:
    """Lives in a Python worker; ``known`` maps a pre-token to its number of tokens."""

    def __init__(self, tokenizer_json: str, whole: frozenset[str]):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(tokenizer_json)
        self.find = regex.compile(split_pattern(tokenizer_json)).findall
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.whole = dict.fromkeys(whole, 1)
        self.known = dict(self.whole)
        self.byte_ids, self.table = merge_table(tokenizer_json)

    def count(self, texts: list[str]) -> list[int]:
        special = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        pieces = [self.find(t) for t in texts]
        if len(self.known) > MEMORY:
            self.known = dict(self.whole)
        new = list(set().union(*pieces).difference(self.known))
        for part, _, lens in merge_pieces([p.encode() for p in new], self.byte_ids, self.table):
            self.known.update(zip([new[i] for i in part.tolist()], lens.tolist()))
        out = [sum(map(self.known.__getitem__, ps)) for ps in pieces]
        for k in special:
            out[k] = len(self.tok.encode(texts[k], add_special_tokens=False).ids)
        return out


_counters: dict[int, _Counter] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, prove_whole_tokens(spec)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(shared.value[0].__hash__())
        if counter is None:
            _counters.clear()
            counter = _counters[shared.value[0].__hash__()] = _Counter(*shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            tokens: list[int] = []
            for start, stop in byte_slices(texts, SLICE_BYTES):
                tokens += counter.count(texts_of(texts, start, stop))
            n = pa.array(tokens, pa.int64())
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, sizes, n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    picked = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    schema = T.StructType([T.StructField("id", picked.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
