"""The corpus pipeline: documents in, token ids of the deduplicated and mixed corpus out.

Five stages, each of which works on all rows that the stage before has kept: toxic documents go, exact
copies go, one document of each near-duplicate class stays, sources are mixed to their target weights
(documents may be dropped or repeated), and the texts are encoded. Stage results are written below the
shared checkpoint folder and read again, so a lost executor never repeats an earlier stage.

Toxicity and near duplicates can't be expressed in SQL, so ORACLE_SQL is None; tests compare the stages
with plain Python versions.

Defined cases, as its stages have them: a null text counts as empty throughout; empty texts are scored like others, are
copies of each other (one stays), belong to one near-duplicate class, weigh nothing in the mix, and have no tokens; very
long texts go through whole; of rows that tie (equal texts, equal classes) the one with the largest id stays among
exact copies and the one with the smallest among near copies, a null id counting as the smallest and as the last;
repeated rows are reduced to one by the second stage; rows without id are kept like others; a null source is a source of
its own; without any toxic label no document scores above the prior, so none is rejected; an empty table gives an empty
result; other columns are carried to the last stage, whatever their names, which returns those of the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelake.llm import byte_bpe, exact_dedup, mixing, near_dedup, toxicity
from wirelake.llm.common import materialise, read_table
from wirelake.llm.queries import tokenizer_file

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model trained on this stage's input and the labels."""
    return toxicity.reject(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids for every row of the mix."""
    return byte_bpe.round_trip(docs, tokenizer_file(RANKS), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
