"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing and token output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import decontamination, mixing, ngram_jaccard, token_output, toxicity
from lodestar.llm.common import materialise
from lodestar.llm.queries import table, tokenizer_path

#: Near duplicates: shingles of five words, Jaccard similarity of 0.8 or more.
NEAR = ngram_jaccard.Similarity(words=5, num=80, den=100)

#: Shares of the expected tokens; no document is dropped for them, scarcer domains are repeated ...
WEIGHTS = {"plain": 0.9, "poor": 0.1}
#: ... so many times at most.
MOST_RATE = 4.0

#: Documents scoring this or more are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose toxicity score stays below TOXIC; null and empty texts score the bias alone, repeated rows go or stay together."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, that of least id; null and empty texts are nobody's duplicates, but repeats of an id with such a text go."""
    return ngram_jaccard.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no benchmark item, told apart by id and text; null and empty texts hold none."""
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row once or more, MOST_RATE times at most: whole rows are repeated on purpose, after the stages that remove what repeats by chance."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"), WEIGHTS, most_rate=MOST_RATE)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row, read back from the token files; a null text is the end token alone."""
    return token_output.token_output(docs, tokenizer_path("byte_bpe_50k.json"), memo_chunks=60_000)  # little memory is left beside the other stages' workers


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
    ("token_output", write_tokens),
]

#: SQL cannot express a learned classifier or a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next.

    Every column of documents passes through, whatever its name; rows of null
    id or text are treated as the stages say; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
