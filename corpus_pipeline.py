"""The corpus pipeline: toxic texts, near-duplicates and contaminated texts go, personal data is replaced, and what
stays is encoded. Each stage works on all rows the one before kept, written as Parquet and read again.

Near-duplicates: of each class the row of the smallest id stays. Contaminated: a text goes as a whole.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import decontamination, minhash, personal, pieces, toxicity
from panelspark.llm.tables import table
from panelspark.workspace import stored


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def impersonal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal.without_personal_data(docs, length_col="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their ids (``ids``) and what these decode to (``decoded``), which is the text."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded_col="decoded")


STAGES = [
    ("toxicity", nontoxic),
    ("near_duplicates", distinct),
    ("decontamination", uncontaminated),
    ("personal_data", impersonal),
    ("sentencepiece", encoded),
]

#: A network and a BPE model are no SQL; tests/llm holds each operator against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    def step(docs: DataFrame, stage) -> DataFrame:
        return stored(stage[1](spark, docs, sf_dir), stage[0])

    return functools.reduce(step, STAGES, table(spark, sf_dir, "documents"))
