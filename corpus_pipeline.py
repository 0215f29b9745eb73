"""A document pipeline over the operators of ``codexflow.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next
stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from codexflow.llm import exact_dedup, fm_decontam, ppm_language, sentencepiece_bpe, shared, shingle_join


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that language identification rejects: those without a letter, and those no learned language's tree codes in fewer bits than they have."""
    return ppm_language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z the document with the largest id stays."""
    return exact_dedup.keep_winners(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 80 % of their five-word shingles the smallest id stays."""
    shared.give_back(spark)
    return shingle_join.keep_smallest(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of ten words of a benchmark item occurs go."""
    shared.give_back(spark)
    return fm_decontam.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document that is left."""
    shared.give_back(spark)
    return sentencepiece_bpe.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Language identification and encoding can't be expressed in SQL; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored in the shared folder."""
    where = shared.shared_dir(spark)
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def step(docs: DataFrame, stage: tuple[int, tuple[str, Callable]]) -> DataFrame:
        k, (name, function) = stage
        return shared.stored(function(spark, docs, sf_dir), f"{where}/{k}-{name}")

    return functools.reduce(step, enumerate(STAGES), first)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
