"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes the documents that the stage before it wrote, applies one
operator and returns documents again; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import minhash, packing, pii, quality_rules, substring
from tessera.llm.scratch import Scratch

#: Working tables of the stage before, which its written output replaces.
_spent: list[Scratch] = []


def _scratch(spark: SparkSession, name: str, first: bool = False) -> Scratch:
    """The stage's working folder; drops that of the stage before it, whose
    output has been written by now."""
    while _spent:
        old = _spent.pop()
        if not first:
            old.drop_all()
    _spent.append(Scratch(spark, name))
    return _spent[-1]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or an adaptive threshold go."""
    return quality_rules.good_documents(docs, _scratch(spark, "stage-quality", first=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return minhash.distinct_documents(docs, 5, 80, _scratch(spark, "stage-minhash"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more stay only where they first occur."""
    return substring.without_repeats(docs, 20, _scratch(spark, "stage-substring"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind."""
    return pii.without_personal_data(docs, _scratch(spark, "stage-pii"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch=_scratch(spark, "stage-packing"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("PII", personal_data),
    ("packing", pack),
]

#: Sketches, components and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    written = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        out = written.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            written.drop(before)
        docs = before = out
    return STAGES[-1][1](spark, docs, sf_dir)
