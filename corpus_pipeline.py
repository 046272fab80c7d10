"""A corpus pipeline: language ID, near duplicates, decontamination, secrets, packing.

Each stage takes the documents that the one before it kept, and all but the last return the columns of
``documents``. Between stages the documents are Parquet in the shared folder.

Defined results, stage by stage: null and empty texts have no language and go in the first stage; a stage given them
all the same keeps them (near duplicates, decontamination, secrets) or packs the end token alone. Repeated rows and rows
that share a doc_id are documents of their own; of equal texts one stays, with the smallest doc_id, null ids last.
Texts are processed whole, however long. Further columns are kept, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard_join, langid, packing, secret_scan
from tidemark.session import bound_batches, discard, scratch_path, settle, ship_package

# Near copies: Jaccard similarity of the sets of five-word shingles.
NEAR_WORDS = 5
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and texts no model can code."""
    ship_package(bound_batches(spark))
    model = langid.learn(docs.where(~langid.held_out("doc_id", 4)))
    return langid.drop_unidentified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, the one with the smallest doc_id; texts without words stay."""
    ship_package(bound_batches(spark))
    return jaccard_join.keep_first(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go."""
    ship_package(bound_batches(spark))
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    ship_package(bound_batches(spark))
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: pieces of documents with their token ids."""
    ship_package(bound_batches(spark))
    return packing.pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", pack),
]

# Models, tokenizers and iteration are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        docs = settle(stage(spark, docs, sf_dir), name, path)
        if before:  # what the stage before kept is no longer needed
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
