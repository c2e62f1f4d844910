"""The corpus pipeline: five stages over the table of documents.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept and
returns a frame that is written and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowproof.llm.decontaminate import remove_contaminated
from rowproof.llm.language import fit_languages, keep_identified
from rowproof.llm.piece_lattice import encoding_report
from rowproof.llm.quality_model import fit_quality, keep_quality
from rowproof.llm.simhash import one_row_of_each
from rowproof.session import prepare, remove, scratch_path, scratch_scope, settle  # noqa: F401

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    return keep_identified(docs, fit_languages(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more."""
    return keep_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: one with the smallest doc_id."""
    return one_row_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents free of benchmark passages."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, their number and checksum, and whether they decode to its text."""
    return encoding_report(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: Models, fingerprints and pieces are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again.

    What a stage settled on its way, and the documents it read, are removed once its own output
    is written. The last stage is read lazily, so its input stays.
    """
    prepare(spark, sf_dir)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
