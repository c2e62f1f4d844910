"""Bounded labelled samples and models fitted to them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, bounded_sample, remainder

#: Documents are held out from learning when crc32(doc_id) modulo this is 0.
FOLDS = 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(text, y) of at most ``most`` labelled documents outside the held-out fold.

    A document labelled more than once counts as its larger label, a doc_id with more than one
    text as the smallest of them; null ids, texts and labels teach nothing.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .filter(remainder(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = bounded_sample(present, most, "doc_id")
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(chosen, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def fit_in_a_task(sample: DataFrame, fit: Callable[[Iterator[tuple[str, int]]], object]) -> object:
    """``fit`` the rows (text, y) of a bounded sample in one task, in an order of their own."""
    bound_batches(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for batch in batches
            for row in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True)
        )
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    one = sample.select("doc_id", "text", "y").repartition(1).sortWithinPartitions("doc_id")
    fitted = one.mapInArrow(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else fit(iter(()))  # no rows, maybe no task


def scored(docs: DataFrame, scorer: Callable[[], Callable[[bytes], float]], threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; ``scorer`` is made once per task."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in batches:
            scores = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.mapInArrow(run, f"doc_id {key}, held_out boolean, score double, predicted int")
