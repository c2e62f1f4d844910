"""Conversations in the order of their turns, cut into chunks that spread over tasks.

Rows are sorted by ranges of (conversation, turn), so a conversation of any size is shared by as
many tasks as it needs. A task closes a chunk at the end of a conversation or when the chunk is
full. A chunk that holds its whole conversation says so; only the others, at most two for each
task beside those of long conversations, have to meet again, one small row for each chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rowproof.llm.text import bound_batches

#: Rows and bytes of text after which a chunk is closed; one longer text fills a chunk of its own.
CHUNK_ROWS = 1024
CHUNK_BYTES = 1024 * 1024

_NOBODY = object()


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, uid, ...) sorted by conversation and turn, nulls first.

    Rows of one turn follow each other by role, then by the hash of their text; ``uid`` is their
    number, which spreads repeated rows over tasks.
    """
    bound_batches(rows.sparkSession)
    keys = ["conv_id", "turn", "role", "_h", "uid"]
    hashed = rows.withColumn("_h", F.xxhash64("text"))
    return hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_h")


def chunks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[Any, int, bool, list[tuple]]]:
    """(conversation, number within the task, whether it is the whole conversation, rows)."""
    conv, number, edge, held, size = _NOBODY, 0, True, [], 0
    text_at = names.index("text")
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for key, row in zip(batch.column("conv_id").to_pylist(), zip(*columns, strict=True), strict=True):
            if conv is _NOBODY:
                conv = key
            elif key != conv:
                yield conv, number, number == 0 and not edge, held
                conv, number, edge, held, size = key, 0, False, [], 0
            elif len(held) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                yield conv, number, False, held
                number, held, size = number + 1, [], 0
            held.append(row)
            size += len(row[text_at] or "")
    if held:
        # The conversation may go on in the next task.
        yield conv, number, False, held


def chunk_frame(ordered: DataFrame, names: list[str], build: Callable[[list[tuple]], dict], schema: str) -> DataFrame:
    """One row per chunk: conv_id, part, k, whole, and what ``build`` makes of the chunk's rows."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    frame = ordered.select("conv_id", *names)
    full = f"conv_id {kind}, part int, k int, whole boolean, {schema}"
    arrow = arrow_schema(frame.sparkSession, full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for conv, k, whole, rows in chunks(batches, names):
            made = {"conv_id": conv, "part": part, "k": k, "whole": whole, **build(rows)}
            yield pa.RecordBatch.from_pylist([made], arrow)

    return frame.mapInArrow(run, full)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def folded(
    df: DataFrame, order: list, start: Callable[[], Any], step: Callable[[Any, dict], dict | None],
    finish: Callable[[Any], dict | None], schema: str,
) -> DataFrame:
    """Streams the rows of each conversation, in ``order``, through ``step`` with a state.

    ``step`` changes the state and may give a row; ``finish`` may give one at the end. A task
    holds one state and one batch, however long a conversation is. Rows carry ``conv_id``.
    """
    kind = df.schema["conv_id"].dataType.simpleString()
    full = f"conv_id {kind}, {schema}"
    arrow = arrow_schema(df.sparkSession, full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = _NOBODY, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if conv is _NOBODY or row["conv_id"] != conv:
                    if conv is not _NOBODY and (made := finish(state)) is not None:
                        out.append({"conv_id": conv, **made})
                    conv, state = row["conv_id"], start()
                if (made := step(state, row)) is not None:
                    out.append({"conv_id": conv, **made})
            yield pa.RecordBatch.from_pylist(out, arrow)
        if conv is not _NOBODY and (made := finish(state)) is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, **made}], arrow)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, full)
