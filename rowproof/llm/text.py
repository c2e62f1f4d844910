"""What the operators share: bounded batches, words, checksums and bounded samples."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.session import settle

UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = UPPER.lower()

#: A-Z to lower case; ASCII that is neither letter nor digit to a blank; all else stays.
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

# A batch handed to Python holds at most so many rows and bytes (one row may be larger).
BATCH_ROWS = 1000
BATCH_BYTES = 32 * 1024 * 1024


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch carries, so that long texts do not fill a worker."""
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        if spark.conf.get(key, None) != str(value):
            spark.conf.set(key, str(value))


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; other columns never meet their own names."""
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))


T = TypeVar("T")


def share(spark: SparkSession, value: T) -> Callable[[], T]:
    """A function that gives ``value`` inside tasks.

    A worker unpacks it once and keeps it, with whatever the value itself remembers, for its
    later tasks.
    """
    held = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    def get() -> T:
        box = held.value
        if "value" not in box:
            box["value"] = pickle.loads(box["packed"])
        return box["value"]

    return get


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def ascii_lower(column: Column) -> Column:
    """A-Z to lower case, nothing else."""
    return F.translate(column, UPPER.decode(), LOWER.decode())


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), divisor)


def bounded_sample(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """The ``most`` rows whose keys have the smallest hashes, the same at every run, written once."""
    spread = F.xxhash64(*[rows[k] for k in keys], F.lit("sample"))
    return settle(rows.orderBy(spread, *[rows[k] for k in keys]).limit(most), "sample")


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
