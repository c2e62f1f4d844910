"""Record-error and column-error ledgers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from rowproof.functions.columns import named
from rowproof.functions.dates import iso_text
from rowproof.operators.copies import COPIES, count_copies, expand_copies
from rowproof.operators.lookup import lookup
from rowproof.operators.validate import FINDINGS, Validation
from rowproof.reference_data import (
    DUPLICATE_COLUMN_NAME,
    DUPLICATE_RECORD,
    DUPLICATE_RECORD_TEXT,
    ERROR_MESSAGES,
)

@dataclass(frozen=True)
class Ledger:
    """``records``: record_id, processing_file_id, record_text.
    ``columns``: record_id, processing_file_id, column_name, error_code."""

    records: DataFrame
    columns: DataFrame

    def union(self, other: "Ledger") -> "Ledger":
        return Ledger(
            self.records.unionByName(other.records), self.columns.unionByName(other.columns)
        )


def error_reference(spark: SparkSession) -> DataFrame:
    """The table of error codes and messages."""
    rows = ", ".join(f"({code}, '{message}')" for code, message in ERROR_MESSAGES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes(error_code, error_message)")


def code_for(message: Column, reference: dict[int, str] = ERROR_MESSAGES) -> Column:
    """Code of a message by exact text; null when there is none."""
    pairs = [F.lit(item) for code, text in reference.items() for item in (text, code)]
    return F.try_element_at(F.create_map(*pairs), message)


def attach_codes(df: DataFrame, reference: DataFrame, message: str = "error_message") -> DataFrame:
    """Code of each message by lookup in a reference table."""
    return lookup(df, reference, {message: "error_message"}, {"error_code": "error_code"})


def record_json(schema: StructType, columns: Sequence[str]) -> Column:
    """Some columns of a row as a JSON object; nulls are kept, times are ISO text."""
    values = [
        iso_text(named(name)).alias(name)
        if isinstance(schema[name].dataType, (TimestampType, TimestampNTZType))
        else named(name)
        for name in columns
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def record_id(file_id: Column, ordinal: Column, text: Column) -> Column:
    """Content id; equal records of a file differ by their ordinal."""
    return F.md5(F.concat_ws("|", file_id.cast("string"), ordinal.cast("string"), text))


def numbered_rejects(
    validation: Validation,
    file_id: int | Column,
    columns: Sequence[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Rejected rows as record_id, processing_file_id, record_text and findings.

    ``columns`` are those of the record text, by default all of the validated frame.
    ``distinct`` says that no row has a copy, which saves the shuffle of the count.

    Equal rejected rows are counted first and numbered afterwards, so that no window has
    to hold all copies of a row.
    """
    source = validation.source
    file_id = F.lit(file_id) if isinstance(file_id, int) else file_id
    texts = validation.rejected.select(
        file_id.alias("processing_file_id"),
        record_json(source.schema, columns or source.columns).alias("record_text"),
        FINDINGS,
    )
    if distinct:
        rows = texts.withColumn("ordinal", F.lit(1))
    else:
        rows = expand_copies(count_copies(texts))
    return rows.select(
        record_id(F.col("processing_file_id"), F.col("ordinal"), F.col("record_text")).alias(
            "record_id"
        ),
        "processing_file_id",
        "record_text",
        FINDINGS,
    )


def ledger_of(rejects: DataFrame) -> Ledger:
    """Both ledgers from :func:`numbered_rejects` (settle it first when it is large)."""
    records = rejects.select("record_id", "processing_file_id", "record_text")
    found = rejects.select("record_id", "processing_file_id", F.explode(FINDINGS).alias("f"))
    columns = found.select(
        "record_id",
        "processing_file_id",
        F.col("f.column_name").alias("column_name"),
        code_for(F.col("f.error_message")).alias("error_code"),
    )
    return Ledger(records, columns)


def duplicate_ledger(
    counted: DataFrame, file_id: int | Column, per_row: bool = False, within: Sequence[str] = ()
) -> Ledger:
    """Ledger entries for the copies found by :func:`count_copies`.

    By default one entry stands for all copies of the file; with ``per_row`` each row
    that has copies gets its own. Where the rows of several files are judged at once,
    ``within`` names the columns that tell files apart, and ``file_id`` is made from them.
    """
    repeated = counted.filter(F.col(COPIES) > 1)
    file_ref = F.lit(file_id) if isinstance(file_id, int) else file_id
    of_file = file_ref.alias("processing_file_id")
    if per_row:
        names = [name for name in counted.columns if name != COPIES and name not in within]
        texts = repeated.select(of_file, record_json(counted.schema, names).alias("record_text"))
    elif within:
        texts = repeated.select(of_file).distinct().select(
            "processing_file_id", F.lit(DUPLICATE_RECORD_TEXT).alias("record_text")
        )
    else:
        texts = (
            repeated.agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 0")
            .select(of_file, F.lit(DUPLICATE_RECORD_TEXT).alias("record_text"))
        )
    records = texts.select(
        record_id(F.col("processing_file_id"), F.lit(1), F.col("record_text")).alias("record_id"),
        "processing_file_id",
        "record_text",
    )
    columns = records.select(
        "record_id",
        "processing_file_id",
        F.lit(DUPLICATE_COLUMN_NAME).alias("column_name"),
        code_for(F.lit(DUPLICATE_RECORD)).alias("error_code"),
    )
    return Ledger(records, columns)
