"""Row rules applied to files as they arrive in a folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowproof.operators.keystore import KeyStore, split_repeats
from rowproof.operators.ledger import ledger_of, numbered_rejects
from rowproof.operators.rules import Rule
from rowproof.operators.validate import validate
from rowproof.reference_data import DUPLICATE_COLUMN_NAME, DUPLICATE_RECORD
from rowproof.session import scratch_scope, settle
from rowproof.sources.csv import csv_options
from rowproof.sources.listing import scanned_file_name

FILE_NAME = "_file_name"


def arriving_rows(
    spark: SparkSession, folder: str, schema: StructType, multi_line: bool = True
) -> DataFrame:
    """Rows of new CSV files, read as a batch reads them, with the name of their file."""
    stream = spark.readStream.schema(schema).options(**csv_options(multi_line)).csv(folder)
    return stream.withColumn(FILE_NAME, scanned_file_name())


def validate_arrivals(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    rules: Sequence[Rule],
    output: str,
    checkpoint: str,
    attribution: str = "all",
    multi_line: bool = True,
    seen: KeyStore | None = None,
) -> StreamingQuery:
    """Validate all files not seen before, then stop.

    Each batch overwrites its own sub-folder of ``valid``, ``record_errors`` and
    ``column_errors``, so a batch replayed after a failure leaves no second copy.

    With ``seen``, a store of row digests that batch runs may share, a row that any earlier file
    has had is a duplicate and charged as such. The digests of a batch are published after its
    outputs, under its number: a batch that is replayed finds itself done, or is judged anew.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if seen is None:
            write_judged(batch, None, batch_id)
            return
        with scratch_scope(spark), seen.store.commit(spark, f"{output}#{batch_id}") as commit:
            if commit is not None:
                write_judged(*split_repeats(seen, batch, schema.names), batch_id)

    def write_judged(rows: DataFrame, repeats: DataFrame | None, batch_id: int) -> None:
        checked = validate(rows, rules, attribution)
        with scratch_scope(spark):
            rejects = numbered_rejects(checked, F.col(FILE_NAME), schema.names)
            if repeats is not None:
                every = Rule((schema.names[0],), DUPLICATE_COLUMN_NAME, DUPLICATE_RECORD, F.lit(True))
                judged = validate(repeats, [every])
                rejects = rejects.union(numbered_rejects(judged, F.col(FILE_NAME), schema.names))
            rejects = settle(rejects, "arrival-rejects")
            ledger = ledger_of(rejects)
            outputs = {
                "valid": checked.valid,
                "record_errors": ledger.records,
                "column_errors": ledger.columns,
            }
            for name, rows in outputs.items():
                rows.write.mode("overwrite").parquet(f"{output}/{name}/batch={batch_id}")

    return (
        arriving_rows(spark, folder, schema, multi_line)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
