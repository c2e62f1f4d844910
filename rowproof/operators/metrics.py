"""Run metrics, batch counts and the state of runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowproof.functions.columns import named
from rowproof.operators.validate import FINDINGS, Validation
from rowproof.reference_data import ERROR_MESSAGES


def run_metrics(validation: Validation) -> DataFrame:
    """Initial, processed and error records and distinct error codes, from one pass.

    The codes that can occur are those of the rules, so each is one flag in the
    aggregation and nothing is exploded or shuffled but one row per task.
    """
    rejected = F.size(FINDINGS) > 0
    messages = sorted({rule.message for rule in validation.rules})

    def seen(message: str) -> Column:
        hit = F.exists(FINDINGS, lambda f: f["error_message"] == message)
        return F.coalesce(F.max(hit.cast("int")), F.lit(0))

    distinct = F.lit(0)
    for message in messages:
        distinct = distinct + seen(message)
    return validation.annotated.agg(
        F.count(F.lit(1)).alias("initial_count"),
        F.count_if(~rejected).alias("processed_count"),
        F.count_if(rejected).alias("error_count"),
        distinct.cast("long").alias("distinct_error_count"),
    )


#: The first of 63 codes that are counted as bits of one number.
FIRST_BIT_CODE = min(ERROR_MESSAGES)


def error_metrics(records: DataFrame, columns: DataFrame) -> DataFrame:
    """Error records and distinct error codes per file, from the two ledgers.

    Each code of the reference table is one bit, and bits merge by bitwise or, so both ledgers
    go through one aggregation with one shuffle of a row per file and task. Codes that the
    number has no bit for are gathered as a set.
    """
    code = F.col("error_code") - FIRST_BIT_CODE
    has_bit = code.between(0, 62)
    one = F.lit(1).cast("long")
    of_records = records.select("processing_file_id", one.alias("n"), F.lit(0).cast("long").alias("bits"), F.lit(None).cast("int").alias("other"))
    of_columns = columns.select(
        "processing_file_id", F.lit(0).cast("long").alias("n"),
        F.when(has_bit, F.call_function("shiftleft", one, code.cast("int"))).otherwise(F.lit(0)).cast("long").alias("bits"),
        F.when(~has_bit, F.col("error_code")).cast("int").alias("other"),
    )
    merged = of_records.union(of_columns).groupBy("processing_file_id").agg(
        F.sum("n").alias("error_count"),
        (F.bit_count(F.bit_or("bits")) + F.size(F.collect_set("other"))).cast("long").alias("distinct_error_count"),
    )
    # A file is counted when it has records.
    return merged.filter("error_count > 0")


def latest_batch_count(df: DataFrame, created_at: str = "created_at") -> DataFrame:
    """Rows of the batch written last; 0 for an empty table. One scan of one column."""
    batches = df.groupBy(named(created_at).alias("batch")).agg(F.count(F.lit(1)).alias("n"))
    return batches.agg(
        F.coalesce(F.max_by("n", "batch"), F.lit(0)).alias("processed_count")
    )


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return how many rows it wrote, without a second scan."""
    observation = Observation()
    write(df.observe(observation, F.count(F.lit(1)).alias("rows")))
    return observation.get.get("rows", 0)


def run_state(events: DataFrame, run_id: str, event_time: str, fields: Mapping[str, str]) -> DataFrame:
    """Latest state per run from an append-only event table.

    Each event sets some fields and leaves the others null; a field keeps its newest
    value, the greatest one of those set at the same time. ``fields`` maps event columns to
    names in the result.
    """
    newest = [
        F.max(
            F.when(
                named(source).isNotNull(),
                F.struct(named(event_time).alias("at"), named(source).alias("value")),
            )
        )["value"].alias(name)
        for source, name in fields.items()
    ]
    return events.groupBy(named(run_id)).agg(*newest)
