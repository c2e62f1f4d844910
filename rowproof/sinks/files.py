"""CSV and partitioned file outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from rowproof.operators.metrics import counted_write


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Overwrite ``path`` with CSV and a header; returns the number of rows written.

    ``single_file`` sends all rows through one task and is meant for small results.
    """
    out = df.coalesce(1) if single_file else df
    return counted_write(
        out, lambda rows: rows.write.mode("overwrite").option("escape", '"').csv(path, header=True)
    )


def write_by_value(df: DataFrame, path: str, column: str, fmt: str = "csv") -> None:
    """One sub-folder per value of ``column``.

    Rows of a value are brought together so that each sub-folder gets few files; the
    rebalance hint lets adaptive execution split a value that is too big for one task.
    """
    rows = df.hint("rebalance", column)
    rows.write.mode("overwrite").option("header", True).partitionBy(column).format(fmt).save(path)


def write_staged(frames: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """One output per staged frame below ``root``."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").option("header", True).format(fmt).save(f"{root}/{name}")
