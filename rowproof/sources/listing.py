"""Finding the newest file of one folder or of many.

Listings are frames of path, modification time and length; file contents are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.functions.columns import named
from rowproof.functions.numbers import to_int
from rowproof.reference_data import YEARLY_COLUMNS
from rowproof.sources.csv import read_csv_text


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files of a folder (or glob of folders) as folder, path, modified_at, length."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    return files.select(
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
        "path",
        F.col("modificationTime").alias("modified_at"),
        "length",
    )


def scanned_file_name() -> Column:
    """Name of the file a scanned row comes from; the scan itself reports it URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def newest_per_folder(files: DataFrame) -> DataFrame:
    """The file modified last in each folder; equal times go to the greater path."""
    newest = F.max(F.struct("modified_at", "path", "length")).alias("f")
    return files.groupBy("folder").agg(newest).select("folder", "f.*")


def latest_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str:
    """Path of the file modified last."""
    newest = list_files(spark, folder, pattern).agg(F.max(F.struct("modified_at", "path")).alias("f"))
    found = newest.select("f.path").first()
    if found is None or found.path is None:
        raise FileNotFoundError(f"no {pattern} file in {folder}")
    return found.path


def align(df: DataFrame, columns: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """``columns`` in order, cast to ``types`` (text by default); missing ones are null."""
    present = set(df.columns)

    def cast(name: str) -> Column:
        kind = types.get(name, "string")
        if name not in present:
            return F.lit(None).cast(kind)
        if kind in ("int", "bigint"):
            return to_int(named(name), kind)
        return named(name).try_cast(kind)

    return df.select(*[cast(name).alias(name) for name in columns])


def merge_yearly(
    spark: SparkSession,
    base: str,
    years: Iterable[int] | None = None,
    folder_name: str = "Processed_EVTRA_{year}",
    columns: Sequence[str] = YEARLY_COLUMNS,
    types: Mapping[str, str] | None = None,
) -> DataFrame | None:
    """Newest file of each yearly folder, aligned by column name and appended.

    All folders that fit ``folder_name`` are read, or those of ``years`` only. Folders that are
    missing or hold no CSV file are skipped; None when all are.
    """
    names = (
        folder_name.format(year="[0-9][0-9][0-9][0-9]") if years is None
        else f"{{{','.join(folder_name.format(year=year) for year in years)}}}"
    )
    try:
        newest = newest_per_folder(list_files(spark, f"{base}/{names}")).orderBy("folder")
        paths = [row.path for row in newest.select("path").toLocalIterator()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    merged = None
    for path in paths:
        year = align(read_csv_text(spark, path), columns, types or {})
        merged = year if merged is None else merged.unionByName(year)
    return merged
