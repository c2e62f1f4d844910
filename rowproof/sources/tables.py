"""Tables kept as Parquet folders or behind JDBC. A table that does not exist is empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowproof.functions.columns import named_all
from rowproof.session import child_names, path_exists, settle, stored_files

# SQL states of "no such table" in common databases.
MISSING_TABLE_STATES = {"42S02", "42P01", "42X05", "S0002"}


#: The version of a table that holds nothing.
EMPTY_VERSION = (0, 0)


class MixedLayout(ValueError):
    """A table holds files beside its slices; readers of slices would pass over them."""


class TableStore(Protocol):
    """Where dimensions, facts and ledgers live."""

    assigns_ids: bool

    def read(
        self, spark: SparkSession, table: str, schema: StructType,
        columns: Sequence[str] | None = None, slices: Slices | None = None,
    ) -> DataFrame: ...

    def append(self, df: DataFrame, table: str, slices: Slices | None = None) -> None: ...


@dataclass(frozen=True)
class Slices:
    """How a table is divided: ``value`` is the slice of a row, ``wanted`` the slices to read.

    A store that keeps slices apart reads the wanted ones only; any other ignores this, so the
    reader must not depend on rows being left out.
    """

    name: str
    value: Column
    wanted: Sequence[object] = ()

    def arranged(self, df: DataFrame) -> DataFrame:
        """``df`` with its slices, the rows of one brought together in few tasks.

        The rebalance hint lets adaptive execution split a slice that is too big for one.
        """
        return df.withColumn(self.name, self.value).hint("rebalance", self.name)

    @property
    def condition(self) -> Column:
        known = [value for value in self.wanted if value is not None]
        chosen = F.col(self.name).isin(known)
        return chosen | F.col(self.name).isNull() if None in self.wanted else chosen


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows; the planner sees that and drops joins against it."""
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).select(*nothing).filter(F.lit(False))


def _only(df: DataFrame, schema: StructType, columns: Sequence[str] | None) -> DataFrame:
    return df.select(*named_all(columns or schema.names))


@dataclass(frozen=True)
class ParquetStore:
    """One Parquet folder per table below ``root``, with a sub-folder per slice if asked for."""

    root: str
    assigns_ids: bool = field(default=False, init=False)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(
        self, spark: SparkSession, table: str, schema: StructType,
        columns: Sequence[str] | None = None, slices: Slices | None = None,
    ) -> DataFrame:
        path = self.path(table)
        if not path_exists(spark, path):
            return _only(empty_table(spark, schema), schema, columns)
        df = spark.read.schema(schema).parquet(path)
        if slices and slices.name in df.columns:
            df = df.filter(slices.condition)
        return _only(df, schema, columns)

    def version(self, spark: SparkSession, table: str) -> tuple[int, int]:
        """Number and bytes of a table's files; an append changes it."""
        if not path_exists(spark, self.path(table)):
            return EMPTY_VERSION
        return stored_files(spark, self.path(table))

    def append(self, df: DataFrame, table: str, slices: Slices | None = None) -> None:
        """Raises :class:`MixedLayout` where slices would come beside files without slices, or
        the other way round: such a table cannot be read."""
        self._check_layout(df.sparkSession, table, slices)
        if slices and slices.name not in df.columns:
            df = slices.arranged(df)
        writer = df.write.mode("append")
        (writer.partitionBy(slices.name) if slices else writer).parquet(self.path(table))


    def _check_layout(self, spark: SparkSession, table: str, slices: Slices | None) -> None:
        names = child_names(spark, self.path(table))
        sliced = [n for n in names if "=" in n]
        plain = [n for n in names if n.endswith(".parquet")]
        if (slices and plain) or (not slices and sliced):
            raise MixedLayout(f"table {table} is kept {'with' if sliced else 'without'} slices")


@dataclass(frozen=True)
class JdbcStore:
    """Tables of a database. ``properties`` (user, password, driver) come from the caller.

    A read is settled: the database is asked once, however often the frame is used, and
    the planner learns the size of the table, which JDBC does not tell.

    ``partitioning`` maps a table to the ``column``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` of a parallel scan; other tables are read by one task.
    """

    url: str
    properties: Mapping[str, str]
    prefix: str = ""
    partitioning: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    assigns_ids: bool = True

    def name(self, table: str) -> str:
        return f"{self.prefix}.{table}" if self.prefix else table

    def read(
        self, spark: SparkSession, table: str, schema: StructType,
        columns: Sequence[str] | None = None, slices: Slices | None = None,
    ) -> DataFrame:
        parallel = dict(self.partitioning.get(table, {}))
        try:
            df = spark.read.jdbc(
                self.url, self.name(table), properties=dict(self.properties), **parallel
            )
        except Exception as error:
            if not is_missing_table(error):
                raise
            return _only(empty_table(spark, schema), schema, columns)
        return settle(_only(df, schema, columns), "table")

    def append(self, df: DataFrame, table: str, slices: Slices | None = None) -> None:
        df = df.drop(slices.name) if slices else df
        df.write.jdbc(
            self.url, self.name(table), mode="append", properties=dict(self.properties)
        )


def is_missing_table(error: Exception) -> bool:
    """True when the database says that the table does not exist."""
    java_error = getattr(error, "java_exception", None)
    state = getattr(java_error, "getSQLState", None)
    return callable(state) and state() in MISSING_TABLE_STATES
