"""Apply row rules in one projection and split the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.operators.rules import Rule
from rowproof.session import settle

FINDINGS = "_findings"
_FINDINGS_TYPE = "array<struct<column_name:string,error_message:string>>"


@dataclass(frozen=True)
class Validation:
    """A frame with the rules that apply to it. All frames derived from it are lazy.

    ``attribution="all"`` reports every broken rule of a row, ``"first"`` only the first
    one in rule order. Rules that need a column the frame lacks are in ``skipped``.
    """

    source: DataFrame
    rules: tuple[Rule, ...]
    skipped: tuple[Rule, ...]
    attribution: str

    @property
    def any_broken(self) -> Column:
        return reduce(lambda a, b: a | b, (rule.broken for rule in self.rules), F.lit(False))

    @property
    def findings(self) -> Column:
        """Broken rules of the row as an array; empty for a valid row."""
        if not self.rules:
            return F.array().cast(_FINDINGS_TYPE)
        found = [
            F.when(
                rule.broken,
                F.struct(
                    F.lit(rule.reported_as).alias("column_name"),
                    F.lit(rule.message).alias("error_message"),
                ),
            )
            for rule in self.rules
        ]
        if self.attribution == "first":
            found = [F.coalesce(*found)]
        return F.array_compact(F.array(*found)).cast(_FINDINGS_TYPE)

    @property
    def annotated(self) -> DataFrame:
        """Every row with its findings."""
        return self.source.withColumn(FINDINGS, self.findings)

    @property
    def valid(self) -> DataFrame:
        """Rows that break no rule; null rules reach a columnar scan as pushed filters."""
        return self.source.filter(~self.any_broken)

    @property
    def rejected(self) -> DataFrame:
        """Rows that break a rule, with their findings."""
        return self.source.filter(self.any_broken).withColumn(FINDINGS, self.findings)


@dataclass(frozen=True)
class Judged(Validation):
    """A validation whose ``source`` holds the findings of each row, so that no rule is tried again."""

    @property
    def any_broken(self) -> Column:
        return F.size(FINDINGS) > 0

    @property
    def findings(self) -> Column:
        return F.col(FINDINGS)

    @property
    def valid(self) -> DataFrame:
        return self.source.filter(~self.any_broken).drop(FINDINGS)


def judged(validation: Validation, label: str = "judged") -> Judged:
    """The rows and their findings, written once; for rows that several steps read."""
    return Judged(settle(validation.annotated, label), validation.rules, validation.skipped, validation.attribution)


def validate(df: DataFrame, rules: Sequence[Rule], attribution: str = "all") -> Validation:
    if attribution not in ("all", "first"):
        raise ValueError("attribution must be 'all' or 'first'")
    present = set(df.columns)
    applied = tuple(rule for rule in rules if present.issuperset(rule.columns))
    skipped = tuple(rule for rule in rules if not present.issuperset(rule.columns))
    return Validation(df, applied, skipped, attribution)
