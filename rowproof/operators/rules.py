"""Row rules. Each is a boolean expression, so any number of them run in one projection."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.columns import named
from rowproof.functions.dates import KNOWN_FORMATS, parse_date_any
from rowproof.functions.numbers import to_int
from rowproof.reference_data import (
    BAD_DATE,
    BAD_ENUM,
    BAD_NUMBER,
    MISSING_REFERENCE,
    MISSING_REQUIRED,
    NULL_VALUE,
    OUT_OF_RANGE,
    WRONG_TYPE,
)


@dataclass(frozen=True, eq=False)
class Rule:
    """A row is rejected where ``violated`` is true; null counts as not violated."""

    columns: tuple[str, ...]
    reported_as: str
    message: str
    violated: Column

    @property
    def broken(self) -> Column:
        return F.coalesce(self.violated, F.lit(False))


def _null_rules(columns: Sequence[str], message: str) -> list[Rule]:
    return [Rule((name,), name, message, named(name).isNull()) for name in columns]


def not_null(columns: Sequence[str]) -> list[Rule]:
    """No column may be null."""
    return _null_rules(columns, NULL_VALUE)


def required(columns: Sequence[str]) -> list[Rule]:
    """Mandatory columns, tested in the given order."""
    return _null_rules(columns, MISSING_REQUIRED)


def not_in_future(
    columns: Sequence[str],
    as_of: datetime.date | None = None,
    formats: Sequence[str] = KNOWN_FORMATS,
    unparseable: str = "keep",
) -> list[Rule]:
    """None of the date texts may lie after ``as_of`` (today when not given).

    A null or unreadable date is not a future date. ``unparseable="reject"`` adds a
    second rule for text that is there but fits none of the formats. These are the formats
    that staging reads, so what loads as a date is judged as that date.
    """
    if unparseable not in ("keep", "reject"):
        raise ValueError("unparseable must be 'keep' or 'reject'")
    limit = F.current_date() if as_of is None else F.lit(as_of)
    label = " / ".join(columns)
    later = [F.coalesce(parse_date_any(named(c), formats) > limit, F.lit(False)) for c in columns]
    rules = [Rule(tuple(columns), label, OUT_OF_RANGE, _any(later))]
    if unparseable == "reject":
        unread = [named(c).isNotNull() & parse_date_any(named(c), formats).isNull() for c in columns]
        rules.append(Rule(tuple(columns), label, BAD_DATE, _any(unread)))
    return rules


def readable(column: str, kind: str = "int") -> Rule:
    """Text that is there must be a number of the kind; the record keeps the text as it is.

    Integers are reported as the wrong type, decimals as a wrong number format.
    """
    whole = kind in ("int", "bigint")
    value = to_int(named(column), kind) if whole else F.trim(named(column)).try_cast(kind)
    message = WRONG_TYPE if whole else BAD_NUMBER
    return Rule((column,), column, message, named(column).isNotNull() & value.isNull())


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    """Text must be one of ``allowed``, in any case; null passes."""
    text = F.lower(F.trim(named(column)))
    wrong = ~text.isin(*[value.lower() for value in allowed])
    return Rule((column,), column, BAD_ENUM, wrong)


def has_reference(id_column: str, reported_as: str | None = None) -> Rule:
    """A looked-up id must have been found."""
    label = reported_as or id_column
    return Rule((id_column,), label, MISSING_REFERENCE, named(id_column).isNull())


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result
