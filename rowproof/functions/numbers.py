"""Tolerant casts, totals and value repair."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.columns import named

MONEY = "decimal(15,2)"


def to_int(text: Column, kind: str = "int") -> Column:
    """Integer from text; a fraction is cut off and anything else unreadable is null."""
    digits = F.regexp_extract(F.trim(text.cast("string")), r"^([+-]?\d+)(\.\d*)?$", 1)
    return F.nullif(digits, F.lit("")).try_cast(kind)


def money_total(columns: Iterable[str]) -> Column:
    """Sum of money columns in exact decimals; null when any part is null."""
    parts = [named(name).cast(MONEY) for name in columns]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast(MONEY)


def replace_above(value: Column, cap: int, replacement: Column) -> Column:
    """``replacement`` where ``value`` exceeds ``cap``; null stays null."""
    return F.when(value > cap, replacement).otherwise(value)


def fill_for_kinds(
    target: Column, source: Column, kind: Column, kinds: Sequence[str]
) -> Column:
    """``source`` where ``target`` is null and ``kind`` is one of ``kinds``."""
    return F.when(kind.isin(*kinds) & target.isNull(), source).otherwise(target)
