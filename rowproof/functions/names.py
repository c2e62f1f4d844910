"""Column-name normalisation."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame


def trim_lower(name: str) -> str:
    return name.strip().lower()


def snake(name: str) -> str:
    """Trimmed, lower case, blanks as underscores."""
    return name.strip().lower().replace(" ", "_")


def graph_safe(name: str) -> str:
    """Name for graph import: leading digits go to the end, only word characters stay."""
    name = name.strip()
    led_by_digits = re.fullmatch(r"(\d+)(.*)", name, flags=re.DOTALL)
    if led_by_digits:
        digits, rest = led_by_digits.groups()
        name = f"{rest.strip()}_{digits}"
    return re.sub(r"\W", "", name.replace(" ", "_").lower())


def normalize_names(df: DataFrame, rule: Callable[[str], str] = snake) -> DataFrame:
    """Rename every column by ``rule``; two columns may not end up with one name."""
    names = [rule(name) for name in df.columns]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Fixed renaming; columns not in the mapping keep their name."""
    return df.withColumnsRenamed(dict(mapping))
