"""Safe access to columns whose names hold blanks, dots or brackets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name``."""
    return F.col("`" + name.replace("`", "``") + "`")


def named_all(names: Iterable[str]) -> list[Column]:
    return [named(name) for name in names]
