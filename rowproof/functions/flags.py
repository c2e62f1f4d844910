"""Yes/No text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardize_flag(flag: Column, unknown: str = "keep", trim: bool = False) -> Column:
    """Bring a flag to ``yes`` or ``no``.

    Null, "no" and "not applicable" become ``no``. Any other text is kept in lower case
    (``unknown="keep"``) or also becomes ``no`` (``unknown="no"``).
    """
    if unknown not in ("keep", "no"):
        raise ValueError("unknown must be 'keep' or 'no'")
    text = F.lower(F.trim(flag) if trim else flag)
    if unknown == "no":
        return F.when(text == "yes", "yes").otherwise("no")
    return F.when(text.isNull() | text.isin("no", "not applicable"), "no").otherwise(text)


def yes_no_to_boolean(flag: Column) -> Column:
    """``Yes`` and ``No`` in any case as boolean; other text is null."""
    text = F.lower(F.trim(flag))
    return F.when(text == "yes", True).when(text == "no", False)
