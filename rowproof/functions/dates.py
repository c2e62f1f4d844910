"""Date parsing and date parts. Text that does not fit the format gives null."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.reference_data import REGISTRATION_DATE_FORMAT

# Formats tried, in order, when the format of a date column is not known.
KNOWN_FORMATS = ("MMMM d yyyy", "MMMM d, yyyy", "yyyy-MM-dd", "MM/dd/yyyy")


def _outline(fmt: str) -> str | None:
    """Pattern that every text of the format matches; None for formats it cannot cover."""
    parts = []
    for run in re.finditer(r"([A-Za-z'])\1*|[^A-Za-z']", fmt):
        token = run.group()
        if token[0] == "M" and len(token) > 2:
            parts.append(r"\p{L}+")
        elif token[0] in "yMdHms":
            parts.append(r"[+-]?\d+")
        elif token[0].isalpha() or token[0] == "'":
            return None
        else:
            parts.append(re.escape(token))
    return "^" + "".join(parts) + "$"


def _try_date(text: Column, fmt: str) -> Column:
    """A failed parse is costly, so text of the wrong outline is not parsed at all."""
    outline = _outline(fmt)
    if outline is None:
        return F.try_to_date(text, fmt)
    return F.when(text.rlike(outline), F.try_to_date(text, fmt))


def parse_date(text: Column, fmt: str = REGISTRATION_DATE_FORMAT, trim: bool = False) -> Column:
    return _try_date(F.trim(text) if trim else text, fmt)


def parse_date_any(text: Column, formats: Sequence[str] = KNOWN_FORMATS) -> Column:
    """First of ``formats`` that fits."""
    return F.coalesce(*[_try_date(F.trim(text), fmt) for fmt in formats])


def month_of(date: Column) -> Column:
    return F.month(date)


def weekday_number(date: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(date)


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def iso_text(timestamp: Column) -> Column:
    """ISO text; the fraction appears only when there is one, as microseconds."""
    seconds = "yyyy-MM-dd'T'HH:mm:ss"
    whole = F.date_trunc("second", timestamp) == timestamp
    return F.when(whole, F.date_format(timestamp, seconds)).otherwise(
        F.date_format(timestamp, seconds + ".SSSSSS")
    )


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
