"""Key lookups in dimensions and the treatment of keys that are not found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rowproof.functions.columns import named, named_all
from rowproof.operators.rules import has_reference
from rowproof.operators.validate import Validation, validate
from rowproof.session import settle_measured


class MissingReferences(ValueError):
    """Rows refer to keys a dimension does not hold; nothing was written."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = {name: n for name, n in counts.items() if n}
        super().__init__(f"rows without a match, by id column: {self.counts}")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    unique: bool = False,
) -> DataFrame:
    """Left join that adds columns of ``dim``.

    ``on`` maps key columns of ``df`` to those of ``dim``; ``take`` maps columns of
    ``dim`` to their names in the result. A null key finds nothing. ``unique`` keeps one
    match, the smallest, where ``dim`` repeats a key, so that rows never multiply. Keys of
    unlike type are refused: a text compared with a number would fail on the first text that
    is none.

    The planner broadcasts ``dim`` when its size is under the session's threshold and
    otherwise shuffles both sides, splitting the partitions of hot keys.
    """
    for ours, theirs in on.items():
        kinds = [isinstance(side.schema[c].dataType, StringType) for side, c in ((df, ours), (dim, theirs))]
        if kinds[0] != kinds[1]:
            raise TypeError(f"key {ours} and key {theirs} are not of one type")
    keys = [named(key).alias(f"_key{i}") for i, key in enumerate(on.values())]
    taken = [named(source).alias(name) for source, name in take.items()]
    right = dim.select(*keys, *taken)
    names = [f"_key{i}" for i in range(len(keys))]
    if unique:
        best = F.min(F.struct(*[named(name) for name in take.values()])).alias("_best")
        right = right.dropna(subset=names).groupBy(*names).agg(best)
        # Joining on structs gives each side its own shuffle, which hot keys can be split in.
        right = right.select(F.struct(*names).alias("_key"), "_best.*")
        return df.join(right, F.struct(*named_all(on)) == F.col("_key"), "left").drop("_key")
    condition = reduce(
        lambda a, b: a & b, [named(key) == F.col(name) for key, name in zip(on, names)]
    )
    return df.join(right, condition, "left").drop(*names)


def reference_check(df: DataFrame, ids: Sequence[str]) -> Validation:
    """Every id column must have been found; ``rejected`` holds the rows that miss one."""
    return validate(df, [has_reference(name) for name in ids])


def missing_counts(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Number of rows with no match, one column per id."""
    return df.agg(*[F.count_if(named(name).isNull()).alias(name) for name in ids])


def resolve_references(df: DataFrame, ids: Sequence[str], on_missing: str = "fail") -> DataFrame:
    """Rows whose ids were all found.

    ``fail`` raises :class:`MissingReferences` when any is missing, ``drop`` removes such
    rows. To keep them aside, use :func:`reference_check`.
    """
    if on_missing == "drop":
        return df.dropna(subset=list(ids))
    if on_missing != "fail":
        raise ValueError("on_missing must be 'fail' or 'drop'")
    lacking = {name: F.count_if(named(name).isNull()) for name in ids}
    joined, measured = settle_measured(df, "references", **lacking)
    counts = {name: measured[name] for name in ids}
    if any(counts.values()):
        raise MissingReferences(counts)
    return joined
