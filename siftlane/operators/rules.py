"""Ordered rules: the first that fits gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[Column, str | Column]


def first_reason(rules: list[Rule]) -> Column:
    """The reason of the first rule whose condition holds, else null. A condition that is null doesn't hold."""
    return F.coalesce(*[F.when(c, F.lit(r) if isinstance(r, str) else r) for c, r in rules])


def reasons(rules: list[Rule]) -> Column:
    """The reasons of all rules whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(r) if isinstance(r, str) else r) for c, r in rules]))


def split(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by whether a reason is there; both are filters over the same lazy plan."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def category(reason: str | Column) -> Column:
    """What a reason says before its colon."""
    return F.substring_index(F.col(reason) if isinstance(reason, str) else reason, ":", 1)


def banded(x: Column, bands: list[tuple[float, object]], other: object) -> Column:
    """The value of the first band whose lower edge x reaches."""
    out = None
    for edge, value in bands:
        out = F.when(x >= edge, value) if out is None else out.when(x >= edge, value)
    return out.otherwise(other)
