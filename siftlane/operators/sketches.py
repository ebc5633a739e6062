"""Mergeable sketches of distinct values, and counts over several groupings at once."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two to this power are the buckets of a sketch.
LOG_BUCKETS = 14


def sketched(df: DataFrame, keys: Sequence[str], column: str, *, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """(keys, sketch, n): an HLL sketch of a column's values for each key, and the rows that it stands for. It can be written, a part of the
    data at a time, and merged later; a sketch has a bounded size whatever it has seen. Nulls aren't counted."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(log_buckets)).alias("sketch"), F.count(column).alias("n"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser keys; none for the whole."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"), F.sum("n").alias("n"))


def estimated(sketches: DataFrame, name: str = "n_distinct") -> DataFrame:
    """The sketches' counts of distinct values in place of the sketches."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def bound(log_buckets: int = LOG_BUCKETS, deviations: float = 3.0) -> float:
    """The relative error that an estimate keeps within, at so many deviations."""
    return deviations * 1.04 / math.sqrt(1 << log_buckets)


def grouped_counts(df: DataFrame, sets: Iterable[Sequence[str]]) -> DataFrame:
    """Counts by several sets of columns in one pass: a column that a row's set doesn't have is null, and level says by its bits which these are."""
    sets = [tuple(s) for s in sets]
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))
