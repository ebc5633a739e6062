"""Sinks: Parquet and CSV by partition, append-only logs, tables, and upserts by rewrite."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; lists become ``; `` joined text."""
    flat = [F.array_join(c, "; ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_partitioned(df: DataFrame, path: str, *keys: str, rows_a_task: int = 5_000_000) -> None:
    """Parquet in a folder for each value of the keys. Rows go by key and a salt below the tasks that the commonest value needs, so a
    common value is written by as many tasks as it has rows for, and rare ones by few."""
    most = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = -(-most // rows_a_task)
    dealt = [F.col(k) for k in keys] + ([F.pmod(F.xxhash64(*df.columns), F.lit(salts))] if salts > 1 else [])
    df.repartition(*dealt).write.mode("overwrite").partitionBy(*keys).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """A Parquet table whose rows take the place of those that were there."""
    df.write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).saveAsTable(name)


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new in place of those of the same key."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def decided(queue: DataFrame, decisions: DataFrame, key: str, allowed: Iterable[str] = ("approved", "rejected")) -> DataFrame:
    """queue with status: the decision's if it is an allowed one, else pending."""
    own = decisions.where(F.col("status").isin(*allowed)).groupBy(key).agg(F.max_by("status", "decided_at").alias("__status"))
    return queue.join(own, key, "left").withColumn("status", F.coalesce("__status", F.lit("pending"))).drop("__status")


def report(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: rows in all, and for each condition its count and percentage."""
    total = F.count("*")
    out = [total.alias("total")]
    for name, c in conditions.items():
        out += [F.count_if(c).alias(f"n_{name}"), F.round(100 * F.count_if(c) / total, 2).alias(f"pct_{name}")]
    return df.agg(*out)
