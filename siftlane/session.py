"""Session helpers shared by the queries, the tests and the benchmark."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str | int = "*", partitions: int = 8, app: str = "siftlane") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SIFTLANE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder.

    Only where none is set and all tasks run in the driver's own process (local tests) a temporary one is made and set.
    Checkpoints in it go when nothing refers to them if the session sets spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="siftlane-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder, without lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row. A plain column's expression is put into each filter that reads it, as often as it is read there, when
    Spark moves the filter down; behind an ``explode`` of one value it isn't."""
    for name, column in columns.items():
        df = df.withColumn(name, F.explode(F.array(column)))
    return df


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new place under the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def spread(df: DataFrame, least: int = 500, most: int = 20_000) -> DataFrame:
    """A small table's rows dealt to as many tasks as run at once. A file of one row group is one task's work otherwise, however
    many tasks could share it; tables of more than ``most`` rows or of as many files as tasks stay as they are, tiny ones too.
    Rows are counted from the files' footers."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if len(df.inputFiles()) < tasks and least <= df.count() <= most else df
