"""Streams of events: windowed counts with late data, repeated leads dropped, and upserts batch by batch."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlane.sources.stores import store_of


def event_stream(spark: SparkSession, path: str, schema, files_a_batch: int = 1) -> DataFrame:
    """Events of a folder's files; a time without a zone is taken as the session's."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values by type in tumbling windows; what comes later than ``late`` is left out of a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a user's events with no longer gap between."""
    own = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return own.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_of_repeats(leads: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """A stream without what comes again within the watermark."""
    return leads.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def upsert_batches(stream: DataFrame, path: str, key: str, checkpoint: str, order: str = "ts", keep: int = 2):
    """Each batch's rows put into a Parquet table by key, the one of the greatest ``order`` of each, old ones included.

    A batch writes a version of its own, from the version before, and a batch that is run again writes the same one, so
    nothing is applied twice. ``newest`` names the last whole version; the last ``keep`` versions stay. Every batch writes the whole table, which suits
    small ones; ``buckets`` has one that doesn't."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/v{number - 1}"))
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("s")).select("s.*")
        newest.write.mode("overwrite").parquet(f"{path}/v{number}")
        spark.createDataFrame([(f"v{number}",)], "name string").coalesce(1).write.mode("overwrite").text(f"{path}/newest")
        if number >= keep:
            store, place = store_of(f"{path}/v{number - keep}")
            if store.get_file_info(place).type != fs.FileType.NotFound:
                store.delete_dir(place)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
