"""Upserts of a stream into a table of hash buckets: a batch rewrites the buckets of its keys only.

Layout: ``data/v<batch>/bucket=<k>/`` holds buckets as a batch has left them, ``manifests/<batch>/`` a line for each bucket (its number and
version; -1 and how many buckets there are). A batch reads the last manifest, rewrites its buckets in a folder of its own, and then writes the manifest, which Spark's committer puts in place by one
rename: until then the table is what it was. A batch that runs again finds its manifest and does nothing, or, if it had not come so far, writes the
same folder again. Readers see the versions that one manifest names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.sources.stores import store_of


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The last batch that was put in, and each bucket's version; -1 and nothing for a new table. A line for each bucket."""
    try:
        # names of whole manifests: Spark marks a folder once all of it is in place
        done = [r.path for r in spark.read.format("binaryFile").load(f"{path}/manifests/*/part-*").select("path").collect()]
    except AnalysisException:
        return -1, {}
    last = max((int(p.split("/")[-2]) for p in done), default=-1)
    if last < 0:
        return -1, {}
    lines = spark.read.text([p for p in done if int(p.split("/")[-2]) == last]).collect()
    return last, {int(b): int(v) for b, v in (r.value.split("\t") for r in lines)}


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
    """The table's rows, of some buckets if they are given."""
    _, now = manifest(spark, path)
    places = [f"{path}/data/v{v}/bucket={b}" for b, v in sorted(now.items()) if b >= 0 and (only is None or b in only)]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def put_batch(batch: DataFrame, number: int, path: str, key: str, order: str, buckets: int) -> None:
    """A batch's rows put in by key, of each the one of the greatest ``order``, old ones included."""
    spark = batch.sparkSession
    last, now = manifest(spark, path)
    if last >= number:
        return
    # the number of buckets is the table's, not the caller's, once there is one
    buckets = now.get(-1, buckets)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    newest = lambda rows: rows.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("s")).select("s.*")
    own = newest(batch)
    touched = {r[0] for r in own.select(bucket.alias("b")).distinct().collect()}  # no more than there are buckets
    if touched:
        old = read_buckets(spark, path, batch.schema, touched)
        merged = newest(own.unionByName(old)).withColumn("bucket", bucket)
        merged.repartition(min(len(touched), buckets), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v{number}")
    now = {b: v for b, v in now.items() if b >= 0} | {b: number for b in touched} | {-1: buckets}
    lines = spark.createDataFrame([(f"{b}\t{v}",) for b, v in sorted(now.items())], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{path}/manifests/{number}")


def upsert_buckets(stream: DataFrame, path: str, key: str, checkpoint: str, *, order: str = "ts", buckets: int = 64):
    """The query that puts a stream's batches into a bucketed table; see above. The number of buckets is fixed by the first batch."""
    put = lambda batch, number: put_batch(batch, number, path, key, order, buckets)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def vacuum(spark: SparkSession, path: str) -> int:
    """Versions of buckets and manifests that the last manifest doesn't name are removed; how many. For folders that Arrow opens."""
    last, now = manifest(spark, path)
    store, root = store_of(path)
    from pyarrow import fs

    gone = 0
    for f in store.get_file_info(fs.FileSelector(f"{root}/data", recursive=True, allow_not_found=True)):
        version, _, name = f.path.removeprefix(f"{root}/data/v").partition("/bucket=")
        if f.type == fs.FileType.Directory and name.lstrip("-").isdigit() and now.get(int(name)) != int(version):
            store.delete_dir(f.path)
            gone += 1
    for f in store.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True)):
        if f.type == fs.FileType.Directory and f.base_name.isdigit() and int(f.base_name) != last:
            store.delete_dir(f.path)
            gone += 1
    return gone
