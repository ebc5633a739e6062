"""A paged service's kept answers as a Python data source, for batches and streams.

Answers lie as a partitioned table of text files, ``<path>/<key>=K/offset=N/*``, as ``keep_answers`` writes them: one file or more for
each answer. Names alone are listed when a read is planned; a partition is a key and a run of its offsets, read by a
task. A filter on the key leaves out other keys' folders before anything is opened. As a stream the offset is
the page: a batch has the pages that have come since the last one, of all keys.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from siftlane.sources.stores import store_of


@dataclass
class Pages(InputPartition):
    """A key and some of its offsets, ascending."""

    key: str
    offsets: tuple[int, ...]


class Kept:
    """The folder of a service's answers, by the options path, key (the key's name), keys (those to read, none for all) and pages (a task's)."""

    def __init__(self, options: dict):
        self.path, self.name = options["path"].rstrip("/"), options.get("key", "key")
        self.keys = set(options["keys"].split("\n")) if options.get("keys") else None
        self.a_task = int(options.get("pages", 64))

    def folders(self, store: fs.FileSystem, at: str, name: str) -> list[str]:
        found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return sorted(posixpath.basename(f.path)[len(name) + 1 :] for f in found if f.type == fs.FileType.Directory and posixpath.basename(f.path).startswith(f"{name}="))

    def places(self, first: int | None = None, end: int | None = None) -> list[Pages]:
        """The partitions of offsets from first up to end, end left out."""
        store, root = store_of(self.path)
        out = []
        for key in self.folders(store, root, self.name):
            if self.keys is None or unquote(key) in self.keys:
                own = sorted(int(x) for x in self.folders(store, f"{root}/{self.name}={key}", "offset"))
                own = [x for x in own if (first is None or x >= first) and (end is None or x < end)]
                out += [Pages(key, tuple(own[i : i + self.a_task])) for i in range(0, len(own), self.a_task)]
        return out

    def answers(self, part: Pages) -> Iterator[tuple[str, int, str]]:
        store, root = store_of(self.path)
        for offset in part.offsets:
            files = store.get_file_info(fs.FileSelector(f"{root}/{self.name}={part.key}/offset={offset}"))
            names = sorted(f.path for f in files if f.type == fs.FileType.File and not posixpath.basename(f.path).startswith(("_", ".")))
            text = []
            for name in names:
                with store.open_input_stream(name) as source:
                    text.append(source.read().decode("utf-8", "replace"))
            yield unquote(part.key), offset, "".join(text).rstrip("\n")


class AnswerReader(DataSourceReader):
    def __init__(self, options: dict):
        self.kept = Kept(options)

    def partitions(self) -> list[Pages]:
        return self.kept.places() or [Pages("", ())]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.kept.answers(partition)


class PushedReader(AnswerReader):
    """One that takes filters on the key to itself."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            own = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if own is None or f.attribute != (self.kept.name,):
                yield f
            else:
                self.kept.keys = own if self.kept.keys is None else self.kept.keys & own


class AnswerStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.kept = Kept(options)

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": max((p.offsets[-1] + 1 for p in self.kept.places()), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.kept.places(start["page"], end["page"])

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.kept.answers(partition)


class PagedAnswers(DataSource):
    """Format ``paged_answers``: (key, offset, body)."""

    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return f"`{self.options.get('key', 'key')}` string, offset long, body string"

    def reader(self, schema) -> DataSourceReader:
        return (PushedReader if self.options.get("push") == "true" else AnswerReader)(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return AnswerStream(dict(self.options))


def keep_answers(answers: DataFrame, path: str, *, key: str = "key", mode: str = "append") -> None:
    """Answers (key, offset, body) put where the data source finds them, a file each, by the tasks that have them."""
    answers.select(F.col(key).cast("string").alias(key), F.col("offset").cast("long").alias("offset"), F.col("body").alias("value")).write.partitionBy(key, "offset").mode(mode).text(path)


def kept_options(spark: SparkSession, path: str, key: str, keys, pages: int) -> dict:
    spark.dataSource.register(PagedAnswers)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return {"path": path, "key": key, "pages": str(pages), "push": str(push).lower()} | ({"keys": "\n".join(map(str, keys))} if keys else {})


def read_answers(spark: SparkSession, path: str, *, key: str = "key", keys=(), pages: int = 64) -> DataFrame:
    """Kept answers (key, offset, body), those of some keys if any are given. Filters on the key are taken in where the session allows
    that of Python sources (spark.sql.python.filterPushdown.enabled)."""
    return spark.read.format("paged_answers").options(**kept_options(spark, path, key, keys, pages)).load()


def stream_answers(spark: SparkSession, path: str, *, key: str = "key", keys=(), pages: int = 64) -> DataFrame:
    """Kept answers as a stream: pages beyond those read before. An answer that comes later than one of a greater offset isn't read."""
    return spark.readStream.format("paged_answers").options(**kept_options(spark, path, key, keys, pages)).load()
