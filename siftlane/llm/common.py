"""What several of the text-table operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftlane.session import checkpointed, shared_dir

__all__ = ["checkpointed", "memory_returned", "row_sums", "shared_dir", "shared_path", "slices", "vocabulary", "whole_text", "words_of"]


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new place under the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def whole_text(column: str = "text"):
    """The text column as string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about most_bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
    run = (np.cumsum(sizes) - sizes) // most_bytes
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for i, j in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(i), int(j - i))


def memory_returned() -> None:
    """Give the system what Arrow and numpy have freed but hold: Spark keeps workers for later tasks, and what idle ones hold
    comes on top of theirs."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words between ASCII white space, each word's index in text order, and rows' bounds.

    Row r has the words index[bounds[r]:bounds[r + 1]]; empty words are left out.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = lists.flatten()
    lengths = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    full = np.asarray(pc.not_equal(flat, ""), dtype=bool)
    owner = np.repeat(np.arange(len(lengths)), lengths)[full]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    bounds = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(lengths)))].astype(np.int64)
    return coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[r]:bounds[r + 1]], zero for empty runs."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
