"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Layout of a written folder, one triple of files for each range of document ids::

    part-00003-<attempt>.ids   token ids, little-endian uint16 or uint32, documents back to back
    part-00003-<attempt>.off   uint64: where each document of the part ends, from the part's start
    part-00003-<attempt>.doc   int64: the document ids in the same order (null: the least int64)
    index.json                 the parts in order, with the base of each from prefix sums

Documents are dealt by ranges of their id, so the parts laid end to end are in ascending order.
A task writes under its attempt's name and the index names the attempts that ended well, so a
task that ran twice, or an executor lost on the way, leaves at most files that nobody reads.
The bases come from the parts' totals (a row for each part) and only the index holds them: no
file is written again for them. Reading maps the files into memory, so a task touches the
pages of its own documents alone.

The folder is one that tasks can open as plain files: local or mounted, or a store that Arrow knows (``sources.stores``); any other is an error
before any work.

Nulls: a null text is empty and has the end id alone; a null document id is kept and comes first.
Repeated rows are written once for each row. An empty table gives an index without parts.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlane.llm.common import slices, whole_text, words_of
from siftlane.sources.stores import store_of

NO_ID = -(2**63)
PART = "part int, name string, docs long, ids long"
#: Bytes of text whose words are looked up together.
SLICE_BYTES = 16 << 20


@functools.lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """The tokenizer of a JSON file, once for each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_type(path: str, end_id: int) -> str:
    """The little-endian unsigned type that holds every id."""
    return "<u2" if max(load_tokenizer(path).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else "<u4"


def splits_at_spaces(path: str) -> bool:
    """Whether words between white space can be encoded each by itself.

    True of a tokenizer that drops white space before it looks for pieces: then no piece spans
    two words, and the ids of a text are those of its words laid end to end.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    first = steps[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and r"[^\s" in first.get("pattern", {}).get("Regex", "")
    return bool(drops) and not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens", []))


#: Marks that form a piece of their own behind letters; the apostrophe may not, as in 's.
TAIL_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


@functools.lru_cache(maxsize=2)
def ends_word(path: str) -> tuple[bytes, str]:
    """Whether each id ends a word (a byte for each id), and the mark of a word's end in the vocabulary."""
    with open(path, encoding="utf-8") as f:
        mark = (json.load(f).get("model") or {}).get("end_of_word_suffix") or ""
    tokenizer = load_tokenizer(path)
    flags = bytearray(tokenizer.get_vocab_size(with_added_tokens=True))
    for piece, i in tokenizer.get_vocab().items():
        flags[i] = bool(mark) and piece.endswith(mark)
    return bytes(flags), mark


def laid(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Runs laid end to end by their numbers; flat has the runs of some sizes back to back."""
    starts, each = np.cumsum(sizes) - sizes, sizes[index]
    ends = np.cumsum(each)
    return flat[np.repeat(starts[index] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)]


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Some (ids, sizes) back to back."""
    return np.concatenate([np.zeros(0, dtype=np.uint32), *(x for x, _ in parts)]), np.concatenate([np.zeros(0, dtype=np.int64), *(n for _, n in parts)])


def encode_plain(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words back to back, and how many each has."""
    own = [x.ids for x in load_tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]
    sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
    return np.fromiter(itertools.chain.from_iterable(own), dtype=np.uint32, count=int(sizes.sum())), sizes


def encode_letters(words: list[str], path: str, a_line: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The same of words that are letters only. Many are encoded as one line, which is then cut behind each
    id that ends a word; a line that doesn't come apart in as many words is encoded word by word."""
    flags, mark = ends_word(path)
    if not mark or not words:
        return encode_plain(words, path)
    lines = [words[i : i + a_line] for i in range(0, len(words), a_line)]
    ids, sizes = encode_plain([" ".join(x) for x in lines], path)
    cuts = np.flatnonzero(np.frombuffer(flags, dtype=bool)[ids]) + 1
    ends = np.cumsum(sizes)
    found = np.searchsorted(cuts, ends, "right")  # cuts up to each line's end
    whole = (np.diff(found, prepend=0) == [len(x) for x in lines]) & np.isin(ends, cuts)
    parts = []
    for i, (some, plain) in enumerate(zip(lines, ~whole)):
        if plain:
            parts.append(encode_plain(some, path))
        else:
            own = cuts[found[i] - len(some) : found[i]]
            parts.append((ids[ends[i] - sizes[i] : ends[i]], np.diff(own, prepend=ends[i] - sizes[i])))
    return joined(parts)


def ids_of_words(words: list[str], path: str, at_once: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words back to back, and how many each has: letters, letters with marks behind them, and others.

    ``at_once`` of them are encoded together, as the tokenizer's record of a word is many times as large as its ids."""
    letters: dict[str, int] = {}
    others: dict[str, int] = {}
    stems, tails = [], []
    for word in words:
        stem = word.rstrip(TAIL_MARKS)
        if stem.isalpha():
            tail = word[len(stem) :]
            stems.append(letters.setdefault(stem, len(letters)))
            tails.append(others.setdefault(tail, len(others)) if tail else -1)
        else:
            stems.append(-1)
            tails.append(others.setdefault(word, len(others)))
    parts = []
    for some, encode in ((list(letters), encode_letters), (list(others), encode_plain)):
        parts += [encode(some[i : i + at_once], path) for i in range(0, len(some), at_once)]
    flat, sizes = joined(parts)
    sizes = np.append(sizes, 0)  # no stem or no tail
    pairs = np.stack([np.array(stems, dtype=np.int64), np.array(tails, dtype=np.int64)], axis=1)
    pairs[:, 1] += len(letters) * (pairs[:, 1] >= 0)
    return laid(flat, sizes, pairs.ravel()), sizes[pairs].sum(axis=1)


def encode_words(words: list[str], path: str) -> list[list[int]]:
    """``ids_of_words`` as lists."""
    flat, sizes = ids_of_words(words, path)
    ends = np.cumsum(sizes)
    return [flat[i:j].tolist() for i, j in zip(ends - sizes, ends)]


def encode_rows(texts: pa.Array, path: str, end_id: int, by_word: bool, part_bytes: int = 2 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows back to back, each row closed by end_id, and the rows' ends. By word, each word of all rows is encoded
    once, and texts are taken apart and laid out again part_bytes at a time."""
    if not by_word:
        flat, sizes = encode_plain(texts.to_pylist(), path)
        row_ends = np.cumsum(sizes)
        return np.insert(flat, row_ends, np.uint32(end_id)), row_ends + np.arange(1, len(sizes) + 1)
    known: dict[str, int] = {}
    parts = []
    for rows in slices(pa.record_batch([texts], names=["text"]), "text", part_bytes):
        words, index, bounds = words_of(rows["text"])
        number = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int32, count=len(words))
        parts.append((number[index], bounds))
    flat, sizes = ids_of_words(list(known), path)
    flat, sizes = np.append(flat, np.uint32(end_id)), np.append(sizes, 1)
    out = []
    for index, bounds in parts:
        index = np.insert(index, bounds[1:], len(known))
        row_ends = bounds[1:] + np.arange(1, len(bounds))
        out.append((laid(flat, sizes, index), np.diff(np.cumsum(sizes[index])[row_ends - 1], prepend=0)))
    ids, each = joined(out)
    return ids, np.cumsum(each)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, partitions: int | None = None
) -> dict:
    """Write the token files of docs under path, a folder that driver and executors share.

    Returns the index. The number of parts is that of the shuffle's partitions unless given.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer_file, end_id)
    by_word = splits_at_spaces(tokenizer_file)
    store, root = store_of(path)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = store_of(path)
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        outs, docs_seen, ids_seen = None, 0, 0
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                outs = outs or [store.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "off", "doc")]
                ids, ends = encode_rows(rows["text"], tokenizer_file, end_id, by_word)
                outs[0].write(ids.astype(kind).tobytes())
                outs[1].write((ends + ids_seen).astype("<u8").tobytes())
                outs[2].write(np.asarray(rows["id"].fill_null(NO_ID), dtype="<i8").tobytes())
                docs_seen, ids_seen = docs_seen + rows.num_rows, ids_seen + int(ends[-1])
        if outs:
            for out in outs:
                out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([context.partitionId()], pa.int32()), "name": [name], "docs": [docs_seen], "ids": [ids_seen]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    dealt = rows.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("id"), F.xxhash64("text"))
    parts = [r.asDict() for r in dealt.sortWithinPartitions("id", "text").mapInArrow(write, PART).collect()]
    parts.sort(key=lambda p: p["part"])
    docs_base = ids_base = 0
    for p in parts:
        p |= {"docs_base": docs_base, "ids_base": ids_base}
        docs_base, ids_base = docs_base + p["docs"], ids_base + p["ids"]
    index = {"dtype": kind, "docs": docs_base, "ids": ids_base, "parts": parts}
    with store.open_output_stream(f"{root}/index.json") as out:
        out.write(json.dumps(index).encode())
    return index


def read_range(store: fs.FileSystem, file: str, kind: str, first: int, last: int) -> np.ndarray:
    """A file's numbers from first to last: mapped into memory where the store allows that, else that range is read."""
    width = np.dtype(kind).itemsize
    if last <= first:
        return np.zeros(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(file, dtype=kind, mode="r", offset=first * width, shape=(last - first,))
    with store.open_input_file(file) as f:
        return np.frombuffer(f.read_at((last - first) * width, first * width), dtype=kind)


def read_token_files(
    spark: SparkSession, path: str, each: Callable[[np.ndarray], dict] | None = None, schema: str = "ids array<int>", docs_a_task: int = 1 << 16
) -> DataFrame:
    """Documents of a written folder: doc_id, start (ids of all documents before it), n_tokens, and
    what ``each`` makes of a document's ids (their list, unless given) under ``schema``.

    Parts of more than docs_a_task documents are read by several tasks.
    """
    store, root = store_of(path)
    with store.open_input_stream(f"{root}/index.json") as f:
        index = json.loads(f.read())
    kind, each = index["dtype"], each or (lambda ids: {"ids": ids.astype(np.int32)})
    jobs = [(p["name"], p["ids_base"], i, min(i + docs_a_task, p["docs"])) for p in index["parts"] for i in range(0, p["docs"], docs_a_task)]
    out = T._parse_datatype_string(f"doc_id long, start long, n_tokens long, {schema}")
    extra = out.fieldNames()[3:]
    if not jobs:
        return spark.createDataFrame([], out)

    def read(frames):
        import pandas as pd

        store, root = store_of(path)
        for frame in frames:
            for name, base, first, last in frame.itertuples(index=False):
                for i in range(first, last, 4096):
                    j = min(i + 4096, last)
                    off = read_range(store, f"{root}/{name}.off", "<u8", max(0, i - 1), j).astype(np.int64)
                    starts, ends = (off[:-1], off[1:]) if i else (np.r_[0, off[:-1]], off)
                    ids = read_range(store, f"{root}/{name}.ids", kind, int(starts[0]), int(ends[-1]))
                    made = [each(ids[a:b]) for a, b in zip(starts - starts[0], ends - starts[0])]
                    own = pd.Series(read_range(store, f"{root}/{name}.doc", "<i8", i, j)).astype("Int64")
                    yield pd.DataFrame({"doc_id": own.mask(own == NO_ID), "start": base + starts, "n_tokens": ends - starts} | {k: [m[k] for m in made] for k in extra})

    jobs_df = spark.createDataFrame(jobs, "name string, base long, first long, last long").repartition(min(len(jobs), 4096))
    return jobs_df.mapInPandas(read, out)
