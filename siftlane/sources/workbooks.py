"""Member lists in .xlsx workbooks and delimited files, row by row: a file is never whole in a task.

A sheet is read by pull parsing of its part of the archive: each row's elements are dropped once the row is out, and rows go on in
batches. Shared strings are kept as one run of UTF-8 bytes with the offsets of its strings, decoded when a cell asks for one.
Files are opened where they lie, by range; only where tasks can't open an address does Spark hand them over as contents.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from array import array
from collections.abc import Iterable, Iterator
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from siftlane.sources.stores import store_of

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: Rows given on together; rows in which a header may stand.
BATCH_ROWS, HEADER_ROWS = 4096, 1000


class SharedStrings:
    """A workbook's shared strings: their bytes one after the other, and where each ends."""

    def __init__(self, source: IO[bytes] | None):
        self.text, self.ends = bytearray(), array("q", [0])
        for _, e in ElementTree.iterparse(source) if source else ():
            if e.tag == f"{MAIN}si":
                for part in e:  # phonetic readings are no text
                    if part.tag == f"{MAIN}t":
                        self.text += (part.text or "").encode()
                    elif part.tag == f"{MAIN}r":
                        self.text += "".join(t.text or "" for t in part.iter(f"{MAIN}t")).encode()
                self.ends.append(len(self.text))
                e.clear()

    def __getitem__(self, i: int) -> str:
        return self.text[self.ends[i] : self.ends[i + 1]].decode()


def column_of(place: str) -> int:
    """The number of a cell's column by its place, as B7; 0 where it has none."""
    at = 0
    for letter in re.match("[A-Z]*", place)[0]:
        at = at * 26 + ord(letter) - 64
    return at


def sheet_rows(source: IO[bytes]) -> Iterator[list[str]]:
    """The rows of a workbook's first sheet as text, one after the other; cells that aren't there are empty."""
    with zipfile.ZipFile(source) as z:
        names = set(z.namelist())
        sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        if not sheets:
            return
        shared = SharedStrings(z.open("xl/sharedStrings.xml") if "xl/sharedStrings.xml" in names else None)
        with z.open(sheets[0]) as sheet:
            row: list[str] = []
            rows = None
            for event, e in ElementTree.iterparse(sheet, events=("start", "end")):
                if event == "start":
                    if e.tag == f"{MAIN}sheetData":
                        rows = e
                elif e.tag == f"{MAIN}c":
                    value = e.find(f"{MAIN}v")
                    text = (value.text or "") if value is not None else "".join(t.text or "" for t in e.iter(f"{MAIN}t"))
                    at = column_of(e.get("r", "")) or len(row) + 1
                    row += [""] * (at - len(row))
                    row[at - 1] = shared[int(text)] if e.get("t") == "s" and text else text
                    e.clear()
                elif e.tag == f"{MAIN}row":
                    yield row
                    row = []
                    e.clear()
                    rows.clear()  # else the rows read stay as its children


def text_rows(source: IO[bytes]) -> Iterator[list[str]]:
    return csv.reader(io.TextIOWrapper(source, "utf-8-sig", "replace", newline=""))


#: Words of a header cell, in the order in which they are looked for, and the field that they name.
FIELDS = {
    "company": ("member name", "company", "organisation", "organization", "member", "name"),
    "country": ("country",),
    "category": ("category", "membership"),
    "member_since": ("member since", "since", "join"),
    "website": ("website", "web", "url", "homepage"),
}


def field_columns(header: list[str]) -> dict[str, int]:
    """The column of each field: of its words the first that a header cell contains, in the first such cell."""
    cells = [c.strip().lower() for c in header]
    out = {}
    for field, words in FIELDS.items():
        at = next((i for w in words for i, c in enumerate(cells) if w in c), None)
        if at is not None:
            out[field] = at
    return out


def members(rows: Iterator[list[str]], head_rows: int = HEADER_ROWS) -> Iterator[dict[str, str]]:
    """The records behind the first row with a cell for the name and one for the country; a row without a name is none."""
    where = None
    for k, row in enumerate(rows):
        if where is None:
            found = field_columns(row)
            if "company" in found and "country" in found and found["company"] != found["country"]:
                where = found
            elif k > head_rows:
                return
            continue
        own = {f: row[i].strip() if i < len(row) else "" for f, i in where.items()}
        if own["company"] and own["company"].lower() != "nan":
            yield own


MEMBERS = "file string, company string, country string, category string, member_since string, website string"


def members_of(files: DataFrame, *, countries: Iterable[str] = (), categories: Iterable[str] = ()) -> DataFrame:
    """The member records of files (path, and content where tasks can't open the path): .xlsx workbooks, or delimited text. Records of other countries or categories
    than those given (any case) are left out as they are read. A null path's or content's file has none."""
    wanted = {"country": {c.strip().lower() for c in countries}, "category": {c.strip().lower() for c in categories}}
    held = "content" in files.columns
    names = [x.split(" ")[0] for x in MEMBERS.split(", ")]

    def records(file: str, source: IO[bytes]) -> Iterator[pd.DataFrame]:
        book = source.read(2) == b"PK"
        source.seek(0)
        out = []
        for own in members(sheet_rows(source) if book else text_rows(source)):
            if all(not w or own.get(f, "").lower() in w for f, w in wanted.items()):
                out.append((file, *(own.get(n, "") for n in names[1:])))
            if len(out) == BATCH_ROWS:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.path is None or held and row.content is None:
                    continue
                if held:
                    yield from records(row.path, io.BytesIO(row.content))
                else:
                    store, place = store_of(row.path)
                    with store.open_input_file(place) as source:
                        yield from records(row.path, source)

    return files.select("path", *(["content"] if held else [])).mapInPandas(read, MEMBERS)


def member_list(spark: SparkSession, path: str, **filters) -> DataFrame:
    """The member records of the files that a path finds. They are listed without being read, and opened by the tasks, or given to them
    as contents where Spark alone can open them."""
    listed = spark.read.format("binaryFile").load(path)
    try:
        store_of(path)
    except ValueError:
        return members_of(listed.select("path", "content"), **filters)
    return members_of(listed.select("path").repartition("path"), **filters)


def registered_list(spark: SparkSession, entry: dict) -> DataFrame:
    """The member list of a registry's entry (directory_url; countries and categories that count, if it names any)."""
    return member_list(spark, entry["directory_url"], countries=entry.get("countries") or (), categories=entry.get("categories") or ())


def write_workbooks(rows: DataFrame, path: str, *, file: str = "file", order: str = "row", cells: str = "cells") -> DataFrame:
    """A workbook for each file name of rows (file, row, cells: array of text) under path, written by the tasks as the rows come in their
    order; returns (path, rows). Cells that repeat the cell above are shared strings."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = store_of(path)
        store.create_dir(root, recursive=True)
        now, book = None, None
        for frame in frames:
            for name, texts in zip(frame[file], frame[cells]):
                if name != now:
                    if book:
                        yield book.done()
                    now, book = name, Book(store, f"{root}/{name}")
                book.put(texts)
        if book:
            yield book.done()

    dealt = rows.select(file, order, cells).repartition(file).sortWithinPartitions(file, order).select(file, cells)
    return dealt.mapInPandas(write, "path string, rows long")


class Book:
    """A workbook that is being written: the sheet first, its shared strings last."""

    def __init__(self, store, place: str):
        self.place, self.out = place, store.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        self.sheet = self.zip.open("xl/worksheets/sheet1.xml", "w")
        self.sheet.write(f'<worksheet xmlns="{MAIN[1:-1]}"><sheetData>'.encode())
        self.rows, self.shared, self.above = 0, {}, []

    def put(self, texts) -> None:
        self.rows += 1
        out = []
        for j, text in enumerate(texts):
            if text is None:
                continue
            name = (chr(64 + j // 26) if j >= 26 else "") + chr(65 + j % 26)
            if j < len(self.above) and text == self.above[j]:
                out.append(f'<c r="{name}{self.rows}" t="s"><v>{self.shared.setdefault(text, len(self.shared))}</v></c>')
            else:
                out.append(f'<c r="{name}{self.rows}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
        self.above = list(texts)
        self.sheet.write(f'<row r="{self.rows}">{"".join(out)}</row>'.encode())

    def done(self) -> pd.DataFrame:
        self.sheet.write(b"</sheetData></worksheet>")
        self.sheet.close()
        with self.zip.open("xl/sharedStrings.xml", "w") as strings:
            strings.write(f'<sst xmlns="{MAIN[1:-1]}">'.encode())
            for text in self.shared:
                strings.write(f'<si><t xml:space="preserve">{escape(text)}</t></si>'.encode())
            strings.write(b"</sst>")
        self.zip.close()
        self.out.close()
        return pd.DataFrame({"path": [self.place], "rows": [self.rows]})
