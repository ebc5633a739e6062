"""Extracted tables and nested payloads as table functions for SQL: ``FROM pages, LATERAL company_items(body)``."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, PartitioningColumn, OrderingColumn, udtf

from siftlane.sources.files import COMPANY_KEYS, COMPANY_LISTS, HEADER_FIELDS


def entries_of(value, depth: int = 3) -> Iterator[dict]:
    """The objects of the company lists in a payload: under the first known key that holds some, else of all lists up to ``depth`` levels
    down whose first entry is an object with a key that companies have."""
    if isinstance(value, dict):
        direct = next((value[k] for k in COMPANY_LISTS if isinstance(value.get(k), list) and value[k]), None)
        if direct is not None:
            yield from (x for x in direct if isinstance(x, dict))
            return
    level = [value]
    for _ in range(depth + 1):
        below = []
        for v in level:
            if isinstance(v, list):
                if v and isinstance(v[0], dict) and any(k in v[0] for k in COMPANY_KEYS):
                    yield from (x for x in v if isinstance(x, dict))
            elif isinstance(v, dict):
                below += v.values()
        level = below


@udtf
class CompanyItems:
    """company_items(body [, 'field=key|key', ...]): a row for each company in a JSON payload. The columns are those of the fields that the call names,
    each the first of its keys with a value; without any they are company, country, email and website."""

    DEFAULT = {"company": ("company", "name", "organization"), "country": ("country",), "email": ("email", "mail"), "website": ("website", "url")}

    @staticmethod
    def analyze(body: AnalyzeArgument, *mappings: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(body.dataType, (T.StringType, T.NullType)):
            raise ValueError("company_items: the payload must be text")
        if any(not isinstance(m.dataType, T.StringType) or not m.isConstantExpression for m in mappings):
            raise ValueError("company_items: fields must be constants like 'company=name|title'")
        names = [m.value.partition("=")[0].strip() for m in mappings] or ["company", "country", "email", "website"]
        return AnalyzeResult(T.StructType([T.StructField(n, T.StringType()) for n in names]))

    def eval(self, body: str | None, *mappings: str):
        named = {m.partition("=")[0].strip(): m.partition("=")[2].split("|") for m in mappings} or self.DEFAULT
        try:
            value = json.loads(body) if body else None
        except ValueError:
            return
        for item in entries_of(value):
            found = [next((str(item[k]).strip() for k in keys if item.get(k) not in (None, "")), None) for keys in named.values()]
            yield tuple(found)


@udtf
class TableRecords:
    """table_records(TABLE(cells) PARTITION BY page): the records of tables that come as rows of cells. The input has the columns it is partitioned by first,
    then ``row`` and ``cells`` (array of text); the output has the partition's columns, row, and a column for each field of HEADER_FIELDS.

    The header is the first row of a table with a cell that names a company; rows before it are none, and rows without a company are left out."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable:
            raise ValueError("table_records: give a table")
        names = [f.name for f in table.dataType.fields]
        if names[-2:] != ["row", "cells"] or len(names) < 3:
            raise ValueError("table_records: the last two columns must be row and cells")
        keys = table.dataType.fields[:-2]
        out = T.StructType([*keys, table.dataType.fields[-2], *(T.StructField(n, T.StringType()) for n in HEADER_FIELDS)])
        return AnalyzeResult(out, partitionBy=[PartitioningColumn(f.name) for f in keys], orderBy=[OrderingColumn("row")])

    def __init__(self):
        self.columns = None

    def eval(self, record: Row):
        *keys, row, cells = record
        texts = [(c or "").strip() for c in cells or []]
        if self.columns is None:
            named = [next((f for f, words in HEADER_FIELDS.items() if any(w in t.lower() for w in words)), None) for t in texts]
            if "company" in named:
                self.columns = named
            return
        own: dict[str, str] = {}
        for field, text in zip(self.columns, texts):
            if field and text:
                own.setdefault(field, text)
        if "company" in own:
            yield (*keys, row, *(own.get(f) for f in HEADER_FIELDS))


def register(spark: SparkSession) -> None:
    """Make the functions known to a session's SQL."""
    spark.udtf.register("company_items", CompanyItems)
    spark.udtf.register("table_records", TableRecords)
