"""File systems for tasks that read or write plain files: Spark's readers take any Hadoop address, Python workers need one that Arrow opens."""

from __future__ import annotations

import re

from pyarrow import fs

#: Schemes of Hadoop connectors, and Arrow's name for the same store.
SAME = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}
OPENED = ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of an address and the place in it. An address that Arrow can't open is an error, before any work."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    kind = scheme[1].lower() if scheme else "file"
    if kind == "dbfs":  # mounted as a folder on every node
        return fs.LocalFileSystem(), "/dbfs/" + path.split(":", 1)[1].lstrip("/")
    kind = SAME.get(kind, kind)
    if kind not in OPENED:
        raise ValueError(f"plain files can't be kept under {path}: name a folder under one of {', '.join(OPENED)}")
    return fs.FileSystem.from_uri(re.sub(r"^[^:]+:", f"{kind}:", path) if scheme else f"file://{path}")
