"""One way to open a file of a release inside a task: by scheme, or through a given file system.

Spark reads the data itself; footers and checksums are read here, in Arrow's file systems,
as a stream. ``file``, ``s3`` (also ``s3a``, ``s3n``), ``gs`` (also ``gcs``), ``hdfs``, ``viewfs`` and
``abfs`` (also ``abfss``) have one. For any other scheme (``ftp``, ``http``, ...) a
``pyarrow.fs.FileSystem`` is given explicitly (``Source(filesystem=...)``), for example
``PyFileSystem(FSSpecHandler(...))``; it receives paths without their scheme and must be
picklable, since tasks open files with it.
"""

from __future__ import annotations

import re
from urllib.parse import quote

# Hadoop's spellings of schemes and Arrow's.
ARROW_SCHEMES = {
    "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
    "abfs": "abfs", "abfss": "abfss",
}

_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/?.*)", re.DOTALL)


class NoReader(ValueError):
    """No file system is known that opens files of this scheme inside tasks."""


def split_uri(uri: str) -> tuple[str, str, str]:
    """(scheme, authority, path); a plain path has the scheme ``file``."""
    m = _URI.fullmatch(uri)
    if not m or (len(m[1]) == 1 and m[2] is None):
        return "file", "", uri
    return m[1].lower(), m[2] or "", m[3]


def require_reader(uri: str, filesystem=None) -> None:
    """Raise :class:`NoReader` if files at ``uri`` cannot be opened inside tasks."""
    scheme = split_uri(uri)[0]
    if filesystem is None and scheme not in ARROW_SCHEMES:
        raise NoReader(
            f"files of scheme {scheme!r} cannot be opened for footers and checksums; pass "
            f"Source(filesystem=...), or load with verify=False and schema_mode='first'")


def locate(uri: str, filesystem=None):
    """(file system, path) of a file."""
    from pyarrow import fs

    require_reader(uri, filesystem)
    scheme, authority, path = split_uri(uri)
    if filesystem is not None:
        return filesystem, f"{authority}{path}" if authority else path
    if scheme == "file":
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(f"{ARROW_SCHEMES[scheme]}://{authority}{quote(path)}")


def open_stream(uri: str, filesystem=None):
    """A file's bytes as an input stream."""
    found, path = locate(uri, filesystem)
    return found.open_input_stream(path)


def parquet_schema(uri: str, filesystem=None):
    """The Arrow schema in a Parquet file's footer."""
    import pyarrow.parquet as pq

    found, path = locate(uri, filesystem)
    return pq.read_schema(path, filesystem=found)
