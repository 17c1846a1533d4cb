"""Files in the shared folder, through Arrow's file systems, so that any store works."""

from __future__ import annotations

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a path or URI (file:, hdfs:, s3:, gs:)."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
