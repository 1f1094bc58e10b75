"""Files that tasks open by themselves, as streams."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.fs

#: Schemes that Spark and Arrow name differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path within it.

    `file:`, `s3a://`, `s3://`, `gs://`, `hdfs://` and paths without a scheme are known as far as
    Arrow was built with them; another one is refused. Names are taken as they are, unescaped.
    """
    scheme, authority, inner = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):(?=/))?(?://([^/]*))?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return pa.fs.LocalFileSystem(), inner
    try:
        fs, base = pa.fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{authority or '/'}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as fault:
        raise ValueError(f"{path}: tasks cannot open {scheme}: files by themselves ({fault})") from fault
    return fs, f"{base.rstrip('/')}{inner}" if base else inner
