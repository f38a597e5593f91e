"""Small files on the driver's side, in any store that Spark reads: through Hadoop's file system API.

Without a session the path is a local one.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession


def _fs(path: str):
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None, None, None
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def exists(path: str | Path) -> bool:
    fs, p, _ = _fs(str(path))
    return Path(path).exists() if fs is None else bool(fs.exists(p))


def write_text(path: str | Path, text: str) -> str:
    """Write a file, over what was there; its directories are made."""
    fs, p, _ = _fs(str(path))
    if fs is None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text)
        return str(path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return str(path)


def read_text(path: str | Path) -> str:
    fs, p, jvm = _fs(str(path))
    if fs is None:
        return Path(path).read_text()
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_json(path: str | Path, what, sort_keys: bool = True) -> str:
    return write_text(path, json.dumps(what, indent=2, sort_keys=sort_keys, default=str))


def read_json(path: str | Path):
    return json.loads(read_text(path))


def rename(path: str, to: str) -> None:
    """Move a file or folder to a name, in place of what is there."""
    fs, p, jvm = _fs(path)
    q = jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(q):
        fs.delete(q, True)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"{path} can't be moved to {to}")


def remove(path: str) -> None:
    fs, p, _ = _fs(path)
    fs.delete(p, True)


def glob(pattern: str) -> list[str]:
    """Sorted paths that match a pattern."""
    fs, p, _ = _fs(pattern)
    if fs is None:
        here = Path(pattern)
        return sorted(map(str, here.parent.glob(here.name)))
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))
