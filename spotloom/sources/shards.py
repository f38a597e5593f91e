"""Tar shards and their binary index, as DataFrames of bytes.

A shard is a bounded group (``size`` cells), so one task builds it; shards are rows
(shard_path, content, index), which a sink writes one file each.
"""

from __future__ import annotations

import io
import json
import re
import struct
import tarfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from . import shard_source, store
from .shard_source import COUNT, FIELDS, MAGIC, RECORD, Handles, records_of


#: What an archive's plain headers have in common: all but the name, the size and the sum.
_HEAD = tarfile.TarInfo("").tobuf(tarfile.USTAR_FORMAT)
NAME, SIZE, SUM = slice(0, 100), slice(124, 136), slice(148, 156)
BLOCK = tarfile.BLOCKSIZE


def _header(name: str, size: int) -> bytes:
    """The header that ``tarfile`` writes, which takes most of the time of small members."""
    if len(name) >= 100 or not name.isascii() or size >= 8**11:
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf(tarfile.USTAR_FORMAT)
    head = bytearray(_HEAD)
    head[NAME], head[SIZE], head[SUM] = name.encode().ljust(100, b"\0"), b"%011o\0" % size, b" " * 8
    head[SUM] = b"%06o\0 " % sum(head)
    return bytes(head)


def _tar(members: list[tuple[str, bytes]]) -> tuple[bytes, dict[str, tuple[int, int]]]:
    """A tar file, and where each member's data is."""
    parts, at, end = [], {}, 0
    for name, data in members:
        head = _header(name, len(data))
        at[name] = (end + len(head), len(data))
        parts += [head, data, bytes(-len(data) % BLOCK)]
        end += sum(map(len, parts[-3:]))
    # Two empty blocks, filled up to a whole record.
    rest = 2 * BLOCK
    return b"".join([*parts, bytes(rest + -(end + rest) % tarfile.RECORDSIZE)]), at


def _plain(data: memoryview) -> list[tuple[str, int, int]] | None:
    """(name, offset, size) of a tar's files if all its headers are plain ones; None if any isn't, or the file isn't whole."""
    found, at = [], 0
    while at + BLOCK <= len(data):
        head = bytes(data[at : at + BLOCK])
        if not any(head):
            return found
        size = head[SIZE].rstrip(b" \0")
        known = head[156:157] == b"0" and head[257:263] == b"ustar\0" and not head[345] and size.isdigit()
        if not known or head[SUM] != b"%06o\0 " % (256 + sum(head) - sum(head[SUM])):
            return None
        found.append((head[NAME].rstrip(b"\0").decode("utf-8", "surrogateescape"), at + BLOCK, int(size, 8)))
        at += BLOCK + -(-found[-1][2] // BLOCK) * BLOCK
    return None


def untar(data: memoryview) -> list[tuple[str, bytes]]:
    """(name, bytes) of a tar's files; other headers than plain ones are left to ``tarfile``."""
    if (found := _plain(data)) is not None:
        return [(name, bytes(data[at : at + size])) for name, at, size in found]
    with tarfile.open(fileobj=io.BytesIO(bytes(data))) as tar:
        return [(m.name, tar.extractfile(m).read()) for m in tar]


def pack_index(records: list[tuple[int, int, int, int, int]]) -> bytes:
    """(index, image offset, image size, json offset, json size) of each cell."""
    return MAGIC + struct.pack(COUNT, len(records)) + b"".join(struct.pack(FIELDS, *r, 0) for r in records)


def unpack_index(data: bytes) -> list[tuple[int, int, int, int, int]]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    (n,) = struct.unpack_from(COUNT, data, 8)
    return records_of(data[12 : 12 + n * RECORD])


def _npy_head(kind: str, n: int) -> bytes:
    """What stands before the numbers of an array file of one dimension, filled up to a multiple of 64 bytes."""
    text = f"{{'descr': '{kind}', 'fortran_order': False, 'shape': ({n},), }}"
    text += " " * (-(len(text) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(text)) + text.encode()


#: An array file of one dimension as numpy writes it: the kind of its numbers, and how many.
_NPY = re.compile(rb"\x93NUMPY\x01\x00..\{'descr': '(<[if][48])', 'fortran_order': False, 'shape': \((\d+),\), \} *\n", re.DOTALL)


def _array(data: bytes) -> np.ndarray:
    if (head := _NPY.match(data)) is not None:
        return np.frombuffer(data, head[1].decode(), int(head[2]), head.end()).copy()
    return np.lib.format.read_array(io.BytesIO(data))


def pack_sparse(indices, values) -> bytes:
    """indices int32 and values float32 as npz."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, kind, x in (("indices", "<i4", indices), ("values", "<f4", values)):
            x = np.asarray(x, kind)
            z.writestr(zipfile.ZipInfo(f"{name}.npy"), _npy_head(kind, len(x)) + x.tobytes())
    return buffer.getvalue()


def unpack_sparse(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return _array(z.read("indices.npy")), _array(z.read("values.npy"))


def build_shards(cells: DataFrame, key: str = "sample_key", index: str = "sample_index", meta: tuple[str, ...] = ("sample_index", "sample_key", "sample_id", "cell_id")) -> DataFrame:
    """(sample_id, shard_path, content, cidx, n_cells) from cells with a shard_path and image bytes.

    Columns ``indices`` and ``values``, if there are any, add an .expr.npz to each cell, and a column
    ``class_idx`` a .cls.
    """
    bundle, classed = {"indices", "values"} <= set(cells.columns), "class_idx" in cells.columns
    names = [*dict.fromkeys(("sample_id", "shard_path", key, index, "image", *meta, *(("indices", "values") if bundle else ()), *(("class_idx",) if classed else ())))]

    # A time as text, as it would be told of in JSON.
    timed = {f.name for f in cells.schema if isinstance(f.dataType, T.TimestampType)} & set(meta) - {index}

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r[index])
        members = []
        for row in rows:
            members.append((f"{row[key]}.jpg", bytes(row["image"])))
            if bundle:
                members.append((f"{row[key]}.expr.npz", pack_sparse(row["indices"], row["values"])))
            if classed:
                members.append((f"{row[key]}.cls", class_payload(row["class_idx"])))
            members.append((f"{row[key]}.json", json.dumps({c: row[c] for c in meta}, default=str).encode()))
        content, at = _tar(members)
        records = [(int(r[index]), *at[f"{r[key]}.jpg"], *at[f"{r[key]}.json"]) for r in rows]
        return pa.table({"sample_id": pa.array([rows[0]["sample_id"]], pa.string()), "shard_path": pa.array([rows[0]["shard_path"]], pa.string()), "content": pa.array([content], pa.binary()), "cidx": pa.array([pack_index(records)], pa.binary()), "n_cells": pa.array([len(rows)], pa.int64())})

    picked = cells.select(*(F.col(c).cast("string").alias(c) if c in timed else c for c in names))
    return picked.groupBy("sample_id", "shard_path").applyInArrow(build, "sample_id string, shard_path string, content binary, cidx binary, n_cells bigint")


def offsets(shards: DataFrame) -> DataFrame:
    """(sample_id, shard_path, sample_index, tar_offset, jpg_size), to be joined back to the manifest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, p, i, o, n) for s, p, x in zip(b["sample_id"], b["shard_path"], b["cidx"], strict=True) for i, o, n, _, _ in unpack_index(bytes(x))]
            yield pd.DataFrame(rows, columns=["sample_id", "shard_path", "sample_index", "tar_offset", "jpg_size"])

    return shards.select("sample_id", "shard_path", "cidx").mapInPandas(read, "sample_id string, shard_path string, sample_index bigint, tar_offset bigint, jpg_size bigint")


def members(shards: DataFrame) -> DataFrame:
    """(sample_id, shard_path, key, ext, payload) of all members."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):  # one shard at a time, whatever a batch holds
                held = b.column(2)[k].as_buffer()
                if held is None:
                    raise ValueError(f"shard {b.column(1)[k].as_py()} has no content")
                found = untar(memoryview(held))
                names = [name.split(".", 1) for name, _ in found]
                same = lambda c: pa.array([c.as_py()] * len(found), pa.string())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same(b.column(0)[k]), same(b.column(1)[k]), pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string()), pa.array([data for _, data in found], pa.binary())], ["sample_id", "shard_path", "key", "ext", "payload"])

    return shards.select("sample_id", "shard_path", "content").mapInArrow(read, "sample_id string, shard_path string, key string, ext string, payload binary")


def payloads(rows: DataFrame, built: DataFrame, key: str = "sample_key", ext: str = "jpg", strict: bool = True) -> DataFrame:
    """Rows (sample_id, shard_path, key) with their member's bytes; a row whose shard lacks the member is an error.

    Without ``strict`` such a row has no bytes.
    """
    own = members(built).filter(F.col("ext") == ext).select("sample_id", "shard_path", F.col("key").alias(key), "payload")
    on = ["sample_id", "shard_path", key]
    found = rows.join(own, on, "left")
    if strict:
        found = cut(found)  # what is checked goes on: the shards are read once
        if lost := [tuple(r) for r in found.filter("payload IS NULL").select("shard_path", key).limit(3).collect()]:
            raise KeyError(f"shards lack members, such as {lost}")
    return found


#: Payloads that are held before they are handed on.
READ = 256


def read_range(places: DataFrame, folder: str) -> DataFrame:
    """Places (sample_id, shard_path, tar_offset, jpg_size) with their bytes, read from shards under a folder.

    Rows are dealt and sorted by shard, so that a task opens each of its shards once and reads forwards.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        handles = Handles(1)
        for some in batches:
            for b in (some.iloc[k : k + READ] for k in range(0, len(some), READ)):
                yield b.assign(payload=[handles.get(f"{folder}/{s}/{p}").read_at(int(n), int(o)) for s, p, o, n in zip(b["sample_id"], b["shard_path"], b["tar_offset"], b["jpg_size"], strict=True)])
        handles.close_all()

    dealt = places.repartition("sample_id", "shard_path").sortWithinPartitions("sample_id", "shard_path", "tar_offset")
    return dealt.mapInPandas(read, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in places.schema) + ", payload binary")


def class_payload(index) -> bytes:
    """A class as four bytes, the least first."""
    return struct.pack("<i", int(index))


def jpeg_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) from a JPEG's frame header, None if it has none; needs no codec."""
    if not data or data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data) and data[at] == 0xFF:
        mark, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        at += 2 + size
    return None


def samples_of(built: DataFrame, decoders: dict, batch: int = 32, worker: int = 0, workers: int = 1) -> Iterator[list[dict]]:
    """Batches of decoded cells for a training loop: one worker's share of the shards, streamed.

    ``decoders``: a function for each extension; members without one stay bytes.
    """
    mine = built.filter(F.pmod(F.xxhash64("sample_id", "shard_path"), F.lit(workers)) == worker)
    held: list[dict] = []
    cell: dict = {}
    for row in members(mine).toLocalIterator():
        name = (row["sample_id"], row["shard_path"], row["key"])
        if cell and cell["__key__"] != name:
            held.append(cell)
            cell = {}
            if len(held) == batch:
                yield held
                held = []
        cell.setdefault("__key__", name)
        data = bytes(row["payload"])
        cell[row["ext"]] = decoders[row["ext"]](data) if row["ext"] in decoders else data
    if cell:
        held.append(cell)
    if held:
        yield held


def byte_range(shards: DataFrame, places: DataFrame) -> DataFrame:
    """Places (sample_id, shard_path, tar_offset, jpg_size) with their bytes; one shard is opened once for all its places."""
    return places.join(shards.select("sample_id", "shard_path", "content"), ["sample_id", "shard_path"]).withColumn("payload", F.expr("substring(content, cast(tar_offset + 1 as int), cast(jpg_size as int))")).drop("content")


def write_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Write every shard and its index under a folder that all executors share; (path, bytes) of what was committed."""
    shard_source.write(shards, folder)
    return shards.sparkSession.createDataFrame([tuple(x) for x in json.loads(store.read_text(f"{folder}/_SUCCESS"))], "path string, bytes bigint")


def shard_key(sample: str = "sample_id", path: str = "shard_path") -> Column:
    """What names a shard among all samples' shards: sample and file, however its path is written."""
    return F.when(F.col(path).contains("/"), F.col(path)).otherwise(F.concat_ws("/", sample, path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, shard_path, content) of the tar files under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("sample_id"), F.element_at(F.split("path", "/"), -1).alias("shard_path"), "content")
