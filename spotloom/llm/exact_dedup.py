"""Exact deduplication by grace hashing.

Plan: every map task folds equal texts in an open-addressing table of bounded size, so
that a text with many copies leaves a task once for each time the table fills; one shuffle
deals the distinct texts by digest; each reducer runs a hybrid grace hash join with itself:
texts that find room stay in the table, the others go to spill files by the next bits of
their digest, and every file is treated in the same way. Equality is always decided by
comparing complete content; the digest only places records. A small shuffle of
(digest, doc_id) rows then gives each document its group.

Spill files live in the task's own scratch folder and end with the attempt, like the files
of Spark's own sorter: a lost executor's task starts again from the shuffle.

Defined cases: a null text is the empty text; a null id counts as a row of its group but
never as the id that stays, unless all ids are null; rows that repeat id and text are all
returned, with the same decision; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content, slices

#: Bytes of content that one task's table may hold.
TABLE_BYTES = 48 << 20
#: Spill files that one level is divided into.
FAN_OUT = 16
#: Levels after which the bits of the digest are used up.
LEVELS = 40

_HEAD = "<q?qI32s"
_SCHEMA = "digest binary, content binary, keep_id bigint, n bigint"


class Table:
    """An open-addressing table from content to [digest, content, largest id, rows]."""

    def __init__(self, room: int):
        self.room, self.used = room, 0
        self.slots: list[int] = [-1] * 1024
        self.rows: list[list] = []

    def _slot(self, digest: bytes, text: bytes) -> tuple[int, int]:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (row := self.slots[at]) >= 0:
            held = self.rows[row]
            if held[0] == digest:
                if held[1] != text:
                    raise ValueError("two different texts have one SHA-256 digest")
                return at, row
            at = (at + 1) & mask
        return at, -1

    def add(self, digest: bytes, text: bytes, keep: int | None, n: int) -> bool:
        """Fold a record in; False if its text is new and there is no room for it."""
        at, row = self._slot(digest, text)
        if row >= 0:
            held = self.rows[row]
            held[3] += n
            if keep is not None and (held[2] is None or keep > held[2]):
                held[2] = keep
            return True
        if self.rows and self.used + len(text) > self.room:
            return False
        self.slots[at] = len(self.rows)
        self.rows.append([digest, text, keep, n])
        self.used += len(text) + 120
        if 2 * len(self.rows) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for row, held in enumerate(self.rows):
            at = int.from_bytes(held[0][:8], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = row


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while head := f.read(struct.calcsize(_HEAD)):
            keep, known, n, size, digest = struct.unpack(_HEAD, head)
            yield digest, f.read(size), keep if known else None, n
    os.unlink(path)


def grace(records: Iterable[tuple], room: int = TABLE_BYTES, level: int = 0, folder: str | None = None) -> Iterator[list]:
    """One [digest, content, largest id, rows] for each distinct content of ``records``."""
    if folder is None:
        with tempfile.TemporaryDirectory(prefix="grace-") as own:
            yield from grace(records, room, level, own)
        return
    table, files = Table(room), {}
    for digest, text, keep, n in records:
        if not table.add(digest, text, keep, n):
            k = digest[8 + level // 2] >> 4 * (level % 2) & FAN_OUT - 1
            if k not in files:
                files[k] = open(os.path.join(folder, f"{level}-{k}-{len(os.listdir(folder))}"), "wb")  # noqa: SIM115
            files[k].write(struct.pack(_HEAD, keep or 0, keep is not None, n, len(text), digest))
            files[k].write(text)
    for f in files.values():
        f.close()
    yield from table.rows
    del table
    for f in files.values():
        yield from grace(_spilled(f.name), room, min(level + 1, LEVELS), folder)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in slices(batches, 512):
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batch(rows: list[list], wide: bool) -> pa.RecordBatch:
    digest, text, keep, n = zip(*rows, strict=True)
    cols = {"digest": pa.array(digest, pa.binary())} | ({"content": pa.array(text, pa.binary())} if wide else {})
    return pa.RecordBatch.from_pydict(cols | {"keep_id": pa.array(keep, pa.int64()), "n": pa.array(n, pa.int64())})


def _batches(rows: Iterable[list], wide: bool) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 100 if wide else 100
        if size > 4 << 20:
            yield _batch(held, wide)
            held, size = [], 0
    if held:
        yield _batch(held, wide)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: one row for each distinct text of a tableful."""
    table = Table(TABLE_BYTES // 3)
    for record in _records(batches):
        if not table.add(*record):
            yield from _batches(table.rows, True)
            table = Table(TABLE_BYTES // 3)
            table.add(*record)
    yield from _batches(table.rows, True)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(grace(_records(batches)), False)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, keep_id, n): one row for each distinct text."""
    text = content(text_col)
    rows = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("content"), F.col(id_col).cast("bigint").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))
    folded = rows.mapInArrow(_fold, _SCHEMA)
    return folded.repartition("digest").mapInArrow(_decide, "digest binary, keep_id bigint, n bigint")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its group, the group's size and whether the row stays."""
    digest = F.unhex(F.sha2(content(text_col), 256))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), digest.alias("digest"))
    found = rows.join(groups(docs, id_col, text_col), "digest")
    return found.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
