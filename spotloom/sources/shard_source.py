"""Tar shards as a Spark data source: ``spark.read.format("shards")`` and ``df.write.format("shards")``.

Reading: input partitions are ranges of records of the index files beside the shards, so that a shard is
split between tasks and a task reads byte ranges, not whole files; of many ranges a task has several. Samples leave out folders, and a range of
indices records, as options of the read. Spark's own pushing of filters to such a source isn't used: in 4.1.2 a
DataFrame that was read once with a filter keeps it, so that a later read of all rows would lose some.

Writing: every attempt of a task writes beside the others, below a hidden folder of its own, and the driver moves
the files of those attempts that Spark commits to their names. An attempt that is killed, fails or runs twice
leaves nothing. Rows hold a shard's bytes, or the path of one to be copied without passing through Spark.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "sample_id string, shard_path string, sample_index bigint, image binary, meta string"
#: Records of one range.
CELLS = 500
#: Input partitions at most; of more ranges a partition has several, one after the other.
PARTS = 1000
#: Files that a commit moves at once.
MOVES = 16
# The index: a fixed format. What it begins with, the number of records, a record; bytes before the records, and of a record.
MAGIC, COUNT, FIELDS = b"CIDX0001", "<I", "<iQIQII"
HEAD, RECORD = 12, 32
COPY = 1 << 20


def filesystem(path: str):
    """(the file system of a path, the path on it)."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def records_of(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """The records in the bytes after an index's head."""
    return [r[:5] for r in struct.iter_unpack(FIELDS, data)]


class Handles:
    """Open files by path; of more than ``most`` the one that wasn't used for longest is closed. For one thread."""

    def __init__(self, most: int = 128):
        self.most, self.opened, self.evicted = most, 0, 0
        self._open: OrderedDict = OrderedDict()

    def get(self, path: str):
        if path in self._open:
            self._open.move_to_end(path)
            return self._open[path]
        if len(self._open) >= self.most:
            self._open.popitem(last=False)[1].close()
            self.evicted += 1
        store, at = filesystem(path)
        self._open[path] = store.open_input_file(at)
        self.opened += 1
        return self._open[path]

    def __len__(self) -> int:
        return len(self._open)

    def close_all(self) -> None:
        while self._open:
            self._open.popitem()[1].close()


class ShardReader(DataSourceReader):
    """Cells of the samples, and of the indices from ``low`` to ``high``, where these are given."""

    def __init__(self, options: dict):
        self.folder, self.cells = options["path"], int(options.get("cells", CELLS))
        self.samples = set(json.loads(options["samples"])) if "samples" in options else None
        self.low, self.high = int(options.get("low", -(1 << 31))), int(options.get("high", (1 << 31) - 1))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, base = filesystem(self.folder)
        folders = [x.path for x in store.get_file_info(fs.FileSelector(base)) if x.type == fs.FileType.Directory and not x.base_name.startswith(("_", "."))]
        out = []
        for folder in sorted(folders):
            name = folder.rsplit("/", 1)[-1]
            if self.samples is not None and name not in self.samples:
                continue
            for x in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda x: x.path):
                if x.type == fs.FileType.File and x.extension == "idx":
                    n, rest = divmod(x.size - HEAD, RECORD)
                    if n < 0 or rest:
                        raise ValueError(f"{x.path} is no index file, or not whole")
                    out += [(name, x.path, at, min(at + self.cells, n)) for at in range(0, n, self.cells)]
        # Ranges in the order of their shards, so that a task reads a shard's one after the other.
        parts = min(PARTS, len(out))
        return [InputPartition(out[len(out) * k // parts : len(out) * (k + 1) // parts]) for k in range(parts)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # so Spark reads what has no partitions
            return
        store, _ = filesystem(self.folder)
        for (sample, index), own in groupby(partition.value, lambda r: r[:2]):
            with store.open_input_file(index) as f:
                if f.read(8) != MAGIC:
                    raise ValueError(f"{index} is not an index file")
                data = b"".join(f.read_at((last - first) * RECORD, HEAD + first * RECORD) for _, _, first, last in own)
            records = [r for r in records_of(data) if self.low <= r[0] <= self.high]
            if not records:
                continue
            path = index.removesuffix(".idx") + ".tar"
            with store.open_input_file(path) as f:
                for i, at, size, meta_at, meta_size in records:
                    yield sample, path.rsplit("/", 1)[-1], i, f.read_at(size, at), f.read_at(meta_size, meta_at).decode()


class Written(WriterCommitMessage):
    """What one attempt wrote: (where it is, where it belongs, bytes) of every file."""

    def __init__(self, files: list[tuple[str, str, int]]):
        self.files = files


class ShardWriter(DataSourceWriter):
    """Shards (sample_id, shard_path, content, cidx), or those that ``source`` names, under a folder."""

    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder, overwrite, uuid.uuid4().hex
        # Made here, on the driver: a task that is still at work when its job has been given up finds no folder to write to.
        store, base = filesystem(folder)
        store.create_dir(self.staging(base), recursive=True)

    def staging(self, base: str) -> str:
        return f"{base}/_staging-{self.job}"

    def write(self, iterator) -> Written:
        store, base = filesystem(self.folder)
        own, files = f"{self.staging(base)}/{uuid.uuid4().hex}", []
        store.create_dir(own, recursive=False)
        for row in iterator:
            r = row.asDict()
            store.create_dir(f"{own}/{r['sample_id']}", recursive=False)
            name = f"{r['sample_id']}/{r['shard_path']}"
            pairs = [(name, r.get("content"), r.get("source")), (name.removesuffix(".tar") + ".idx", r.get("cidx"), r.get("source") and r["source"].removesuffix(".tar") + ".idx")]
            for to, data, source in pairs:
                n = 0
                with store.open_output_stream(f"{own}/{to}") as f:
                    if source is None:
                        n = f.write(bytes(data))
                    else:
                        there, path = filesystem(source)
                        with there.open_input_stream(path) as g:
                            while part := g.read(COPY):
                                n += f.write(part)
                files.append((f"{own}/{to}", f"{base}/{to}", n))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, base = filesystem(self.folder)
        files = [f for m in messages if m is not None for f in m.files]
        names = [to for _, to, _ in files]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("a shard was written by two tasks: shards need distinct (sample_id, shard_path)")
        store.create_dir(base, recursive=True)
        if self.overwrite:
            for x in store.get_file_info(fs.FileSelector(base, recursive=True)):
                if x.extension in ("tar", "idx") and "/_" not in x.path.removeprefix(base):
                    store.delete_file(x.path)
        for folder in {to.rsplit("/", 1)[0] for to in names}:
            store.create_dir(folder, recursive=True)
        there = {x.path for folder in {to.rsplit("/", 1)[0] for to in names} for x in store.get_file_info(fs.FileSelector(folder))}

        def move(file: tuple[str, str, int]) -> None:
            if file[1] in there:
                store.delete_file(file[1])
            store.move(file[0], file[1])

        with ThreadPoolExecutor(MOVES) as pool:
            for _ in pool.map(move, files):  # the first error is raised
                pass
        self.abort(messages)
        with store.open_output_stream(f"{base}/_SUCCESS") as f:
            f.write(json.dumps([[to, n] for _, to, n in files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, base = filesystem(self.folder)
        for last in (False, False, True):
            try:
                if store.get_file_info(self.staging(base)).type != fs.FileType.NotFound:
                    store.delete_dir(self.staging(base))
                return
            except OSError:  # a task has just written into it
                if last:
                    raise


class ShardSource(DataSource):
    """Options: ``cells``, ``samples`` (a JSON list), ``low`` and ``high``."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ShardReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ShardWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(ShardSource)


def read_cells(spark: SparkSession, folder: str, samples: list[str] | None = None, low: int | None = None, high: int | None = None, cells: int = CELLS) -> DataFrame:
    """(sample_id, shard_path, sample_index, image, meta) of the cells of all or some samples, and of a range of indices."""
    register(spark)
    given = {"cells": cells, "samples": None if samples is None else json.dumps(samples), "low": low, "high": high}
    return spark.read.format("shards").options(**{k: v for k, v in given.items() if v is not None}).load(folder)


def write(shards: DataFrame, folder: str, mode: str = "append") -> None:
    """Write rows (sample_id, shard_path, content, cidx) or (sample_id, shard_path, source); ``overwrite`` first takes away the shards that are there."""
    register(shards.sparkSession)
    names = [c for c in ("sample_id", "shard_path", "content", "cidx", "source") if c in shards.columns]
    shards.select(*names).write.format("shards").mode(mode).save(folder)
