"""Chunked array stores as a Spark data source: ``spark.read.format("chunks")`` and ``write_array``, ``write_csr``.

A store is a folder with an array's metadata (``.zarray``, version 2, or ``zarr.json``, version 3) and a file for each
chunk, or a group of three such arrays, ``data``, ``indices`` and ``indptr``, that hold a sparse matrix by rows.
Chunks are raw or compressed with zlib or gzip, which the standard library reads.

Reading: an input partition is one row of chunks of an array, and of a sparse matrix a range of rows of about a chunk's
entries, cut where rows begin, so that no row is in two tasks and a task reads the chunks of its own rows alone.
Of an array a row is (row, values); of a sparse matrix (row, indices, values). The options ``first`` and ``last``
leave out other rows and their chunks.

Defined cases: a chunk that isn't there holds the fill value; an array of no rows has no partitions; one dimension
gives rows of one value, more than two are flattened by row; codecs other than those named are an error.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from ..session import cut, small
from .shard_source import filesystem

#: Entries of a sparse matrix's input partition, about.
ENTRIES = 1 << 18
#: Any of the two headers that zlib and gzip put before a stream.
AUTO = 32 + zlib.MAX_WBITS
# The codecs that are read, in either version's words: fixed values.
PLAIN, DEFLATED = ("bytes",), ("zlib", "gzip")


class Array:
    """An array's metadata, and its chunks."""

    def __init__(self, store, path: str):
        from pyarrow import fs

        self.store, self.path = store, path
        there = lambda name: store.get_file_info(f"{path}/{name}").type == fs.FileType.File
        if there(".zarray"):
            m = self._json(".zarray")
            self.shape, self.chunks, self.dtype = m["shape"], m["chunks"], np.dtype(m["dtype"])
            self.fill, codecs = m.get("fill_value"), [m.get("compressor"), *(m.get("filters") or [])]
            self.prefix, self.separator, order = "", m.get("dimension_separator", "."), m.get("order", "C")
            codecs = [c["id"] for c in codecs if c]
        elif there("zarr.json"):
            m = self._json("zarr.json")
            if m.get("node_type") != "array":
                raise ValueError(f"{path} is no array")
            self.shape, self.chunks = m["shape"], m["chunk_grid"]["configuration"]["chunk_shape"]
            self.dtype, self.fill, order = np.dtype(m["data_type"]), m.get("fill_value"), "C"
            key = m.get("chunk_key_encoding", {"name": "default"})
            self.prefix = "c/" if key["name"] == "default" else ""
            self.separator = key.get("configuration", {}).get("separator", "/" if self.prefix else ".")
            if any(c.get("configuration", {}).get("endian") == "big" for c in m["codecs"]):
                self.dtype = self.dtype.newbyteorder(">")
            codecs = [c["name"] for c in m["codecs"]]
        else:
            raise ValueError(f"{path} has neither .zarray nor zarr.json")
        # Not a NotImplementedError: of partitions, Spark takes that for "there are none".
        if unknown := [c for c in codecs if c not in (*PLAIN, *DEFLATED)]:
            raise ValueError(f"{path} has codecs that aren't read: {unknown}; known: {', '.join((*PLAIN, *DEFLATED))}")
        if order != "C":
            raise ValueError(f"{path} is not in the order of rows")
        self.deflated = any(c in DEFLATED for c in codecs)

    def _json(self, name: str) -> dict:
        with self.store.open_input_stream(f"{self.path}/{name}") as f:
            return json.loads(f.read())

    def chunk(self, *at: int) -> np.ndarray:
        """One chunk, whole even where it reaches over the array's end."""
        name = self.separator.join(map(str, at))
        try:
            with self.store.open_input_stream(f"{self.path}/{self.prefix}{name}") as f:
                data = f.read()
        except FileNotFoundError:
            return np.full(self.chunks, self.fill or 0, self.dtype)
        return np.frombuffer(zlib.decompress(data, AUTO) if self.deflated else data, self.dtype).reshape(self.chunks)

    def rows(self, first: int, last: int) -> np.ndarray:
        """Rows from ``first`` to before ``last``, of the chunks that they lie in."""
        tall, rest = self.chunks[0], [range((n + c - 1) // c) for n, c in zip(self.shape[1:], self.chunks[1:], strict=True)]
        parts = []
        for i in range(first // tall, (last - 1) // tall + 1) if last > first else ():
            whole = np.empty([tall, *(len(r) * c for r, c in zip(rest, self.chunks[1:], strict=True))], self.dtype)
            for at in np.ndindex(*(len(r) for r in rest)):
                whole[(slice(None), *(slice(k * c, (k + 1) * c) for k, c in zip(at, self.chunks[1:], strict=True)))] = self.chunk(i, *at)
            own = whole[max(first - i * tall, 0) : last - i * tall]
            parts.append(own[(slice(None), *(slice(0, n) for n in self.shape[1:]))])
        return np.concatenate(parts) if parts else np.empty([0, *self.shape[1:]], self.dtype)


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.entries = options["path"], int(options.get("entries", ENTRIES))
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", 1 << 62))

    def open(self) -> Array:
        return Array(*filesystem(self.folder))

    def partitions(self) -> list[InputPartition]:
        a = self.open()
        tall, last = a.chunks[0], min(a.shape[0] - 1, self.last)
        return [InputPartition((max(z, self.first), min(z + tall - 1, last))) for z in range(self.first // tall * tall, last + 1, tall)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # so Spark reads what has no partitions
            return
        first, last = partition.value
        values = self.open().rows(first, last + 1)
        for k, row in enumerate(values.reshape(len(values), -1).astype(float)):
            yield first + k, row.tolist()


class SparseReader(ChunkReader):
    def open(self, name: str) -> Array:
        store, path = filesystem(self.folder)
        return Array(store, f"{path}/{name}")

    def partitions(self) -> list[InputPartition]:
        starts = self.open("indptr")
        n, last = starts.shape[0] - 1, min(starts.shape[0] - 2, self.last)
        if n <= 0 or last < self.first:
            return []
        # Where rows begin is read chunk by chunk: only the cuts are kept, not the starts of all rows.
        cuts, part, tall = [self.first], np.empty(0, np.int64), starts.chunks[0]
        for z in range(self.first, last + 1, tall):
            part = np.concatenate((part[-1:], starts.rows(z, min(z + tall, last + 2)).astype(np.int64)))
            off = z - (len(part) > min(z + tall, last + 2) - z)  # the row that the first of them is of
            at = int(part[0]) if z == self.first else at
            while len(some := np.flatnonzero(part - at > self.entries)):
                cut = max(off + int(some[0]) - 1, cuts[-1] + 1)  # a row of more entries is a partition by itself
                if cut > last:
                    break
                cuts.append(cut)
                at = int(part[cut - off])
        return [InputPartition((p, q - 1)) for p, q in zip(cuts, [*cuts[1:], last + 1], strict=True)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # so Spark reads what has no partitions
            return
        first, last = partition.value
        starts = self.open("indptr").rows(first, last + 2).astype(np.int64)
        indices, values = (self.open(x).rows(int(starts[0]), int(starts[-1])) for x in ("indices", "data"))
        for k in range(len(starts) - 1):
            own = slice(int(starts[k] - starts[0]), int(starts[k + 1] - starts[0]))
            yield first + k, indices[own].astype(np.int32).tolist(), values[own].astype(float).tolist()


class ChunkSource(DataSource):
    """Options: ``kind`` (``array`` or ``csr``), ``first`` and ``last`` row, ``entries`` of a sparse partition."""

    @classmethod
    def name(cls) -> str:
        return "chunks"

    def sparse(self) -> bool:
        return self.options.get("kind", "array") == "csr"

    def schema(self) -> str:
        return "row bigint, indices array<int>, values array<double>" if self.sparse() else "row bigint, values array<double>"

    def reader(self, schema) -> DataSourceReader:
        return (SparseReader if self.sparse() else ChunkReader)(dict(self.options))


def read(spark: SparkSession, folder: str, kind: str = "array", **options) -> DataFrame:
    """(row, values) of an array, or (row, indices, values) of a sparse matrix (``kind='csr'``)."""
    spark.dataSource.register(ChunkSource)
    return spark.read.format("chunks").option("kind", kind).options(**options).load(folder)


def _write_chunks(rows: DataFrame, folder: str, values: str, dtype: str, tall: int, wide: int, level: int) -> None:
    """A file for each chunk of rows (row, values), written by the task that has all its rows."""
    width = 1 if wide == 0 else wide

    def put(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["row"].iat[0]) // tall
        whole = np.zeros((tall, width), dtype)
        for r, v in zip(group["row"], group["values"], strict=True):
            whole[int(r) % tall] = v
        data = zlib.compress(whole.tobytes(), level) if level else whole.tobytes()
        store, base = filesystem(folder)
        with store.open_output_stream(f"{base}/{number}" + ".0" * (wide > 0)) as f:
            f.write(data)
        return pd.DataFrame({"chunk": [number]})

    own = rows.select(F.col("row").cast("bigint").alias("row"), F.col(values).alias("values"))
    own.groupBy(F.floor(F.col("row") / tall).alias("__chunk")).applyInPandas(put, "chunk bigint").count()


def _write_meta(folder: str, shape: list[int], chunks: list[int], dtype: str, level: int) -> None:
    store, base = filesystem(folder)
    store.create_dir(base, recursive=True)
    meta = {"zarr_format": 2, "shape": shape, "chunks": chunks, "dtype": np.dtype(dtype).str, "compressor": {"id": "zlib", "level": level} if level else None, "fill_value": 0, "order": "C", "filters": None}
    with store.open_output_stream(f"{base}/.zarray") as f:
        f.write(json.dumps(meta).encode())


def write_array(rows: DataFrame, folder: str, shape: tuple[int, ...], values: str = "values", dtype: str = "float64", tall: int = 1024, level: int = 6) -> None:
    """Rows (row, values) as an array of one or two dimensions, in chunks of ``tall`` whole rows; ``level`` 0 leaves them raw.

    Metadata comes last: a folder without it is no array.
    """
    wide = shape[1] if len(shape) > 1 else 0
    store, base = filesystem(folder)
    store.create_dir(base, recursive=True)
    _write_chunks(rows, folder, values, dtype, tall, wide, level)
    _write_meta(folder, list(shape), [tall, wide] if wide else [tall], dtype, level)


def write_csr(rows: DataFrame, folder: str, n_rows: int, tall: int = 1 << 16, dtype: str = "float32", level: int = 6) -> None:
    """Rows (row, indices, values) as a sparse matrix; a row that is missing is empty.

    Where each row's entries stand is counted by blocks of rows, so that no window sees them all.
    """
    from ..operators.manifest import BLOCK

    spark = rows.sparkSession
    every = spark.range(n_rows).select(F.col("id").alias("row")).join(rows.select(F.col("row").cast("bigint").alias("row"), "indices", "values"), "row", "left")
    sized = cut(every.select("row", F.coalesce(F.size("indices"), F.lit(0)).cast("bigint").alias("n"), "indices", "values", F.floor(F.col("row") / BLOCK).alias("block")))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = sized.groupBy("block").agg(F.sum("n").alias("m"))
    offsets = blocks.select("block", F.coalesce(F.sum("m").over(earlier(Window.orderBy("block"))), F.lit(0)).alias("before"))  # a row for each block of rows
    within = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("block").orderBy("row"))), F.lit(0))
    placed = cut(sized.withColumn("within", within).join(small(offsets), "block").withColumn("start", F.col("before") + F.col("within")).select("row", "n", "indices", "values", "start"))
    total = placed.agg(F.sum("n")).first()[0] or 0
    end = spark.createDataFrame([(n_rows, total)], "row bigint, start bigint")
    write_array(placed.select("row", "start").unionByName(end), f"{folder}/indptr", (n_rows + 1,), "start", "int64", tall, level)
    entries = placed.select("start", F.posexplode(F.arrays_zip("indices", "values")).alias("k", "e")).select((F.col("start") + F.col("k")).alias("row"), F.col("e.indices").alias("i"), F.col("e.values").alias("v"))
    write_array(entries, f"{folder}/indices", (total,), "i", "int32", tall, level)
    write_array(entries, f"{folder}/data", (total,), "v", dtype, tall, level)
