"""Cells by their number for a training loop: a reader in the loader's own process, without a Spark job for an item."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame

from . import shards
from .shard_source import Handles, filesystem

#: Open shards of a reader, at most.
HANDLES = 128


class CellReader:
    """The cells of a manifest (sample_id, shard_path, tar_offset, jpg_size, ...) in its order, and with their expression if it is given.

    ``rows`` are held as Arrow columns, some tens of bytes a cell; a split is a reader of its rows alone. A copy in another
    process opens files of its own.
    """

    NEEDS = ("sample_id", "shard_path", "tar_offset", "jpg_size")

    def __init__(self, rows: pa.Table, folder: str, handles: int = HANDLES):
        if missing := [c for c in self.NEEDS if c not in rows.column_names]:
            raise ValueError(f"the manifest lacks columns: {missing}")
        self.rows, self.folder, self.most = rows, folder, handles
        self.handles = Handles(handles)

    @classmethod
    def of(cls, manifest: DataFrame, folder: str, *, order: str, expression: DataFrame | None = None, handles: int = HANDLES) -> CellReader:
        """A reader of a manifest's rows, in the order of a column; ``expression`` joins by it: (order, indices, values)."""
        rows = manifest if expression is None else manifest.join(expression, order, "left")
        return cls(rows.orderBy(order).toArrow(), folder, handles)

    def __len__(self) -> int:
        return self.rows.num_rows

    def __getitem__(self, i: int) -> dict:
        """The cell's row with ``image``, its bytes, which are read from the shard."""
        if not -len(self) <= i < len(self):
            raise IndexError(f"there are {len(self)} cells, no {i}")
        row = {k: v[0] for k, v in self.rows.slice(i % len(self), 1).to_pydict().items()}
        path = row["shard_path"] if "/" in row["shard_path"] else f"{row['sample_id']}/{row['shard_path']}"
        row["image"] = self.handles.get(f"{self.folder}/{path}").read_at(row["jpg_size"], row["tar_offset"])
        return row

    def __getstate__(self) -> dict:
        return self.__dict__ | {"handles": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state | {"handles": Handles(state["most"])})

    def close(self) -> None:
        self.handles.close_all()


def index_of(path: str) -> list[dict]:
    """What a shard's index file says of its cells, with their metadata from the shard."""
    store, at = filesystem(path)
    with store.open_input_file(at) as f:
        records = shards.unpack_index(f.read())
    with store.open_input_file(at.removesuffix(".idx") + ".tar") as f:
        return [{"sample_index": i, "tar_offset": o, "jpg_size": n, "meta": json.loads(f.read_at(size, where))} for i, o, n, where, size in records]
