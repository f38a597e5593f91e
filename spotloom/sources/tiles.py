"""Hooks for pixels: the engine plans which crops are read, and a caller's functions read and write them.

Without a codec in the environment, pixels are opaque bytes; both hooks run in Arrow batches on the
executors, over rows that are dealt by sample, so that a task opens few slides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import crop_start


def crops(rows: DataFrame, base: Column, patch: int, downsample: Column, x: str = "bbox_x0", y: str = "bbox_y0") -> DataFrame:
    """Rows with crop_x, crop_y, crop_w, out_w and whether the crop is resized, at a level of a slide."""
    width = F.greatest(F.lit(1), F.round(base / downsample).cast("int"))
    return rows.withColumns({"crop_x": crop_start(F.col(x), downsample), "crop_y": crop_start(F.col(y), downsample), "crop_w": width, "out_w": F.lit(patch), "resized": width != patch})


def read_tiles(rows: DataFrame, reader: Callable[[str, pd.DataFrame], list[bytes]], sample: str = "sample_id") -> DataFrame:
    """Rows with ``image``: what ``reader(sample, crops)`` gives, called once for each sample of a batch."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, own in b.groupby(sample, sort=False, dropna=False):
                got = reader(name, own)
                if len(got) != len(own):
                    raise ValueError(f"the reader gave {len(got)} tiles of {len(own)}")
                yield own.assign(image=list(got))

    # Dealt by shard where there are shards, so that a slide isn't one task.
    by = [c for c in (sample, "shard_path") if c in rows.columns]
    return (rows.repartition(*by) if by else rows).mapInPandas(run, fields + ", image binary")


def stored_tiles(spark: SparkSession, root: str, samples: list[str], image: str, rows: DataFrame) -> DataFrame | None:
    """Rows with ``image``, the tiles that the samples hold as images/{image}_patches (cell_id, image); None if a sample has none.

    A cell without its tile is an error.
    """
    from . import catalog

    key = f"{image}_patches"
    if any(f"{key}.parquet" not in catalog.list_dir(spark, f"{root}/{s}/images") for s in samples):
        return None
    held = catalog.elements(spark, root, samples, "images", key).select("sample_id", F.col("cell_id").cast("string").alias("cell_id"), F.col("image").cast("binary").alias("image"))
    if lost := [tuple(r) for r in rows.join(held, ["sample_id", "cell_id"], "left_anti").select("sample_id", "cell_id").limit(3).collect()]:
        raise KeyError(f"cells without a tile in {key}, such as {lost}")
    return rows.join(held, ["sample_id", "cell_id"]).select(*rows.columns, "image")


#: Images that are held before they are handed on.
CONVERTED = 128


def convert(rows: DataFrame, codec: Callable[[bytes], bytes], column: str = "image") -> DataFrame:
    """Rows with a column of bytes encoded or decoded by a caller's function; null stays null."""
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for k in range(0, some.num_rows, CONVERTED):
                b = some.slice(k, CONVERTED)
                done = pa.array([None if x is None else codec(x) for x in b.column(at).to_pylist()], b.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([done if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return rows.mapInArrow(run, rows.schema)


def contrastive_pairs(rows: DataFrame, built: DataFrame, key: str = "sample_key") -> DataFrame:
    """(sample_id, key, image, expression) of every cell: both views of it, from its shard."""
    from .shards import members

    own = members(built).filter(F.col("ext").isin("jpg", "expr.npz"))
    view = lambda ext: F.max(F.when(F.col("ext") == ext, F.col("payload")))
    both = own.groupBy("sample_id", "shard_path", F.col("key").alias(key)).agg(view("jpg").alias("image"), view("expr.npz").alias("expression"))
    return rows.join(both, ["sample_id", "shard_path", key]).select("sample_id", key, "image", "expression")
