"""The data behind the figures: tile boxes, outlines in patch pixels, and counts of what a check found."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import canonical_id, overlay_px
from ..session import cut
from ..sources import shards, store
from .align import common_keys
from .filters import uniform_sample


def tile_boxes(rows: DataFrame, base: Column, x: str = "bbox_x0", y: str = "bbox_y0") -> DataFrame:
    """(sample_id, cell_id, x0, y0, x1, y1) of the tiles of a manifest, in slide pixels."""
    return rows.select("sample_id", "cell_id", F.col(x).alias("x0"), F.col(y).alias("y0"), (F.col(x) + base).alias("x1"), (F.col(y) + base).alias("y1"))


def outlines(rows: DataFrame, boundaries: DataFrame, layer: str, *, scale: Column, patch: Column, base: Column, x: str = "bbox_x0", y: str = "bbox_y0", shape_id: str = "shape_id") -> DataFrame:
    """([sample_id,] cell_id, layer, part, vertex, px, py): the outlines of cells in the pixels of their patches.

    A cell with several boundaries has several parts; a cell without any has one row without a vertex.
    """
    on = common_keys(rows, boundaries)
    shape = boundaries.select(*on, canonical_id(shape_id).alias("cell_id"), "rings")
    shape = shape.groupBy(*on, "cell_id").agg(F.array_sort(F.collect_list(F.col("rings")[0])).alias("parts"))
    cells = rows.select(*on, canonical_id("cell_id").alias("cell_id"), F.col(x).alias("x0"), F.col(y).alias("y0"), scale.alias("scale"), patch.alias("patch"), base.alias("base"))
    joined = cells.join(shape, [*on, "cell_id"], "left")
    each = joined.select("*", F.posexplode_outer("parts").alias("part", "ring")).select("*", F.posexplode_outer("ring").alias("vertex", "p"))
    px = lambda c, o: overlay_px(F.col(c), F.col("scale"), F.col(o), F.col("patch"), F.col("base"))
    return each.select(*on, "cell_id", F.lit(layer).alias("layer"), "part", "vertex", px("p.x", "x0").alias("px"), px("p.y", "y0").alias("py"))


def grid_sample(rows: DataFrame, n: int = 25, seed: int = 42, square: bool = False) -> DataFrame:
    """The cells of a check's grid: n of them, or all if there are fewer; ``square`` fills whole rows only."""
    have = min(n, rows.count())
    return uniform_sample(rows, int(have**0.5) ** 2 if square else have, seed, "cell_id")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _size(data: pd.Series) -> pd.Series:
    """Width and height from images' headers."""
    found = [None if x is None else shards.jpeg_size(bytes(x)) for x in data]
    return pd.Series([list(x) if x else None for x in found])


def qc_counts(rows: DataFrame, built: DataFrame, patch: int, key: str = "sample_key") -> DataFrame:
    """(n_checked, n_rendered, missing_members, decode_errors, bad_image_size) of the given cells' images."""
    found = shards.payloads(rows, built, key, strict=False).withColumn("size", _size("payload"))
    missing, broken = F.col("payload").isNull(), F.col("payload").isNotNull() & F.col("size").isNull()
    bad = F.col("size").isNotNull() & ((F.col("size")[0] != patch) | (F.col("size")[1] != patch))
    # One row, cut: the report and the caller read it, not the images again.
    return cut(found.agg(F.count("*").alias("n_checked"), F.count_if(~missing & ~broken & ~bad).alias("n_rendered"), F.count_if(missing).alias("missing_members"), F.count_if(broken).alias("decode_errors"), F.count_if(bad).alias("bad_image_size")))


def write_viz_report(folder: str, counts: DataFrame, *, tables: dict[str, str], overlay_keys: list[str], warnings: list[str] = ()) -> dict:
    """viz_report.json: the counts, and where the data of the figures is."""
    report = {**counts.first().asDict(), "overlay_keys_used": list(overlay_keys), "warnings": list(warnings), **tables}
    store.write_json(f"{folder}/viz/viz_report.json", report)
    return report
