"""Figures as PNG: outlines on patches, and where the cells of a slide lie.

Pixels are drawn by numpy in tasks that hold one patch, or one small picture of a slide, whose pixels Spark
has counted before; PNG needs a compressor alone, which the standard library has.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shard_source import filesystem

#: Colours of layers; others are black.
COLOURS = {"tissue": (46, 160, 67), "cell": (31, 111, 235), "nucleus": (219, 55, 55)}
#: Patches that a task holds at once.
PATCHES = 512
#: Pixels of a side of a slide's picture, at most.
SIDE = 512
# What a PNG file begins with: a fixed value.
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def png(rgb: np.ndarray) -> bytes:
    """An image (h, w, 3) of bytes as a PNG file."""
    h, w, _ = rgb.shape
    lines = np.concatenate([np.zeros((h, 1), np.uint8), rgb.astype(np.uint8).reshape(h, w * 3)], 1)  # each line unfiltered
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")


def line_mask(ring: np.ndarray, h: int, w: int) -> np.ndarray:
    """The pixels of a closed outline (n, 2) of x and y; what lies outside the image is cut off."""
    out = np.zeros((h, w), bool)
    for p, q in zip(ring, np.roll(ring, -1, 0), strict=True):
        n = int(np.ceil(np.abs(q - p).max())) + 1
        xy = np.rint(p + (q - p) * np.linspace(0, 1, max(n, 1))[:, None]).astype(np.int64)
        own = xy[(xy[:, 0] >= 0) & (xy[:, 0] < w) & (xy[:, 1] >= 0) & (xy[:, 1] < h)]
        out[own[:, 1], own[:, 0]] = True
    return out


def fill_mask(rings: list[np.ndarray], h: int, w: int) -> np.ndarray:
    """The pixels whose middle is inside rings, by the parity of crossings line by line, so that inner rings are holes."""
    turns = np.zeros((h, w + 1), np.int64)
    rows = np.arange(h) + 0.5
    for ring in rings:
        for (px, py), (qx, qy) in zip(ring, np.roll(ring, -1, 0), strict=True):
            hit = np.flatnonzero((py > rows) != (qy > rows))
            if len(hit):
                x = px + (rows[hit] - py) * (qx - px) / (qy - py)
                np.add.at(turns, (hit, np.clip(np.ceil(x - 0.5), 0, w).astype(np.int64)), 1)
    return np.cumsum(turns[:, :w], 1) % 2 == 1


def patch_figures(outlines: DataFrame, patch: int, *, fill: tuple[str, ...] = (), tiles: DataFrame | None = None, keys: tuple[str, ...] = ("sample_id", "cell_id")) -> DataFrame:
    """(keys, png): every cell's patch with its outlines, as ``overlays.outlines`` gives them; layers in ``fill`` are shaded.

    ``tiles``: (keys, rgb) with patch * patch * 3 bytes to draw on; without, or for a cell without one, the ground is white. Layers
    are drawn in the order of their names; a cell without any vertex has its ground alone.
    """
    by = [k for k in keys if k in outlines.columns]
    vertex = F.struct("layer", "part", "vertex", F.col("px").cast("double").alias("px"), F.col("py").cast("double").alias("py"))
    # A row for each cell, so that a task draws one after the other: a pandas group for each would cost more than the drawing.
    cells = outlines.groupBy(*by).agg(F.array_sort(F.collect_list(vertex)).alias("all"))
    cells = cells.withColumn("rgb", F.lit(None).cast("binary"))
    if tiles is not None:
        under = tiles.groupBy(*(F.col(k).alias(f"__{k}") for k in by)).agg(F.first("rgb").alias("__rgb"))
        both = cells.join(under, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by)), "full")
        cells = both.select(*(F.coalesce(k, f"__{k}").alias(k) for k in by), "all", F.col("__rgb").alias("rgb"))

    def draw(all_: list[dict] | None, have: bytes | None) -> bytes:
        a = np.full((patch, patch, 3), 255, np.uint8) if have is None else np.frombuffer(have, np.uint8).reshape(patch, patch, 3).copy()
        known = [v for v in all_ or () if v["vertex"] is not None and v["layer"] is not None]  # in the order of layer, part and vertex
        for layer, of in groupby(known, lambda v: v["layer"]):
            colour = np.array(COLOURS.get(layer, (0, 0, 0)), float)
            rings = [np.array([(v["px"], v["py"]) for v in ring], float) for part, ring in groupby(of, lambda v: v["part"]) if part is not None]
            if layer in fill:
                inside = fill_mask(rings, patch, patch)
                a[inside] = np.rint(a[inside] * 0.6 + colour * 0.4)
            for ring in rings:
                a[line_mask(ring, patch, patch)] = colour
        return png(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PATCHES):
                some = b.slice(at, PATCHES)
                made = map(draw, some.column(len(by)).to_pylist(), some.column(len(by) + 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*some.columns[: len(by)], pa.array(list(made), pa.binary())], [*by, "png"])

    schema = ", ".join(f"`{k}` {cells.schema[k].dataType.simpleString()}" for k in by) + ", png binary"
    return cells.mapInArrow(run, schema)


def slide_figures(boxes: DataFrame, slides: DataFrame, side: int = SIDE) -> DataFrame:
    """(sample_id, png): how many tiles cover which part of each slide, the darker the more.

    ``boxes``: (sample_id, x0, y0, x1, y1); ``slides``: (sample_id, width, height). Tiles are counted by the pixel that
    holds their middle, before any picture is made: a task gets a row for each pixel, whatever the number of tiles.
    """
    scale = F.greatest("width", "height", F.lit(float(side))) / side
    at = lambda a, b, most: F.least(F.greatest(F.floor((F.col(a) + F.col(b)) / 2 / F.col("scale")), F.lit(0)), F.col(most) - 1).cast("int")
    sized = slides.select("sample_id", scale.alias("scale"), F.greatest(F.ceil(F.col("width") / scale), F.lit(1)).cast("int").alias("w"), F.greatest(F.ceil(F.col("height") / scale), F.lit(1)).cast("int").alias("h"))
    counts = boxes.join(sized, "sample_id").groupBy("sample_id", "w", "h", at("x0", "x1", "w").alias("x"), at("y0", "y1", "h").alias("y")).agg(F.count("*").alias("n"))

    def draw(own: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((int(own["h"].iat[0]), int(own["w"].iat[0])))
        a[own["y"], own["x"]] = np.log1p(own["n"])
        grey = np.rint(255 - 255 * a / a.max()).astype(np.uint8)
        return pd.DataFrame({"sample_id": [own["sample_id"].iat[0]], "png": [png(np.repeat(grey[:, :, None], 3, 2))]})

    return counts.groupBy("sample_id").applyInPandas(draw, f"sample_id {boxes.schema['sample_id'].dataType.simpleString()}, png binary")


def write_figures(figures: DataFrame, folder: str, keys: tuple[str, ...] = ("sample_id", "cell_id")) -> int:
    """{folder}/viz/{keys}.png for every figure; how many. A file has its name only once it is whole."""
    by = [k for k in keys if k in figures.columns]

    def put(batches):
        store, base = filesystem(folder)
        for b in batches:
            for row in b.to_dict("records"):
                name = "/".join(str(row[k]).replace("/", "_") for k in by)
                path, own = f"{base}/viz/{name}.png", f"{base}/viz/.{uuid.uuid4().hex}"
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(own) as f:
                    f.write(bytes(row["png"]))
                store.move(own, path)
            yield pd.DataFrame({"n": [len(b)]})

    return figures.select(*by, "png").mapInPandas(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
