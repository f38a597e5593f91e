"""Column expressions for ids, keys, geometry scalars and coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_id(column: str | Column) -> Column:
    """Ids are compared as strings."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def with_cell_ids(table: DataFrame, column: str = "cell_id") -> DataFrame:
    """The table with its id column as strings; an unknown column is an error that lists the known ones."""
    if column not in table.columns:
        raise KeyError(f"column {column!r} not found; available: {sorted(table.columns)}")
    return table.withColumn(column, canonical_id(column))


def slide_mpp(a00: Column, a01: Column, a10: Column, a11: Column, s00: Column, s11: Column) -> Column:
    """Microns per pixel of a slide, from the affine of the image and the scale of the shapes."""
    scale = (s00 + s11) / 2
    return (F.sqrt(a00 * a00 + a10 * a10) + F.sqrt(a01 * a01 + a11 * a11)) / 2 / scale


def base_size(patch: Column, mpp_target: Column, mpp: Column) -> Column:
    """A patch's width in slide pixels, rounded half to even."""
    return F.bround(patch * mpp_target / mpp, 0).cast("bigint")


def tile_origin(center: Column, base: Column) -> Column:
    """The upper or left edge of a tile: half a tile, not rounded, before its centre."""
    return center - base.cast("double") / 2.0


def tile_key(sx: Column, sy: Column, block: int = 4096) -> Column:
    """Order of tiles by blocks of the slide: rows of blocks, then blocks of a row."""
    at = lambda v: F.floor(F.greatest(v, F.lit(0.0)) / block).cast("bigint")
    return at(sy) * 10000 + at(sx)


def padded(i: Column, width: int) -> Column:
    """Zero-padded decimal; longer numbers keep all digits."""
    text = i.cast("bigint").cast("string")
    # Formatting costs many times what padding does.
    return F.when(i < 0, F.format_string(f"%0{width}d", i)).when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def shard_name(number: Column) -> Column:
    return F.concat(F.lit("shard-"), padded(number, 6), F.lit(".tar"))


def sample_id_of(path: Column) -> Column:
    """The last component of a path without its suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?/*$", 1)


def obs_name(sample: Column, name: Column) -> Column:
    return F.concat_ws("/", sample, name)


def fold_label(fold: Column, held: int | None = None) -> Column:
    """``fold_i``, or val and train if one fold is held."""
    if held is None:
        return F.concat(F.lit("fold_"), fold.cast("string"))
    return F.when(fold == held, "val").otherwise("train")


def crop_start(x: Column, downsample: Column) -> Column:
    """First pixel of a crop at a lower level: truncated towards zero."""
    return (x / downsample).cast("int")


def downsample(full: Column, level: Column) -> Column:
    return full / level


def overlay_px(v: Column, scale: Column, origin: Column, patch: Column, base: Column) -> Column:
    """A coordinate of a shape in the pixels of a resized patch."""
    return (v * scale - origin) * patch / base


def cell_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def panel_sha256(genes: Column) -> Column:
    """SHA-256 of an ordered panel as compact JSON; for names of plain ASCII."""
    return F.sha2(F.concat(F.lit('["'), F.array_join(genes, '","'), F.lit('"]')), 256)
