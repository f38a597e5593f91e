"""Patch filters: masks are columns over all aligned cells; one conjunction keeps the survivors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STRICT, MINIMAL, PADDED, AUTO = "strict_no_padding", "minimal", "strict_with_padding", "auto"
TILES = "tile_images"
MODES = (TILES, "full_scale0", "full_ops_level")


def resolve_policy(policy: str, mode: str = TILES) -> str:
    """``auto`` is the strict policy for every mode; a name that ends in ``minimal`` is the minimal one."""
    if policy == AUTO:
        return STRICT
    return MINIMAL if policy.endswith(MINIMAL) else policy


def validate_policy(policy: str, mode: str = TILES) -> str:
    """The resolved policy, or an error before any job starts."""
    got = resolve_policy(policy, mode)
    if mode not in MODES:
        raise ValueError(f"unknown extract mode {mode!r}; known: {', '.join(MODES)}")
    if got == PADDED:
        raise NotImplementedError("padding of patches is not supported")
    if got not in (STRICT, MINIMAL):
        raise ValueError(f"unknown patch policy {policy!r}")
    if got == MINIMAL and mode != TILES:
        raise ValueError(f"policy {policy!r} needs mode {TILES!r}, not {mode!r}")
    return got


def positive_centroid(cx: Column, cy: Column) -> Column:
    return (cx > 0) & (cy > 0)


def full_oob(sx: Column, sy: Column, base: Column, width: Column, height: Column) -> Column:
    """No pixel of the tile is on the image."""
    return (sx + base <= 0) | (sx >= width) | (sy + base <= 0) | (sy >= height)


def need_pad(sx: Column, sy: Column, base: Column, width: Column, height: Column) -> Column:
    """The tile crosses an edge but isn't wholly off the image."""
    crosses = (sx < 0) | (sy < 0) | (sx + base > width) | (sy + base > height)
    return crosses & ~full_oob(sx, sy, base, width, height)


def with_masks(cells: DataFrame, width: float | Column, height: float | Column, base: float | Column, x: str = "x_px", y: str = "y_px") -> DataFrame:
    """positive, full_oob and need_pad of every cell, beside its tile origin sx0, sy0; a slide's sizes may be columns."""
    w, h, b = ((v if isinstance(v, Column) else F.lit(float(v))).cast("double") for v in (width, height, base))
    out = cells.withColumn("sx0", F.col(x) - b / 2).withColumn("sy0", F.col(y) - b / 2)
    sx, sy = F.col("sx0"), F.col("sy0")
    return out.withColumns({"positive": positive_centroid(F.col(x), F.col(y)), "full_oob": full_oob(sx, sy, b, w, h), "need_pad": need_pad(sx, sy, b, w, h)})


def keeps(policy: str, mode: str = TILES) -> Column:
    """What a policy keeps, over the mask columns."""
    got = validate_policy(policy, mode)
    return ~F.col("full_oob") if got == MINIMAL else ~F.col("full_oob") & ~F.col("need_pad")


def survivors(masked: DataFrame, policy: str = AUTO, mode: str = TILES) -> DataFrame:
    """Cells with a positive centroid that the policy keeps."""
    return masked.filter(F.col("positive") & keeps(policy, mode))


def policy_counts(masked: DataFrame, policy: str = AUTO, mode: str = TILES) -> DataFrame:
    """The drop counts a policy reports: each reason by itself, so that they may overlap."""
    got = validate_policy(policy, mode)
    counts = [F.count_if("full_oob").alias("full_oob")] + ([F.count_if("need_pad").alias("need_pad")] if got == STRICT else [])
    return masked.agg(*counts)


def filter_report(masked: DataFrame, n_source: int | Column, policy: str = AUTO, mode: str = TILES, *by: str) -> DataFrame:
    """Survivors of each step in sequence, and the drops by reason, in one pass: one row, or one for each of ``by``."""
    keep = keeps(policy, mode)
    n = n_source if isinstance(n_source, Column) else F.lit(n_source).cast("bigint")
    return masked.groupBy(*by).agg(
        F.max(n).alias("n_source"),
        F.count("*").alias("n_aligned"),
        F.count_if(F.col("positive")).alias("n_positive"),
        F.count_if(F.col("positive") & keep).alias("n_out"),
        F.count_if(~F.col("positive")).alias("drop_non_positive_centroid"),
        F.count_if(F.col("full_oob")).alias("drop_full_oob"),
        F.count_if(F.col("need_pad")).alias("drop_need_pad"),
    )


def drop_reasons(row: dict, requested: int | None = None) -> dict[str, int]:
    """The reasons as reported: alignment only where it dropped cells, the centroid and the subsample always."""
    out = {"non_positive_centroid": row["drop_non_positive_centroid"], "full_oob": row["drop_full_oob"], "need_pad": row["drop_need_pad"]}
    if row["n_source"] > row["n_aligned"]:
        out["unaligned_with_shapes"] = row["n_source"] - row["n_aligned"]
    if "n_valid" in row:
        out["requested_subsample"] = row["n_valid"] - row["n_out"]
    else:
        out["requested_subsample"] = max(0, row["n_out"] - requested) if requested else 0
    return out


def sample_filter(rows: DataFrame, samples: list[str] | None, column: str = "sample_id") -> DataFrame:
    """Rows of some samples; None is all."""
    return rows if samples is None else rows.filter(F.col(column).isin(samples))


def pick_samples(found: list[str], asked: list[str] | None, strict: bool = True) -> list[str]:
    """An allow-list over discovered samples: in the asked order with unknown names an error, or in sorted order."""
    if asked is None:
        return sorted(found)
    if strict:
        if missing := [s for s in asked if s not in found]:
            raise ValueError(f"samples not found: {missing}")
        return list(asked)
    kept = [s for s in sorted(found) if s in set(asked)]
    if not kept:
        raise ValueError(f"none of the samples {asked} was found")
    return kept


def uniform_sample(rows: DataFrame, n: int | None, seed: int, id_col: str) -> DataFrame:
    """n rows without replacement, the first by a keyed hash of the id; too few rows are an error.

    The order is a top-k over hashes, which every task cuts before its rows are merged.
    """
    if not n:
        return rows
    if (have := rows.count()) < n:
        raise AssertionError(f"asked for {n} of {have} rows")
    return rows.orderBy(_seeded(seed, id_col), F.col(id_col)).limit(n)


def _seeded(seed: int, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_each(rows: DataFrame, n: int | None, seed: int, id_col: str, by: str = "sample_id") -> DataFrame:
    """n rows of every sample, the first by a keyed hash of the id; a sample with too few rows is an error.

    Rows are counted by the beginnings of their hashes and ranked within one of these, so that no window
    sees all rows of a large sample.
    """
    if not n:
        return rows
    sizes = rows.groupBy(by).agg(F.count("*").alias("__n"))
    if few := sizes.filter(F.col("__n") < n).orderBy(by).limit(5).collect():
        raise AssertionError(f"asked for {n} rows of each sample: {[(r[0], r['__n']) for r in few]}")
    hashed = rows.withColumn("__h", _seeded(seed, id_col))
    # How many rows have a hash with each three-digit beginning: the n-th is within the first beginnings that hold n.
    head = F.substring("__h", 1, 3)
    counts = hashed.groupBy(by, head.alias("__head")).agg(F.count("*").alias("__k"))
    before = F.sum("__k").over(Window.partitionBy(by).orderBy("__head").rowsBetween(Window.unboundedPreceding, -1))
    edge = counts.withColumn("__before", F.coalesce(before, F.lit(0))).filter(F.col("__before") < n).select(by, "__head", "__before")
    some = hashed.withColumn("__head", head).join(edge, [by, "__head"])
    rank = F.row_number().over(Window.partitionBy(by, "__head").orderBy("__h", id_col))
    return some.withColumn("__r", F.col("__before") + rank).filter(F.col("__r") <= n).select(*rows.columns)


def numpy_sample(rows: DataFrame, n: int | None, seed: int, order: str) -> DataFrame:
    """n rows as numpy's default generator draws them from the rows in order, without replacement.

    The draw needs the number of rows alone; rows are numbered in blocks and joined to the n drawn numbers.
    """
    from .manifest import dense_index

    if not n:
        return rows
    if (have := rows.count()) < n:
        raise AssertionError(f"asked for {n} of {have} rows")
    drawn = np.random.default_rng(seed).choice(have, n, replace=False)
    picked = rows.sparkSession.createDataFrame(pd.DataFrame({"__at": drawn.astype("int64"), "draw": np.arange(n, dtype="int64")}))
    numbered = dense_index(rows.withColumn("__all", F.lit(0)), "__all", order, "__at").drop("__all")
    return numbered.join(F.broadcast(picked), "__at").drop("__at")  # as many rows as were asked for
