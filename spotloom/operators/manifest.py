"""Manifests: union of samples, dense indices that scale, spatial order, shards and keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import padded, shard_name
from ..session import cut, small
from ..sources.shards import shard_key

#: Rows, about, of the blocks that are numbered by themselves.
BLOCK = 1 << 16
SHARD = 500
REQUIRED = ("global_idx", "sample_id", "cell_id")


def union_samples(parts: list[DataFrame]) -> DataFrame:
    """All rows of all samples; a column that a sample lacks is null there."""
    if not parts:
        raise ValueError("there are no samples")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


#: Rows of a block, as a multiple of ``BLOCK``, beyond which it is divided again.
CROWDED = 4


def _divided(rows: DataFrame, sample: str, at: Column, spans: DataFrame, block: int) -> DataFrame:
    """Rows with a part more in ``__block``: those of ``spans`` (__s, __b, __low, __high, __n) by equal ranges of their own values."""
    parts = F.ceil(F.col("__n") / block)
    width = F.greatest(F.lit(1), F.ceil((F.col("__high") - F.col("__low") + 1) / parts)).cast("bigint")
    spans = small(spans.select("__s", "__b", "__low", width.alias("__width")))
    joined = rows.join(spans, F.col(sample).eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")), "left")
    part = F.floor((at - F.col("__low")) / F.col("__width")).cast("bigint")
    finer = F.when(F.col("__width").isNotNull(), F.concat("__block", F.array(part))).otherwise(F.col("__block"))
    return joined.withColumn("__block", finer).drop("__s", "__b", "__low", "__width")


def dense_index(rows: DataFrame, sample: str, order: str, name: str = "global_idx", block: int = BLOCK) -> DataFrame:
    """0..N-1 in the order (sample, order); ``order`` is an integer column without ties in a sample.

    No window sees all rows, or all rows of a hot sample: a sample's range of the order column is cut
    into as many blocks as it has times ``block`` rows, and a block that holds too many of them, as beside an outlier, again by the
    range of its own values, until none does. Rows are numbered within blocks, and only the table of
    block sizes, which is that much shorter than the rows, gets running sums. A table of a block or less is numbered by one window.
    """
    at = F.shiftright(F.col(order).cast("bigint"), 1)  # half of it, so that differences don't overflow
    marked = rows.withColumn("__block", F.array().cast("array<bigint>"))
    sized = lambda d: d.groupBy(F.col(sample).alias("__s"), F.col("__block").alias("__b")).agg(F.min(at).alias("__low"), F.max(at).alias("__high"), F.count("*").alias("__n"))
    sizes = cut(sized(marked))
    if (sizes.agg(F.sum("__n")).first()[0] or 0) <= block:
        return rows.withColumn(name, (F.row_number().over(Window.orderBy(sample, order)) - 1).cast("bigint"))
    crowded = sizes.filter(F.col("__high") > F.col("__low"))  # at first every sample is divided
    while not crowded.isEmpty():
        marked = _divided(marked, sample, at, crowded, block)
        sizes = cut(sized(marked))
        crowded = sizes.filter((F.col("__n") > CROWDED * block) & (F.col("__high") > F.col("__low")))
    before = F.sum("__n").over(Window.orderBy("__s", "__b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = small(sizes.select("__s", "__b", F.coalesce(before, F.lit(0)).alias("__before")))
    within = F.row_number().over(Window.partitionBy(sample, "__block").orderBy(order)) - 1
    numbered = marked.withColumn("__rank", within)
    joined = numbered.join(offsets, numbered[sample].eqNullSafe(offsets["__s"]) & (numbered["__block"] == offsets["__b"]))
    return joined.withColumn(name, (F.col("__before") + F.col("__rank")).cast("bigint")).drop("__block", "__rank", "__s", "__b", "__before")


def spatial_order(cells: DataFrame, sort_key: str, position: str, sample: str | None = None, name: str = "sample_index") -> DataFrame:
    """Ranks by tile key within a sample; ties keep their positions.

    Tiles are counted and their counts summed up; cells are ranked within their tile alone.
    """
    by = [sample] if sample else []
    sizes = cells.groupBy(*(F.col(c).alias(f"__{c}") for c in by), F.col(sort_key).alias("__key")).agg(F.count("*").alias("__n"))
    up = Window.partitionBy(*(f"__{c}" for c in by)).orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)  # one row for each tile
    offsets = small(sizes.withColumn("__before", F.coalesce(F.sum("__n").over(up), F.lit(0))).drop("__n"))
    within = F.row_number().over(Window.partitionBy(*by, sort_key).orderBy(position)) - 1
    keys = [F.col(sort_key).eqNullSafe(F.col("__key")), *(F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by)]
    ranked = cells.withColumn("__rank", within).join(offsets, reduce(Column.__and__, keys))
    return ranked.withColumn(name, (F.col("__before") + F.col("__rank")).cast("bigint")).select(*cells.columns, name)


def hashed_ranks(keys: DataFrame, key: Column, *ties: str, name: str = "rank", digits: int = 3) -> DataFrame:
    """0..N-1 in the order of a hexadecimal hash: counted by its first digits, ranked within these."""
    marked = keys.withColumn("__h", key).withColumn("__head", F.substring("__h", 1, digits))
    sizes = marked.groupBy(F.col("__head").alias("__b")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))  # 16 ** digits rows at most
    total = F.sum("__n").over(Window.partitionBy(F.lit(0)))
    offsets = sizes.select("__b", F.coalesce(before, F.lit(0)).alias("__before"), total.alias("__total"))
    within = F.row_number().over(Window.partitionBy("__head").orderBy("__h", *ties)) - 1
    ranked = marked.withColumn("__rank", within).join(F.broadcast(offsets), F.col("__head") == F.col("__b"))
    return ranked.select(*keys.columns, (F.col("__before") + F.col("__rank")).cast("int").alias(name), F.col("__total").cast("int").alias("n"))


def with_shards(rows: DataFrame, index: str = "sample_index", size: int = SHARD) -> DataFrame:
    """shard_no, local_index and the shard's file name."""
    number = F.floor(F.col(index) / size).cast("bigint")
    return rows.withColumns({"shard_no": number, "local_index": (F.col(index) % size).cast("bigint"), "shard_path": shard_name(number)})


def with_keys(rows: DataFrame, sample_index: str = "sample_index", global_idx: str = "global_idx") -> DataFrame:
    return rows.withColumns({"sample_key": padded(F.col(sample_index), 7), "global_key": padded(F.col(global_idx), 9)})


def bundled(rows: DataFrame, sample: str = "sample_id", order: str = "pos", size: int = SHARD) -> DataFrame:
    """(global_idx, sample_id, cell_id, sample_key, global_key, shard_path): shards are numbered by sample."""
    out = dense_index(rows, sample, order)
    first = out.groupBy(F.col(sample).alias("__s")).agg(F.min("global_idx").alias("__first"))
    out = out.join(first, out[sample].eqNullSafe(first["__s"])).withColumn("sample_index", F.col("global_idx") - F.col("__first"))
    out = with_keys(with_shards(out, size=size))
    return out.select("global_idx", F.col(sample).alias("sample_id"), "cell_id", "sample_key", "global_key", F.concat_ws("/", F.col(sample), "shard_path").alias("shard_path"))


def with_expression(manifest: DataFrame, expression: DataFrame, on: str = "global_idx") -> DataFrame:
    """Positions are explicit keys: an equi-join."""
    return manifest.join(expression, on)


def remap_shards(rows: DataFrame, column: str = "shard_path", sample: str = "sample_id") -> DataFrame:
    """New flat names for the sorted distinct shards; one row for each shard is ranked, not each cell.

    A shard is named by its sample and file, so that files of one name in two samples are two shards.
    """
    key = shard_key(sample, column) if sample in rows.columns else F.col(column)
    paths = rows.select(key.alias("__p")).distinct()
    new = paths.select("__p", shard_name(F.row_number().over(Window.orderBy("__p")) - 1).alias("new_path"))
    return rows.join(new, key == F.col("__p")).drop("__p")


def check_manifest(manifest: DataFrame) -> None:
    if missing := [c for c in REQUIRED if c not in manifest.columns]:
        raise ValueError(f"manifest lacks columns: {missing}")


def integrity(manifest: DataFrame, expression: DataFrame, base: float, x: Column | None = None, y: Column | None = None) -> DataFrame:
    """One row of violations over all rows: keys, ids, positions and boxes."""
    x = F.col("center_x_pixel") if x is None else x
    y = F.col("center_y_pixel") if y is None else y
    m = manifest.select("sample_index", "sample_key", "cell_id", "gene_row_index", (F.abs(x - base / 2 - F.col("bbox_x0"))).alias("ex"), (F.abs(y - base / 2 - F.col("bbox_y0"))).alias("ey"))
    e = expression.select(F.col("expr_row").alias("__row"), F.col("cell_id").alias("__cell"))
    both = m.join(e, m["sample_index"] == e["__row"], "full")
    return both.agg(
        F.count("sample_key").alias("n_rows"),
        (F.count("sample_key") - F.countDistinct("sample_key")).alias("dup_keys"),
        (F.count("cell_id") - F.countDistinct("cell_id")).alias("dup_cells"),
        F.count_if(~F.col("cell_id").eqNullSafe(F.col("__cell"))).alias("id_mismatches"),
        F.max(F.greatest("ex", "ey")).alias("max_bbox_error"),
    )
