"""Expression rows: dense arrays, sparse arrays, and coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode(dense: Column) -> Column:
    """struct(indices, values) of what isn't zero."""
    some = F.filter(F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.cast("float").alias("x"))), lambda s: s["x"] != 0)
    return F.struct(F.transform(some, lambda s: s["i"].cast("int")).alias("indices"), F.transform(some, lambda s: s["x"]).alias("values"))


def decode(indices: Column, values: Column, n: Column | int) -> Column:
    """Dense floats of a length; a place without a value is zero. Linear in the length plus the entries."""
    n = F.lit(n) if isinstance(n, int) else n
    at = F.map_from_arrays(indices, values)
    empty = F.transform(F.sequence(F.lit(1), n), lambda _: F.lit(0.0).cast("float"))
    full = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.element_at(at, i.cast("int")), F.lit(0.0)).cast("float"))
    return F.when(n <= 0, F.array().cast("array<float>")).when(F.size(indices) == 0, empty).otherwise(full)


def nnz(indices: Column) -> Column:
    return F.size(indices).cast("bigint")


def to_coordinates(rows: DataFrame, key: str, indices: str = "indices", values: str = "values") -> DataFrame:
    """(key, gene_idx, value), one row for each entry."""
    return rows.select(key, F.explode(F.arrays_zip(F.col(indices).alias("i"), F.col(values).alias("v"))).alias("e")).select(key, F.col("e.i").alias("gene_idx"), F.col("e.v").alias("value"))


def from_coordinates(entries: DataFrame, key: str) -> DataFrame:
    """Sparse rows with indices in order."""
    rows = entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("gene_idx", "value"))).alias("e"))
    return rows.select(key, F.col("e.gene_idx").alias("indices"), F.col("e.value").alias("values"))
