"""Alignment of a cell table with a shape layer, and presence in a nucleus layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_id
from ..session import cut, small


SAMPLE = "sample_id"


def common_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """The sample, where both sides have one: equal ids and positions of other samples never meet."""
    return [SAMPLE] if SAMPLE in a.columns and SAMPLE in b.columns else []


def _two(table: DataFrame, shapes: DataFrame, t_id: str, t_pos: str, s_id: str, s_pos: str) -> tuple[DataFrame, DataFrame, list[str]]:
    on = common_keys(table, shapes)
    t = table.select(*on, canonical_id(t_id).alias("cell_id"), F.col(t_pos).cast("bigint").alias("row_pos"))
    s = shapes.select(*on, canonical_id(s_id).alias("shape_id"), F.col(s_pos).cast("bigint").alias("shape_pos"))
    return t, s, on


def exact(table: DataFrame, shapes: DataFrame, t_id: str = "cell_id", t_pos: str = "pos", s_id: str = "shape_id", s_pos: str = "pos") -> DataFrame:
    """([sample_id,] row_pos, table_pos, shape_pos, cell_id) by position; meant for layers that ``is_exact`` admits."""
    t, s, on = _two(table, shapes, t_id, t_pos, s_id, s_pos)
    joined = t.join(s.withColumn("row_pos", F.col("shape_pos")), [*on, "row_pos"])
    return joined.select(*on, "row_pos", F.col("row_pos").alias("table_pos"), "shape_pos", "cell_id")


def modes(table: DataFrame, shapes: DataFrame, t_id: str = "cell_id", t_pos: str = "pos", s_id: str = "shape_id", s_pos: str = "pos") -> DataFrame:
    """([sample_id,] exact, n_table, n_shapes): equal length and equal ids at every position, by one full join and one aggregate."""
    t, s, on = _two(table, shapes, t_id, t_pos, s_id, s_pos)
    both = t.withColumn("p", F.col("row_pos")).join(s.withColumn("p", F.col("shape_pos")), [*on, "p"], "full")
    differ = F.count_if(~F.col("cell_id").eqNullSafe(F.col("shape_id")) | F.col("row_pos").isNull() | F.col("shape_pos").isNull())
    return both.groupBy(*on).agg((differ == 0).alias("exact"), F.count("row_pos").alias("n_table"), F.count("shape_pos").alias("n_shapes"))


def is_exact(table: DataFrame, shapes: DataFrame, **names: str) -> bool:
    """Whether all samples are aligned by position."""
    return modes(table, shapes, **names).filter("not exact").isEmpty()


def intersection(table: DataFrame, shapes: DataFrame, t_id: str = "cell_id", t_pos: str = "pos", s_id: str = "shape_id", s_pos: str = "pos") -> DataFrame:
    """([sample_id,] row_pos, table_pos, shape_pos, cell_id) of the ids on both sides.

    Every table row with such an id stays; of an id that occurs several times, all rows point
    to its last place on either side.
    """
    t, s, on = _two(table, shapes, t_id, t_pos, s_id, s_pos)
    last_t = t.groupBy(*on, "cell_id").agg(F.max("row_pos").alias("table_pos"))
    last_s = s.groupBy(*on, F.col("shape_id").alias("cell_id")).agg(F.max("shape_pos").alias("shape_pos"))
    return t.join(last_t.join(last_s, [*on, "cell_id"]), [*on, "cell_id"]).select(*on, "row_pos", "table_pos", "shape_pos", "cell_id")


def align(table: DataFrame, shapes: DataFrame, **names: str) -> tuple[str, DataFrame]:
    """The mode and the alignment; no common id is an error."""
    if is_exact(table, shapes, **names):
        return "exact", exact(table, shapes, **names)
    out = intersection(table, shapes, **names)
    if out.isEmpty():
        raise ValueError(f"table and shapes have no id in common; {examples(table, shapes, **names)}")
    return "intersection", out


def examples(table: DataFrame, shapes: DataFrame, t_id: str = "cell_id", s_id: str = "shape_id", n: int = 3, **_: str) -> str:
    """The first ids of either side, for a message."""
    head = lambda d, c: [r[0] for r in d.select(canonical_id(c)).limit(n).collect()]
    return f"the table has {head(table, t_id)}, the shapes have {head(shapes, s_id)}"


def unmatched(table: DataFrame, shapes: DataFrame, t_id: str = "cell_id", s_id: str = "shape_id") -> list[str]:
    """Samples whose table and shapes have no id in common."""
    met = presence(table, shapes, t_id, s_id)
    return [r[0] for r in table.select(SAMPLE).distinct().join(met.select(SAMPLE).distinct(), SAMPLE, "left_anti").orderBy(SAMPLE).collect()]


def align_samples(table: DataFrame, shapes: DataFrame, **names: str) -> tuple[DataFrame, DataFrame]:
    """(modes, alignment) of many samples in one plan: by position in those that are exact, by ids in the others.

    A sample whose sides have no id in common is an error. Samples are told apart once, and each goes one way only.
    """
    found = cut(modes(table, shapes, **names))
    of = small(found.select(SAMPLE, "exact"))  # one row for each sample
    some = lambda d, which: d.join(of.filter(which), SAMPLE, "left_semi")
    by_place = exact(some(table, "exact"), some(shapes, "exact"), **names)
    by_id = intersection(some(table, "not exact"), some(shapes, "not exact"), **names)
    out = by_place.unionByName(by_id)
    # Rows of an exact sample are aligned with themselves: only the others can be without any.
    asked = found.filter("n_table > 0 and not exact")
    lost = asked if asked.isEmpty() else asked.join(by_id.select(SAMPLE).distinct(), SAMPLE, "left_anti")
    if bad := [r[0] for r in lost.orderBy(SAMPLE).limit(5).collect()]:
        one = lambda d: d.filter(F.col(SAMPLE) == bad[0])
        raise ValueError(f"table and shapes have no id in common in {bad}; in the first, {examples(one(table), one(shapes), **names)}")
    return found.select(SAMPLE, F.when(F.col("exact"), "exact").otherwise("intersection").alias("mode"), "n_table", "n_shapes"), out


def _matching(cells: DataFrame, ids: DataFrame, cell_id: str, on: list[str]):
    keys = [canonical_id(F.col(cell_id)) == F.col("__id"), *(F.col(c) == F.col(f"__{c}") for c in on)]
    return ids, reduce(Column.__and__, keys)


def _ids(shapes: DataFrame, shape_id: str, on: list[str]) -> DataFrame:
    return shapes.select(canonical_id(shape_id).alias("__id"), *(F.col(c).alias(f"__{c}") for c in on))


def presence(cells: DataFrame, nuclei: DataFrame, cell_id: str = "cell_id", shape_id: str = "shape_id") -> DataFrame:
    """Cells whose id has a nucleus, of the same sample where both sides have one: a semi-join on ids as strings."""
    on = common_keys(cells, nuclei)
    ids, keys = _matching(cells, _ids(nuclei, shape_id, on), cell_id, on)
    return cells.join(ids, keys, "left_semi")


def presence_counts(cells: DataFrame, nuclei: DataFrame, cell_id: str = "cell_id", shape_id: str = "shape_id") -> DataFrame:
    """(n_in, n_kept, no_nucleus), also where no cell is missing."""
    on = common_keys(cells, nuclei)
    ids, keys = _matching(cells, _ids(nuclei, shape_id, on).distinct().withColumn("__has", F.lit(True)), cell_id, on)
    marked = cells.join(ids, keys, "left")
    return marked.agg(F.count("*").alias("n_in"), F.count_if(F.col("__has").isNotNull()).alias("n_kept"), F.count_if(F.col("__has").isNull()).alias("no_nucleus"))


def require_rows(df: DataFrame, what: str = "no cells overlap") -> DataFrame:
    if df.isEmpty():
        raise ValueError(what)
    return df
