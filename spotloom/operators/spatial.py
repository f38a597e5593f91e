"""Spatial joins on a grid of buckets: shapes meet only where their boxes share a cell.

A nested loop over all pairs never appears: both sides are placed on a grid, or on grids of
several levels where shapes have many sizes, joined on its cells, and rechecked. A crowded place is
a hot key that Spark can split, for neither side is aggregated before the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions.scalars import canonical_id
from ..session import cut
from .align import common_keys, presence, presence_counts


#: Levels of the grid at most: cells of the last are 2 ** LEVELS times as wide as those of the first.
LEVELS = 40


def _level(grid: float) -> Column:
    """The level whose cells are as wide as a box, at least: the first with cells of ``grid``, each next twice as wide."""
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / grid
    return F.when(wide > 1, F.least(F.ceil(F.log2(wide)), F.lit(LEVELS))).otherwise(0).cast("int")


def _size(level: Column, grid: float) -> Column:
    return F.lit(float(grid)) * F.pow(F.lit(2.0), level)


def _placed(boxes: DataFrame, grid: float, others: list[int]) -> DataFrame:
    """The boxes with ``__own``, their level, for each cell (``__level``, ``__gx``, ``__gy``) under them: of their own level and those above that others have.

    At its own level or above, a box lies on four cells at most, however large it is.
    """
    at = lambda v: F.floor(F.col(v) / _size(F.col("__level"), grid)).cast("bigint")
    above = F.filter(F.lit(others).cast("array<int>"), lambda v: v > F.col("__own"))
    out = boxes.withColumn("__own", _level(grid)).withColumn("__level", F.explode(F.concat(F.array("__own"), above)))
    return out.withColumn("__gx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("__gy", F.explode(F.sequence(at("y0"), at("y1"))))


def _rows_of_cells(polygons: DataFrame, grid: float, on: list[str]) -> DataFrame:
    """(__gx, __gy, __sides): the sides of a polygon at the heights of a row of grid cells, for each cell under it.

    Whether a point is inside depends only on the sides at its height, so a grid cell carries those
    of its row of cells, not the whole outline, and a row only as many cells as the outline is wide there.
    """
    at = lambda v: F.floor(v / grid).cast("bigint")
    low, high = lambda e, c: F.least(e["p"][c], e["q"][c]), lambda e, c: F.greatest(e["p"][c], e["q"][c])
    placed = polygons.select(*[F.col(c).alias(f"__{c}") for c in on], G.edges(F.col("rings")).alias("__all"), G.bounds(F.col("rings")).alias("__b"))
    row = lambda gy: F.struct(gy.alias("gy"), F.filter("__all", lambda e: (at(low(e, "y")) <= gy) & (at(high(e, "y")) >= gy)).alias("sides"))
    placed = placed.withColumn("__row", F.explode(F.transform(F.sequence(at(F.col("__b.y0")), at(F.col("__b.y1"))), row)))
    placed = placed.select(*[f"__{c}" for c in on], F.col("__row.gy").alias("__gy"), F.col("__row.sides").alias("__sides")).filter(F.size("__sides") > 0)
    west, east = F.array_min(F.transform("__sides", lambda e: low(e, "x"))), F.array_max(F.transform("__sides", lambda e: high(e, "x")))
    return placed.withColumn("__gx", F.explode(F.sequence(at(west), at(east))))


def inside(points: DataFrame, polygons: DataFrame, grid: float = 256.0, on: list[str] | None = None) -> DataFrame:
    """Points (x, y, ...) inside the union of polygons (rings), not on its outline; ``on``: keys that must be equal, such as the sample.

    A point strictly inside a polygon is inside the union. One on outlines alone is inside if the polygons that
    meet there leave no gap around it, as on the seam of two that touch; for such places, which are few, the faces
    around them are gathered, equal ones once. Copies of a polygon, and points of one place, meet once: the
    work grows with the different ones, and each copy costs a row.
    """
    on = on or []
    at = lambda v: F.floor(v / grid).cast("bigint")
    placed = _rows_of_cells(polygons.select(*on, "rings").distinct(), grid, on)
    x, y, sides = F.col("x"), F.col("y"), F.col("__sides")
    keys = reduce(Column.__and__, [at(x) == F.col("__gx"), at(y) == F.col("__gy"), *(F.col(c) == F.col(f"__{c}") for c in on)])
    # Cut, so that the joins read a plain shuffle of the different places.
    every = cut(points.select(*on, x.cast("double").alias("x"), y.cast("double").alias("y")).distinct())
    places = every.join(placed, keys & G.touches(sides, x, y))
    seams = places.select(*on, "x", "y", G.faces(sides, x, y).alias("__f")).groupBy(*on, "x", "y").agg(F.collect_set("__f").alias("__around"))
    seams = seams.filter(G.surrounded(F.col("__around"))).select(*[F.col(c).alias(f"__{c}") for c in on], at(x).alias("__gx"), at(y).alias("__gy"), F.struct("x", "y").alias("__seam"))
    both = placed.unionByName(seams, allowMissingColumns=True)
    here = F.coalesce((x == F.col("__seam.x")) & (y == F.col("__seam.y")), F.lit(False))
    found = every.join(both, keys & F.when(sides.isNull(), here).otherwise(G.contains(sides, x, y)), "left_semi")
    found = found.select(*[F.col(c).alias(f"__{c}") for c in (*on, "x", "y")])
    same = reduce(Column.__and__, (F.col(c) == F.col(f"__{c}") for c in on), (x.cast("double") == F.col("__x")) & (y.cast("double") == F.col("__y")))
    return points.join(found, same, "left_semi")


def tissue_filter(cells: DataFrame, shapes: DataFrame, polygons: DataFrame, cell_id: str = "cell_id", transform: tuple[float, ...] | None = None, grid: float = 256.0) -> DataFrame:
    """Cells whose shape's centroid is inside the tissue; a cell without a shape is outside.

    ``shapes``: (shape_id, x, y); ``transform``: the six numbers of an affine for the polygons. Samples
    keep apart where all three tables, or two of them, have ``sample_id``.
    """
    polys = polygons if transform is None else polygons.withColumn("rings", G.affine(F.col("rings"), *transform))
    kept = inside(shapes, polys, grid, common_keys(shapes, polys))
    return presence(cells, kept, cell_id, "shape_id")


def tissue_counts(cells: DataFrame, shapes: DataFrame, polygons: DataFrame, cell_id: str = "cell_id", transform: tuple[float, ...] | None = None, grid: float = 256.0) -> DataFrame:
    """(n_in, n_kept, outside_tissue), also where no cell is outside."""
    polys = polygons if transform is None else polygons.withColumn("rings", G.affine(F.col("rings"), *transform))
    kept = inside(shapes, polys, grid, common_keys(shapes, polys))
    return presence_counts(cells, kept, cell_id, "shape_id").withColumnRenamed("no_nucleus", "outside_tissue")


def box_candidates(a: DataFrame, b: DataFrame, grid: float = 64.0, on: list[str] | None = None) -> DataFrame:
    """Pairs whose boxes (x0, y0, x1, y1) touch: columns of ``a``, and of ``b`` with the prefix ``b_``.

    Boxes lie on grids of several levels, each on one whose cells are as wide as itself, so that a giant costs as many
    rows as a small one; two boxes meet on the level of the larger. A pair is reported once, from the cell that
    holds the corner of the boxes' overlap, so no deduplication follows the join. ``grid`` is the width of the
    least cells, and should be near the size of a usual shape.
    """
    on = on or []
    mark = lambda d, side: d.select(F.lit(side).alias("side"), _level(grid).alias("level"))
    levels: dict[str, list[int]] = {"a": [], "b": []}
    for r in mark(a, "a").union(mark(b, "b")).distinct().collect():  # some tens of rows
        levels[r["side"]].append(r["level"])
    left, right = _placed(a, grid, sorted(levels["b"])), _placed(b, grid, sorted(levels["a"]))
    names = ("__own", "__level", "__gx", "__gy")
    right = right.select(*[F.col(c).alias(f"b_{c}") for c in b.columns], *(F.col(c).alias(f"{c}_b") for c in names))
    keys = [*(F.col(c) == F.col(f"{c}_b") for c in names[1:]), *(F.col(c) == F.col(f"b_{c}") for c in on)]
    meet = F.col("__level") == F.greatest("__own", "__own_b")
    touch = (F.col("x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("x1")) & (F.col("y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("y1"))
    size = _size(F.col("__level"), grid)
    corner = lambda c: F.floor(F.greatest(c, f"b_{c}") / size).cast("bigint")
    home = (corner("x0") == F.col("__gx")) & (corner("y0") == F.col("__gy"))
    return left.join(right, reduce(Column.__and__, keys) & meet & touch & home).drop(*names, *(f"{c}_b" for c in names))


def max_iou(cells: DataFrame, others: DataFrame, id_col: str = "cell_id", grid: float = 64.0, on: list[str] | None = None) -> DataFrame:
    """(id, max_iou, n_candidates) of cells with a candidate. Rings, if both sides have them, decide; else the boxes.

    Shapes that are equal meet the others once, with their number, so that copies cost a row each and not a pair.
    """
    on, rings = on or [], "ring" in cells.columns and "ring" in others.columns
    shape = [*on, "x0", "y0", "x1", "y1", *(["ring"] if rings else [])]
    pairs = box_candidates(cells.select(*shape).distinct(), others.groupBy(*shape).agg(F.count("*").alias("__n")), grid, on)
    if rings:
        iou = G.polygon_iou_udf(F.col("ring"), F.col("b_ring"))
    else:
        box = lambda p: {k: F.col(p + k) for k in ("x0", "y0", "x1", "y1")}
        iou = G.box_iou(box(""), box("b_"))
    best = pairs.withColumn("__iou", iou).groupBy(*shape).agg(F.max("__iou").alias("__max"), F.sum("b___n").alias("__n"))
    told = cells.select(id_col, *shape).join(best, shape)
    return told.groupBy(*on, id_col).agg(F.max("__max").alias("max_iou"), F.sum("__n").cast("bigint").alias("n_candidates"))


def overlap_filter(cells: DataFrame, xen: DataFrame, he: DataFrame, threshold: float = 0.5, id_col: str = "cell_id", grid: float = 64.0) -> DataFrame:
    """Cells whose nucleus overlaps one of the other layer by the threshold; without candidates a cell goes."""
    best = max_iou(xen, he, id_col, grid, common_keys(xen, he)).filter(F.col("max_iou") >= threshold)
    return presence(cells, best, id_col, id_col)


def overlap_counts(cells: DataFrame, xen: DataFrame, he: DataFrame, threshold: float = 0.5, id_col: str = "cell_id", grid: float = 64.0) -> DataFrame:
    """(n_in, n_kept, no_nucleus, low_overlap) in one pass over the cells."""
    on, pair = common_keys(cells, xen), common_keys(xen, he)
    named = lambda d, flag: d.select(canonical_id(id_col).alias("__id"), *(F.col(c).alias(f"__{c}") for c in on), flag)
    ids = named(xen, F.lit(0.0).alias("iou"))
    best = named(max_iou(xen, he, id_col, grid, pair), F.col("max_iou").alias("iou"))
    known = ids.unionByName(best).groupBy("__id", *(f"__{c}" for c in on)).agg(F.max("iou").alias("__iou"))
    marked = cells.join(known, reduce(Column.__and__, [canonical_id(F.col(id_col)) == F.col("__id"), *(F.col(c) == F.col(f"__{c}") for c in on)]), "left")
    has, ok = F.col("__iou").isNotNull(), F.coalesce(F.col("__iou") >= threshold, F.lit(False))
    return marked.agg(F.count("*").alias("n_in"), F.count_if(ok).alias("n_kept"), F.count_if(~has).alias("no_nucleus"), F.count_if(has & ~ok).alias("low_overlap"))


def moran_i(points: DataFrame, value: str, radius: float) -> DataFrame:
    """(moran_i, n, pairs): spatial autocorrelation over neighbours within a radius."""
    p = points.select(F.col("x").alias("x"), F.col("y").alias("y"), F.col("id").alias("id"), F.col(value).cast("double").alias("v"))
    mean = p.agg(F.avg("v").alias("m"), F.sum(F.lit(1)).alias("n"), F.var_pop("v").alias("s2"))
    z = p.crossJoin(F.broadcast(mean)).withColumn("z", F.col("v") - F.col("m"))  # one row broadcast
    at = lambda c: F.floor(F.col(c) / radius).cast("bigint")
    a = z.select("id", "x", "y", "z", "n", "s2", F.explode(F.sequence(at("x") - 1, at("x") + 1)).alias("gx"), at("y").alias("__y")).select("*", F.explode(F.sequence(F.col("__y") - 1, F.col("__y") + 1)).alias("gy"))
    b = z.select(F.col("id").alias("jd"), F.col("x").alias("jx"), F.col("y").alias("jy"), F.col("z").alias("jz"), at("x").alias("gx"), at("y").alias("gy"))
    pairs = a.join(b, ["gx", "gy"]).filter((F.col("id") != F.col("jd")) & (F.pow(F.col("x") - F.col("jx"), 2) + F.pow(F.col("y") - F.col("jy"), 2) <= radius * radius))
    return pairs.agg((F.sum(F.col("z") * F.col("jz")) / F.count("*") / F.max("s2")).alias("moran_i"), F.max("n").cast("bigint").alias("n"), F.count("*").alias("pairs"))


def nearest(points: DataFrame, k: int, levels: int = 24) -> DataFrame:
    """(id, neighbour, distance, rank): the k nearest other points of every point (id, x, y), exactly; ties go by id.

    Cells of a grid are halved ``levels`` times. Counts of cells tell for every place the finest level at which the
    three by three cells around it hold k others; only there are points compared, so that dense places are compared
    on fine grids and lonely points on coarse ones. A place whose k-th distance is not within what was searched goes
    on a level above. Points of one place are one place with its k + 1 least ids, so that a crowd in one spot costs no pairs.
    Points without a coordinate or an id have no neighbours and are none.
    """
    p = cut(points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("id IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL"))
    box = p.agg(F.min("x").alias("x"), F.min("y").alias("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("wide"), F.count("*").alias("n")).first()
    kind = p.schema["id"].dataType.simpleString()
    if box.n < 2:
        return p.sparkSession.createDataFrame([], f"id {kind}, neighbour {kind}, distance double, rank int")
    width = (box.wide or 1.0) * (1 + 1e-9) / 2**levels
    first = lambda by: F.row_number().over(Window.partitionBy(*by).orderBy("id"))
    # The least ids of a place: first of parts of it, then of what these leave.
    dealt = p.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    some = dealt.withColumn("k", first(("x", "y", "part"))).filter(F.col("k") <= k + 1)
    ids = some.groupBy("x", "y").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    at = lambda c: F.floor((F.col(c) - getattr(box, c)) / width).cast("bigint")
    places = cut(ids.join(p.groupBy("x", "y").agg(F.count("*").alias("m")), ["x", "y"]).withColumns({"cx": at("x"), "cy": at("y")}))
    up = lambda c: F.expr(f"shiftright({c}, level)")  # noqa: E731  a cell's number on a level
    around = lambda d: d.withColumn("gx", F.explode(F.sequence(F.col("gx") - 1, F.col("gx") + 1))).withColumn("gy", F.explode(F.sequence(F.col("gy") - 1, F.col("gy") + 1)))
    cells = places.groupBy("cx", "cy").agg(F.sum("m").alias("m")).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    placed = cells.withColumns({"gx": up("cx"), "gy": up("cy")})
    enough = around(placed.groupBy("level", "gx", "gy").agg(F.sum("m").alias("m"))).groupBy("level", "gx", "gy").agg(F.sum("m").alias("m")).filter(F.col("m") > k)
    finest = placed.join(enough.select("level", "gx", "gy"), ["level", "gx", "gy"]).groupBy("cx", "cy").agg(F.min("level").alias("level"))
    active = cut(places.join(finest, ["cx", "cy"], "left").withColumn("level", F.coalesce("level", F.lit(levels))).select("x", "y", "cx", "cy", "level"))
    found = []
    while used := [r[0] for r in active.select("level").distinct().collect()]:  # at most one for each level
        asks = around(active.withColumns({"gx": up("cx"), "gy": up("cy")}))
        has = places.select(F.col("x").alias("ox"), F.col("y").alias("oy"), "ids", "cx", "cy", F.explode(F.lit(used).cast("array<int>")).alias("level")).select("ox", "oy", "ids", "level", up("cx").alias("gx"), up("cy").alias("gy"))
        far = F.sqrt((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
        pairs = asks.join(has, ["level", "gx", "gy"]).select("x", "y", "cx", "cy", "level", far.alias("d"), F.explode("ids").alias("other"))
        top = pairs.groupBy("x", "y", "cx", "cy", "level").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "other"))), 1, k + 1).alias("top"))
        size = F.lit(width) * F.pow(F.lit(2.0), "level")
        edge = lambda c, g: F.least(F.col(c) - getattr(box, c) - (up(g) - 1) * size, (up(g) + 2) * size - (F.col(c) - getattr(box, c)))  # noqa: E731,B023
        within = (F.size("top") > k) & (F.element_at("top", -1)["d"] < F.least(edge("x", "cx"), edge("y", "cy")))
        told = cut(top.withColumn("safe", within | (F.col("level") >= levels)))
        found.append(told.filter("safe").select("x", "y", "top"))
        active = told.filter("NOT safe").select("x", "y", "cx", "cy", (F.col("level") + 1).alias("level"))
    near = p.join(reduce(DataFrame.unionByName, found), ["x", "y"])
    others = F.slice(F.filter("top", lambda t: t["other"] != F.col("id")), 1, k)
    return near.select("id", F.posexplode(others).alias("at", "t")).select("id", F.col("t.other").alias("neighbour"), F.col("t.d").alias("distance"), (F.col("at") + 1).cast("int").alias("rank"))
