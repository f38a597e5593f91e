"""Points, rings and rectangles as column expressions, and polygon overlap in numpy.

A ring is array<struct<x:double,y:double>>, closed or not; a polygon is an array of rings,
the first around it and the others its holes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A rectangle as a polygon."""
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)))


def affine(polygon: Column, a: float, b: float, d: float, e: float, xoff: float, yoff: float) -> Column:
    """x' = a x + b y + xoff, y' = d x + e y + yoff for every vertex."""
    one = lambda p: F.struct((F.lit(a) * p["x"] + F.lit(b) * p["y"] + F.lit(xoff)).alias("x"), (F.lit(d) * p["x"] + F.lit(e) * p["y"] + F.lit(yoff)).alias("y"))
    return F.transform(polygon, lambda ring: F.transform(ring, one))


def edges(polygon: Column) -> Column:
    """array<struct<p,q>> of all sides of all rings."""

    def ring_edges(ring: Column) -> Column:
        turned = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, F.lit(1), F.lit(1)))
        return F.zip_with(ring, turned, lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    return F.flatten(F.transform(polygon, ring_edges))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether a side crosses the ray from a point to the right, just above the point's height."""
    (px, py), (qx, qy) = (e["p"]["x"], e["p"]["y"]), (e["q"]["x"], e["q"]["y"])
    return F.coalesce(((py > y) != (qy > y)) & (x < (qx - px) * (y - py) / F.when(qy == py, F.lit(None)).otherwise(qy - py) + px), F.lit(False))


def _on(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is on a side."""
    (px, py), (qx, qy) = (e["p"]["x"], e["p"]["y"]), (e["q"]["x"], e["q"]["y"])
    line = (qx - px) * (y - py) - (qy - py) * (x - px) == 0
    return line & (x >= F.least(px, qx)) & (x <= F.greatest(px, qx)) & (y >= F.least(py, qy)) & (y <= F.greatest(py, qy))


def touches(sides: Column, x: Column, y: Column) -> Column:
    """Whether a point is on any side."""
    return F.exists(sides, lambda e: _on(e, x, y))


def contains(sides: Column, x: Column, y: Column) -> Column:
    """Whether a point is strictly inside: even-odd crossings, and not on a side."""
    odd = F.size(F.filter(sides, lambda e: _crosses(e, x, y))) % 2 == 1
    return odd & ~touches(sides, x, y)


#: Angles nearer than this are one: sides along one line, of other lengths.
SLIVER = 1e-9


def faces(sides: Column, x: Column, y: Column) -> Column:
    """What a polygon looks like close to a point on its outline: struct(inside, rays).

    ``rays``: the angles, from 0 to a whole turn, at which its sides leave the point, and ``inside``: whether the face
    just beyond the angle 0 is inside. Going round, each ray changes sides.
    """
    away = lambda c: F.when((c["x"] != x) | (c["y"] != y), F.atan2(c["y"] - y, c["x"] - x))
    rays = F.array_compact(F.flatten(F.transform(F.filter(sides, lambda e: _on(e, x, y)), lambda e: F.array(away(e["p"]), away(e["q"])))))
    turned = F.array_sort(F.transform(rays, lambda a: F.when(a < 0, a + 2 * math.pi).otherwise(a)))
    # Seen from a point a little to the right and much less above, the sides that touch are all on the left.
    odd = F.size(F.filter(sides, lambda e: ~_on(e, x, y) & _crosses(e, x, y))) % 2 == 1
    return F.struct(odd.alias("inside"), turned.alias("rays"))


def surrounded(around: Column) -> Column:
    """Whether polygons that meet at a point, as ``faces`` of them, leave no gap around it: then it is inside their union."""
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(2 * math.pi)), F.flatten(F.transform(around, lambda f: f["rays"])))))
    gaps = F.filter(F.transform(cuts, lambda a, k: F.struct(a.alias("a"), F.get(cuts, k + 1).alias("b"))), lambda g: g["b"] - g["a"] > SLIVER)
    changes = lambda f, at: F.size(F.filter(f["rays"], lambda r: (r > 0) & (r < at))) % 2 == 1
    within = lambda f, at: f["inside"] != changes(f, at)
    return F.forall(gaps, lambda g: F.exists(around, lambda f: within(f, (g["a"] + g["b"]) / 2)))


def bounds(polygon: Column) -> Column:
    """struct(x0, y0, x1, y1) around the first ring."""
    xs, ys = F.transform(polygon[0], lambda p: p["x"]), F.transform(polygon[0], lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def centroid(polygon: Column) -> Column:
    """Area centroid of the first ring; of a ring without area, its vertices' mean."""

    def add(acc: Column, e: Column) -> Column:
        (px, py), (qx, qy) = (e["p"]["x"], e["p"]["y"]), (e["q"]["x"], e["q"]["y"])
        cross = px * qy - qx * py
        return F.struct((acc["a"] + cross).alias("a"), (acc["x"] + (px + qx) * cross).alias("x"), (acc["y"] + (py + qy) * cross).alias("y"))

    zero = F.lit(0.0)
    s = F.aggregate(edges(F.slice(polygon, 1, 1)), F.struct(zero.alias("a"), zero.alias("x"), zero.alias("y")), add)
    mean = lambda c: F.aggregate(polygon[0], zero, lambda t, p: t + p[c]) / F.size(polygon[0])
    return F.struct(F.when(s["a"] == 0, mean("x")).otherwise(s["x"] / (3 * s["a"])).alias("x"), F.when(s["a"] == 0, mean("y")).otherwise(s["y"] / (3 * s["a"])).alias("y"))


def box_iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two rectangles with the keys x0, y0, x1, y1; empty over empty is 0."""
    w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def _area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def _crossings(ring: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The x at which a ring crosses each height, sorted; infinite where a height has fewer crossings than another."""
    p, q = ring, np.roll(ring, -1, 0)
    cut = (p[:, 1] > y[:, None]) != (q[:, 1] > y[:, None])
    rise = np.where(q[:, 1] == p[:, 1], 1.0, q[:, 1] - p[:, 1])
    x = np.where(cut, p[:, 0] + (y[:, None] - p[:, 1]) * (q[:, 0] - p[:, 0]) / rise, np.inf)
    return np.sort(x, 1)[:, : max(2, int(cut.sum(1).max(initial=0)))]


def overlap_area(a: np.ndarray, b: np.ndarray) -> float:
    """Common area of two simple polygons, convex or not.

    Between two heights with no vertex and no crossing of sides between them, the common width is a
    linear function of the height, so that its value in the middle gives the area exactly.
    """
    low, high = max(a[:, 1].min(), b[:, 1].min()), min(a[:, 1].max(), b[:, 1].max())
    if high <= low or max(a[:, 0].min(), b[:, 0].min()) >= min(a[:, 0].max(), b[:, 0].max()):
        return 0.0
    u, v = np.roll(a, -1, 0) - a, np.roll(b, -1, 0) - b
    cross = u[:, None, 0] * v[None, :, 1] - u[:, None, 1] * v[None, :, 0]
    gap = b[None, :] - a[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = (gap[..., 0] * v[None, :, 1] - gap[..., 1] * v[None, :, 0]) / cross
        meets = a[:, None, 1] + s * u[:, None, 1]
    heights = np.concatenate((a[:, 1], b[:, 1], meets[(s >= 0) & (s <= 1) & np.isfinite(meets)], [low, high]))
    heights = np.unique(heights[(heights >= low) & (heights <= high)])
    mid, thick = (heights[1:] + heights[:-1]) / 2, np.diff(heights)
    xa, xb = _crossings(a, mid), _crossings(b, mid)
    width = np.zeros(len(mid))
    for i in range(0, xa.shape[1] - 1, 2):
        for j in range(0, xb.shape[1] - 1, 2):
            left, right = np.maximum(xa[:, i], xb[:, j]), np.minimum(xa[:, i + 1], xb[:, j + 1])
            both = np.isfinite(left) & np.isfinite(right)
            width[both] += np.maximum(right[both] - left[both], 0)
    return float((width * thick).sum())


def polygon_iou(a: np.ndarray, b: np.ndarray) -> float:
    common = overlap_area(a, b)
    union = abs(_area(a)) + abs(_area(b)) - common
    return common / union if union > 0 else 0.0


@F.pandas_udf(T.DoubleType())
def polygon_iou_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Overlap of two rings; for shapes that aren't rectangles."""
    ring = lambda r: np.array([(p["x"], p["y"]) for p in r], float).reshape(-1, 2)
    return pd.Series([polygon_iou(ring(p), ring(q)) for p, q in zip(a, b, strict=True)])
