"""The union of tissue polygons, candidates of any size, and neighbours, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from spotloom.operators import metrics, spatial

RING = "array<array<struct<x:double,y:double>>>"


def polygons(spark, shapes, sample=None):
    rows = [([[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings], s) for rings, s in zip(shapes, sample or ["s"] * len(shapes), strict=True)]
    return spark.createDataFrame(rows, f"rings {RING}, sample_id string")


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def points(spark, xy, sample="s"):
    return spark.createDataFrame([(float(x), float(y), sample) for x, y in xy], "x double, y double, sample_id string")


def kept(p, shapes, grid=8.0, on=None):
    return {(r.x, r.y) for r in spatial.inside(p, shapes, grid, on).collect()}


@pytest.mark.parametrize("grid", [3.0, 8.0, 100.0])
def test_seams_are_inside_the_union(spark, grid):
    both = polygons(spark, [[box(0, 0, 10, 10)], [box(10, 0, 20, 10)]])
    p = points(spark, [(10, 5), (10, 0), (10, 10), (5, 5), (0, 5), (20, 5), (10, 0.25)])
    assert kept(p, both, grid) == {(10, 5), (5, 5), (10, 0.25)}
    # Three of four boxes leave a corner open; the fourth, or one of another extent, closes it.
    corner = [[box(0, 0, 10, 10)], [box(10, 0, 20, 10)], [box(0, 10, 10, 20)]]
    assert kept(points(spark, [(10, 10)]), polygons(spark, corner), grid) == set()
    assert kept(points(spark, [(10, 10)]), polygons(spark, [*corner, [box(10, 10, 13, 11)]]), grid) == {(10, 10)}
    # Sides of other lengths along one line, and a diagonal seam.
    shift = polygons(spark, [[box(0, 0, 10, 7)], [box(10, 3, 20, 12)]])
    assert kept(points(spark, [(10, 5), (10, 3), (10, 7), (10, 2), (10, 9)]), shift, grid) == {(10, 5)}
    halves = polygons(spark, [[[(0, 0), (10, 0), (10, 10)]], [[(0, 0), (10, 10), (0, 10)]]])
    assert kept(points(spark, [(3, 3), (7, 7), (0, 0), (10, 10), (2, 5)]), halves, grid) == {(3, 3), (7, 7), (2, 5)}
    # A hole that another polygon fills, and one that stays.
    ring = [box(0, 0, 30, 30), box(10, 10, 20, 20)]
    p = points(spark, [(10, 15), (10, 10), (15, 15), (20, 20), (5, 5)])
    assert kept(p, polygons(spark, [ring]), grid) == {(5, 5)}
    assert kept(p, polygons(spark, [ring, [box(10, 10, 20, 20)]]), grid) == {(10, 15), (10, 10), (15, 15), (20, 20), (5, 5)}
    # Copies of a polygon have no seam; samples keep apart.
    assert kept(points(spark, [(10, 5), (5, 5)]), polygons(spark, [[box(0, 0, 10, 10)]] * 3), grid) == {(5, 5)}
    apart = polygons(spark, [[box(0, 0, 10, 10)], [box(10, 0, 20, 10)]], ["s", "t"])
    assert kept(points(spark, [(10, 5), (5, 5)]), apart, grid, ["sample_id"]) == {(5, 5)}


def test_union_of_random_boxes_against_quarters(spark):
    r = random.Random(2)
    for _ in range(3):
        boxes = []
        for _ in range(25):
            x, y = r.randrange(20), r.randrange(20)
            boxes.append((x, y, x + r.randrange(1, 6), y + r.randrange(1, 6)))
        covered = lambda x, y: any(a < x < c and b < y < d for a, b, c, d in boxes)  # noqa: E731,B023
        every = [(x / 2, y / 2) for x in range(-1, 52) for y in range(-1, 52)]
        expected = {(x, y) for x, y in every if all(covered(x + i, y + j) for i in (-0.25, 0.25) for j in (-0.25, 0.25))}
        twice = points(spark, every + every)
        got = spatial.inside(twice, polygons(spark, [[box(*b)] for b in boxes]), 4.0).collect()
        assert len(got) == 2 * len(expected) and {(p.x, p.y) for p in got} == expected


def test_tissue_filter_keeps_cells_on_seams(spark):
    shapes = points(spark, [(10, 5), (10, 10), (25, 5)]).withColumn("shape_id", F.concat(F.lit("c"), F.col("x").cast("int").cast("string"), F.lit("-"), F.col("y").cast("int").cast("string")))
    cells = shapes.select("sample_id", F.col("shape_id").alias("cell_id"))
    both = polygons(spark, [[box(0, 0, 10, 10)], [box(10, 0, 20, 10)]])
    assert [r.cell_id for r in spatial.tissue_filter(cells, shapes, both).collect()] == ["c10-5"]
    assert spatial.tissue_counts(cells, shapes, both).first().asDict() == {"n_in": 3, "n_kept": 1, "outside_tissue": 2}


# Candidates of boxes of any size.


def boxes_of(spark, rows, name):
    return spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], f"{name} bigint, x0 double, y0 double, x1 double, y1 double")


def touching(a, b):
    return {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]}


def test_candidates_of_mixed_sizes(spark):
    r = random.Random(4)
    one = lambda w: (lambda x, y: (x, y, x + r.uniform(0, w), y + r.uniform(0, w)))(r.uniform(-500, 500), r.uniform(-500, 500))
    a = [one(10) for _ in range(300)] + [one(200) for _ in range(20)] + [(-600, -600, 600, 600), (0, 0, 0, 0), (64, 64, 128, 128)]
    b = [one(10) for _ in range(300)] + [one(900) for _ in range(5)] + [(0, 0, 0, 0), (128, 128, 129, 129), (-1e9, -1e9, 1e9, 1e9)]
    for grid in (1.0, 16.0, 64.0):
        got = [(x.i, x.b_j) for x in spatial.box_candidates(boxes_of(spark, a, "i"), boxes_of(spark, b, "j"), grid).collect()]
        assert len(got) == len(set(got)) and set(got) == touching(a, b)


def test_a_giant_costs_as_many_rows_as_a_small_shape(spark):
    giant = boxes_of(spark, [(0, 0, 1_000_000, 900_000)], "i")
    small = boxes_of(spark, [(5.0 * k, 5.0 * k, 5.0 * k + 3, 5.0 * k + 3) for k in range(200)], "j")
    assert spatial._placed(giant, 64.0, [0]).count() <= 4
    levels = [r[0] for r in giant.select(spatial._level(64.0)).collect()]
    assert spatial._placed(small, 64.0, levels).count() <= 200 * 8
    assert spatial.box_candidates(giant, small, 64.0).count() == 200
    plan = spatial.box_candidates(giant, small, 64.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "NestedLoop" not in plan


# Nearest neighbours.


def by_force(rows, k):
    out = set()
    for i, x, y in rows:
        far = sorted((((x - u) ** 2 + (y - v) ** 2) ** 0.5, j) for j, u, v in rows if j != i)[:k]
        out |= {(i, j, n) for n, (_, j) in enumerate(far, 1)}
    return out


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_with_uneven_density(spark, k):
    r = random.Random(8)
    xy = [(r.random(), r.random()) for _ in range(150)] + [(5 + r.random() * 1e-6, 5 + r.random() * 1e-6) for _ in range(120)]
    xy += [(3.0, 3.0)] * 40 + [(3.0, 3.0 + 1e-5)] * 3 + [(1e4, -1e4), (1e4, -1e4 + 50), (-777.0, 0.0)] + [(float(x), float(y)) for x in range(20, 26) for y in range(6)]
    rows = [(i, *p) for i, p in enumerate(xy)]
    r.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0), (9999, None, 2.0)], "id bigint, x double, y double")
    got = spatial.nearest(df, k).collect()
    assert {(e.id, e.neighbour, e["rank"]) for e in got} == by_force(rows, k) and len(got) == len(rows) * k
    at = {i: (x, y) for i, x, y in rows}
    assert all(abs(e.distance - ((at[e.id][0] - at[e.neighbour][0]) ** 2 + (at[e.id][1] - at[e.neighbour][1]) ** 2) ** 0.5) < 1e-9 for e in got)


def test_nearest_of_few_points(spark):
    of = lambda rows: spark.createDataFrame(rows, "id bigint, x double, y double")
    assert spatial.nearest(of([]), 3).collect() == [] and spatial.nearest(of([(1, 0.0, 0.0)]), 3).collect() == []
    assert {(e.id, e.neighbour) for e in spatial.nearest(of([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 9.0, 0.0)]), 7).collect()} == {(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)}


# Copies: the joins see different shapes alone.


def test_copies_of_points_and_polygons_meet_once(spark, monkeypatch):
    seen, own = [], spatial._rows_of_cells
    monkeypatch.setattr(spatial, "_rows_of_cells", lambda p, *more: seen.append(p.count()) or own(p, *more))
    shapes = polygons(spark, [[box(0, 0, 10, 10)], [box(10, 0, 20, 10)]] * 150)
    p = points(spark, [(10, 5), (5, 5), (25, 5), (0, 5)] * 200)
    got = [(r.x, r.y) for r in spatial.inside(p, shapes, 8.0).collect()]
    assert seen == [2] and sorted(got) == [(5, 5)] * 200 + [(10, 5)] * 200


def test_copies_of_boxes_and_rings_meet_once(spark, monkeypatch):
    seen, own = [], spatial.box_candidates

    def candidates(*args):
        pairs = own(*args)
        seen.append(pairs.count())
        return pairs

    monkeypatch.setattr(spatial, "box_candidates", candidates)
    a = boxes_of(spark, [(0, 0, 10, 10), (100, 0, 110, 10)] * 100, "cell_id")
    b = boxes_of(spark, [(5, 0, 15, 10), (0, 0, 10, 10), (500, 0, 510, 10)] * 100, "he_id")
    ring = lambda d: d.withColumn("ring", F.array(*(F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))))
    for one, two in ((a, b), (ring(a), ring(b))):
        got = spatial.max_iou(one, two).collect()
        assert sorted((r.cell_id, r.max_iou, r.n_candidates) for r in got) == [(k, 1.0, 200) for k in range(0, 200, 2)]
    assert seen == [2, 2]


def test_neighbours_count_points_of_one_place_without_pairs(spark):
    r = random.Random(5)
    xy = [(r.randrange(12), r.randrange(12)) for _ in range(60)] * 4 + [(30, 30)] * 300
    rows = [(k if k % 50 else 7, float(x), float(y)) for k, (x, y) in enumerate(xy)]
    expected = {}
    for i, x, y in rows:
        expected[i] = expected.get(i, 0) + sum(j != i and (x - u) ** 2 + (y - v) ** 2 <= 9 for j, u, v in rows)
    found = metrics.neighbours(spark.createDataFrame([*rows, (None, 1.0, 1.0), (9999, None, 2.0)], "id bigint, x double, y double"), 3.0)
    got = [(e.id, e.n_neighbours) for e in found.collect()]
    assert sorted(got, key=str) == sorted([(i, expected[i]) for i, _, _ in rows] + [(None, 0), (9999, 0)], key=str)
    crowd = spark.range(30_000).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    assert {e.n_neighbours for e in metrics.neighbours(crowd, 3.0).collect()} == {29_999}
