"""Queries over the driver's tables and their SQL equivalents."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import geometry as G
from .functions import scalars as S
from .functions import sparse
from .operators import align, figures, filters, genes, manifest, metrics, spatial, splits
from .plans import planner
from .session import checkpoint_dir, read_table
from .sources import catalog, chunked, shards
from .views import TABLES, oracle, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "q_filter_report"

#: The fixture's slide: pixels of the image and of a patch.
SIZE, BASE = 1000.0, 100.0
SEED, TASK = 42, "expression"


def query(sql: str | None = None, *views: str):
    """Register a function under its name, with DuckDB SQL over views."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = oracle(sql, *views)
        return f

    return put


def _cells(spark, sf):
    return view(spark, sf, "cells_v")


def _masked(spark, sf):
    return filters.with_masks(_cells(spark, sf), SIZE, SIZE, BASE)


# The masks in SQL, over cells_v.
POS = "x_px > 0 AND y_px > 0"
OOB = "(x_px - 50 + 100 <= 0 OR x_px - 50 >= 1000 OR y_px - 50 + 100 <= 0 OR y_px - 50 >= 1000)"
PAD = f"((x_px - 50 < 0 OR y_px - 50 < 0 OR x_px - 50 + 100 > 1000 OR y_px - 50 + 100 > 1000) AND NOT {OOB})"


@query("SELECT cell_id, pos FROM cells_v", "cells_v")
def q_ids_cast(spark, sf):
    return S.with_cell_ids(read_table(spark, sf, "part").withColumnRenamed("p_partkey", "pos").withColumn("cell_id", F.col("pos"))).select("cell_id", "pos")


GRID = "(SELECT p, t, a FROM (VALUES (224), (256), (512)) AS x(p) CROSS JOIN (VALUES (0.25), (0.5), (0.75), (1.0)) AS y(t) CROSS JOIN (VALUES (0.2125), (0.425), (0.5)) AS z(a))"


@query(
    f"""
    SELECT CAST(p AS BIGINT) AS patch, CAST(t AS DOUBLE) AS mpp_target, CAST(a AS DOUBLE) AS mpp,
           CAST(round_even(CAST(p AS DOUBLE) * CAST(t AS DOUBLE) / CAST(a AS DOUBLE), 0) AS BIGINT) AS base_size,
           round_even(CAST(p AS DOUBLE) * CAST(t AS DOUBLE) / CAST(a AS DOUBLE), 0) / 2.0 AS half
    FROM {GRID}
    """
)
def q_base_size(spark, sf):
    d = spark.sql(f"SELECT CAST(p AS BIGINT) AS patch, CAST(t AS DOUBLE) AS mpp_target, CAST(a AS DOUBLE) AS a FROM {GRID}")
    # An affine without turn: the scale along both axes is its mpp.
    d = d.withColumn("mpp", S.slide_mpp(F.col("a"), F.lit(0.0), F.lit(0.0), F.col("a"), F.lit(1.0), F.lit(1.0)))
    base = S.base_size(F.col("patch").cast("double"), F.col("mpp_target"), F.col("mpp"))
    return d.select("patch", "mpp_target", "mpp", base.alias("base_size"), (base.cast("double") / 2.0).alias("half"))


@query("SELECT cell_id, x_px - 50.0 AS sx0, y_px - 50.0 AS sy0 FROM cells_v", "cells_v")
def q_tile_origin(spark, sf):
    b = F.lit(100)
    return _cells(spark, sf).select("cell_id", S.tile_origin(F.col("x_px"), b).alias("sx0"), S.tile_origin(F.col("y_px"), b).alias("sy0"))


@query("SELECT cell_id, CAST(floor(greatest(0.0, y_px * 20 - 50) / 4096) * 10000 + floor(greatest(0.0, x_px * 20 - 50) / 4096) AS BIGINT) AS tile_key FROM cells_v", "cells_v")
def q_tile_key(spark, sf):
    at = lambda c: F.col(c) * 20 - 50
    return _cells(spark, sf).select("cell_id", S.tile_key(at("x_px"), at("y_px")).alias("tile_key"))


@query("SELECT printf('%07d', o_orderkey) AS sample_key, printf('%09d', o_orderkey) AS global_key, 'shard-' || printf('%06d', o_orderkey // 500) || '.tar' AS shard FROM orders")
def q_padded_keys(spark, sf):
    k = F.col("o_orderkey")
    return read_table(spark, sf, "orders").select(S.padded(k, 7).alias("sample_key"), S.padded(k, 9).alias("global_key"), S.shard_name(F.floor(k / 500)).alias("shard"))


@query("SELECT page_id, regexp_extract(url, '([^/]+?)(?:\\.[^./]*)?/*$', 1) AS sample_id FROM pages")
def q_sample_ids(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", S.sample_id_of(F.col("url")).alias("sample_id"))


@query(f"SELECT cell_id FROM cells_v WHERE {POS}", "cells_v")
def q_positive_centroid(spark, sf):
    return _cells(spark, sf).filter(filters.positive_centroid(F.col("x_px"), F.col("y_px"))).select("cell_id")


@query(f"SELECT cell_id FROM cells_v WHERE {OOB}", "cells_v")
def q_full_oob(spark, sf):
    return _masked(spark, sf).filter("full_oob").select("cell_id")


@query(f"SELECT cell_id FROM cells_v WHERE {PAD}", "cells_v")
def q_need_pad(spark, sf):
    return _masked(spark, sf).filter("need_pad").select("cell_id")


@query(f"SELECT cell_id FROM cells_v WHERE {POS} AND NOT {OOB} AND NOT {PAD}", "cells_v")
def q_strict(spark, sf):
    return filters.survivors(_masked(spark, sf), "auto").select("cell_id")


@query(f"SELECT cell_id FROM cells_v WHERE {POS} AND NOT {OOB}", "cells_v")
def q_minimal(spark, sf):
    return filters.survivors(_masked(spark, sf), "minimal").select("cell_id")


@query(
    f"""
    SELECT count(*) AS n_source, count(*) AS n_aligned, CAST(count_if({POS}) AS BIGINT) AS n_positive,
           CAST(count_if({POS} AND NOT {OOB} AND NOT {PAD}) AS BIGINT) AS n_out,
           CAST(count_if(NOT ({POS})) AS BIGINT) AS drop_non_positive_centroid,
           CAST(count_if({OOB}) AS BIGINT) AS drop_full_oob, CAST(count_if({PAD}) AS BIGINT) AS drop_need_pad
    FROM cells_v
    """,
    "cells_v",
)
def q_filter_report(spark, sf):
    masked = _masked(spark, sf).withColumn("__n", F.lit(1))
    return filters.filter_report(masked, F.lit(0)).withColumn("n_source", F.col("n_aligned"))


@query(f"SELECT CAST(count_if({OOB}) AS BIGINT) AS full_oob, CAST(count_if({PAD}) AS BIGINT) AS need_pad FROM cells_v", "cells_v")
def q_policy_counts(spark, sf):
    return filters.policy_counts(_masked(spark, sf), "strict_no_padding")


@query("SELECT cell_id, CAST(trunc((x_px * 7 - 350) / 4.0) AS INTEGER) AS crop_x, CAST(trunc((y_px * 7 - 350) / 4.0) AS INTEGER) AS crop_y FROM cells_v", "cells_v")
def q_crop_start(spark, sf):
    ds = S.downsample(F.lit(28000.0), F.lit(7000.0))
    return _cells(spark, sf).select("cell_id", S.crop_start(F.col("x_px") * 7 - 350, ds).alias("crop_x"), S.crop_start(F.col("y_px") * 7 - 350, ds).alias("crop_y"))


# Alignment.


@query("SELECT pos AS row_pos, pos AS table_pos, pos AS shape_pos, cell_id FROM cells_v", "cells_v")
def q_align_exact(spark, sf):
    cells = _cells(spark, sf)
    return align.exact(cells, cells.withColumnRenamed("cell_id", "shape_id"))


SHAPES = "(SELECT shape_id, row_number() OVER (ORDER BY shape_id) AS pos FROM nucleus_ids_v)"


@query(f"SELECT c.pos AS row_pos, c.pos AS table_pos, s.pos AS shape_pos, c.cell_id FROM cells_v c JOIN {SHAPES} s ON c.cell_id = s.shape_id", "cells_v", "nucleus_ids_v")
def q_align_intersection(spark, sf):
    ids = view(spark, sf, "nucleus_ids_v")
    placed = spark.sql("SELECT shape_id, CAST(row_number() OVER (ORDER BY shape_id) AS BIGINT) AS pos FROM {ids}", ids=ids)
    return align.intersection(_cells(spark, sf), placed)


LINES = "SELECT CAST(l_partkey AS STRING) AS cell_id, CAST(l_orderkey * 100 + l_suppkey % 100 AS BIGINT) AS pos FROM lineitem WHERE l_linenumber = 1"


@query(
    f"""
    , t AS ({LINES}), s AS (SELECT CAST(l_partkey AS STRING) AS id, CAST(l_orderkey AS BIGINT) AS pos FROM lineitem WHERE l_linenumber = 2)
    SELECT t.pos AS row_pos, a.p AS table_pos, b.p AS shape_pos, t.cell_id
    FROM t JOIN (SELECT cell_id, max(pos) AS p FROM t GROUP BY 1) a ON t.cell_id = a.cell_id
           JOIN (SELECT id, max(pos) AS p FROM s GROUP BY 1) b ON t.cell_id = b.id
    """,
    "cells_v",
)
def q_align_dups_last(spark, sf):
    items = read_table(spark, sf, "lineitem")
    t = spark.sql(LINES.replace("FROM lineitem", "FROM {items}"), items=items)
    s = items.filter("l_linenumber = 2").select(F.col("l_partkey").alias("shape_id"), F.col("l_orderkey").alias("pos"))
    return align.intersection(t, s)


@query("SELECT cell_id FROM cells_v WHERE EXISTS (SELECT 1 FROM nucleus_ids_v WHERE shape_id = cell_id)", "cells_v", "nucleus_ids_v")
def q_nucleus_presence(spark, sf):
    return align.presence(_cells(spark, sf), view(spark, sf, "nucleus_ids_v")).select("cell_id")


@query(
    "SELECT count(*) AS n_in, count(shape_id) AS n_kept, CAST(count_if(shape_id IS NULL) AS BIGINT) AS no_nucleus FROM cells_v LEFT JOIN nucleus_ids_v ON shape_id = cell_id",
    "cells_v",
    "nucleus_ids_v",
)
def q_nucleus_presence_counts(spark, sf):
    return align.presence_counts(_cells(spark, sf), view(spark, sf, "nucleus_ids_v"))


# Tissue and overlap.


def _points(spark, sf):
    return _cells(spark, sf).select("cell_id", F.col("x_px").alias("x"), F.col("y_px").alias("y"))


def _tissue(spark, sf, name="tissue_v"):
    b = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    return view(spark, sf, name).select("poly_id", G.box(*b).alias("rings"))


INSIDE = "SELECT cell_id FROM cells_v WHERE EXISTS (SELECT 1 FROM tissue_v WHERE x_px > {0} AND x_px < {1} AND y_px > {2} AND y_px < {3})"


@query(INSIDE.format("x0", "x1", "y0", "y1"), "cells_v", "tissue_v")
def q_tissue_rect(spark, sf):
    return spatial.inside(_points(spark, sf), _tissue(spark, sf), grid=4096.0).select("cell_id")


@query(INSIDE.format("x0", "x1", "y0", "y1"), "cells_v", "tissue_v")
def q_tissue_bucketed(spark, sf):
    return spatial.inside(_points(spark, sf), _tissue(spark, sf), grid=100.0).select("cell_id")


@query(INSIDE.replace("tissue_v", "tissues_v").format("x0", "x1", "y0", "y1"), "cells_v", "tissues_v")
def q_tissue_all(spark, sf):
    """The shapes of all suppliers, so that cells of the grid are crowded."""
    return spatial.inside(_points(spark, sf), _tissue(spark, sf, "tissues_v"), grid=100.0).select("cell_id")


@query(
    """
    , p AS (SELECT p_partkey AS id, p_size * 20 AS x, p_partkey % 66 * 10 AS y FROM part),
      c AS (SELECT id, x + dx AS x, y + dy AS y FROM p, (VALUES (-1, -1), (-1, 1), (1, -1), (1, 1)) AS v(dx, dy)),
      t AS (SELECT id, EXISTS (SELECT 1 FROM seams_v s WHERE c.x > x0 AND c.x < x1 AND c.y > y0 AND c.y < y1
                               AND NOT (hole AND c.x > x0 + 20 AND c.x < x0 + 80 AND c.y > y0 + 20 AND c.y < y0 + 40)) AS covered FROM c)
    SELECT id FROM t GROUP BY id HAVING bool_and(covered)
    """,
    "seams_v",
)
def q_tissue_union(spark, sf):
    """Points inside the union of boxes that touch, overlap and have holes; in SQL, those whose four quarters are all covered."""
    x, y = F.col("x0"), F.col("y0")
    outer, inner = G.box(x, y, F.col("x1"), F.col("y1")), G.box(x + 20, y + 20, x + 80, y + 40)
    polygons = view(spark, sf, "seams_v").select(F.when(F.col("hole"), F.concat(outer, inner)).otherwise(outer).alias("rings"))
    points = read_table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 20).cast("double").alias("x"), (F.col("p_partkey") % 66 * 10).cast("double").alias("y"))
    return spatial.inside(points, polygons, grid=100.0).select("id")


@query(INSIDE.format("x0 * 2 + 10", "x1 * 2 + 10", "y0 * 2 - 20", "y1 * 2 - 20"), "cells_v", "tissue_v")
def q_tissue_affine(spark, sf):
    shapes = _points(spark, sf).withColumnRenamed("cell_id", "shape_id")
    return spatial.tissue_filter(_cells(spark, sf), shapes, _tissue(spark, sf), transform=(2.0, 0.0, 0.0, 2.0, 10.0, -20.0)).select("cell_id")


IOU = """
    , p AS (SELECT x.cell_id, greatest(least(x.x1, h.x1) - greatest(x.x0, h.x0), 0) * greatest(least(x.y1, h.y1) - greatest(x.y0, h.y0), 0) AS i
            FROM xen_v x JOIN he_v h ON x.x0 <= h.x1 AND h.x0 <= x.x1 AND x.y0 <= h.y1 AND h.y0 <= x.y1),
      m AS (SELECT cell_id, max(i / (200 - i)) AS max_iou, count(*) AS n_candidates FROM p GROUP BY 1)
"""


@query(IOU + "SELECT cell_id, max_iou, n_candidates FROM m", "xen_v", "he_v")
def q_iou_max(spark, sf):
    return spatial.max_iou(view(spark, sf, "xen_v"), view(spark, sf, "he_v"))


@query(IOU + "SELECT c.cell_id FROM cells_v c JOIN m USING (cell_id) WHERE max_iou >= 0.5", "cells_v", "xen_v", "he_v")
def q_iou_filter(spark, sf):
    return spatial.overlap_filter(_cells(spark, sf), view(spark, sf, "xen_v"), view(spark, sf, "he_v")).select("cell_id")


@query(
    IOU
    + """
    SELECT count(*) AS n_in, CAST(count_if(coalesce(max_iou >= 0.5, false)) AS BIGINT) AS n_kept,
           CAST(count_if(x.cell_id IS NULL) AS BIGINT) AS no_nucleus,
           CAST(count_if(x.cell_id IS NOT NULL AND NOT coalesce(max_iou >= 0.5, false)) AS BIGINT) AS low_overlap
    FROM cells_v c LEFT JOIN (SELECT * FROM xen_v WHERE CAST(cell_id AS BIGINT) % 3 <> 0) x USING (cell_id) LEFT JOIN (SELECT * FROM m WHERE CAST(cell_id AS BIGINT) % 3 <> 0) m USING (cell_id)
    """,
    "cells_v",
    "xen_v",
    "he_v",
)
def q_overlap_counts(spark, sf):
    xen = view(spark, sf, "xen_v").filter("CAST(cell_id AS BIGINT) % 3 <> 0")
    return spatial.overlap_counts(_cells(spark, sf), xen, view(spark, sf, "he_v"))


@query(IOU + "SELECT cell_id, round(max_iou, 9) AS max_iou FROM m", "xen_v", "he_v")
def q_iou_polygons(spark, sf):
    """The overlap of general polygons, on rings that happen to be rectangles."""
    ring = lambda d: d.withColumn("ring", G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))[0])
    out = spatial.max_iou(ring(view(spark, sf, "xen_v")), ring(view(spark, sf, "he_v")))
    return out.select("cell_id", F.round("max_iou", 9).alias("max_iou"))


@query("SELECT poly_id, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM tissue_v", "tissue_v")
def q_polygon_centroid(spark, sf):
    c = G.centroid(F.col("rings"))
    return _tissue(spark, sf).select("poly_id", c["x"].alias("cx"), c["y"].alias("cy"))


@query(
    """
    SELECT poly_id, CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS vertex,
           (unnest([x0, x1, x1, x0]) * 0.5 - 40) * 224 / 100 AS px, (unnest([y0, y0, y1, y1]) * 0.5 - 60) * 224 / 100 AS py FROM tissue_v
    """,
    "tissue_v",
)
def q_overlay_px(spark, sf):
    v = _tissue(spark, sf).select("poly_id", F.posexplode(F.col("rings")[0]).alias("vertex", "p"))
    px = lambda c, o: S.overlay_px(F.col(c), F.lit(0.5), F.lit(float(o)), F.lit(224), F.lit(100))
    return v.select("poly_id", "vertex", px("p.x", 40).alias("px"), px("p.y", 60).alias("py"))


@query("SELECT a.pos AS id, count(b.pos) AS n_neighbours FROM cells_v a LEFT JOIN cells_v b ON a.pos <> b.pos AND (a.x_px - b.x_px) ** 2 + (a.y_px - b.y_px) ** 2 <= 400 GROUP BY 1", "cells_v")
def q_neighbours(spark, sf):
    return metrics.neighbours(_cells(spark, sf).select(F.col("pos").alias("id"), F.col("x_px").alias("x"), F.col("y_px").alias("y")), 20.0)


@query(
    """
    , d AS (SELECT a.pos AS id, b.pos AS neighbour, sqrt((a.x_px - b.x_px) * (a.x_px - b.x_px) + (a.y_px - b.y_px) * (a.y_px - b.y_px)) AS distance FROM cells_v a JOIN cells_v b ON a.pos <> b.pos),
      r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d)
    SELECT id, neighbour, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
    """,
    "cells_v",
)
def q_nearest(spark, sf):
    """The five nearest cells of every cell, as edges of a graph."""
    p = _cells(spark, sf).select(F.col("pos").alias("id"), F.col("x_px").alias("x"), F.col("y_px").alias("y"))
    return spatial.nearest(p, 5).withColumn("distance", F.round("distance", 6))


@query(
    """
    , z AS (SELECT pos, x_px, y_px, CAST(pos % 17 AS DOUBLE) - (SELECT avg(CAST(pos % 17 AS DOUBLE)) FROM cells_v) AS z FROM cells_v),
      w AS (SELECT sum(a.z * b.z) AS s, count(*) AS pairs FROM z a JOIN z b ON a.pos <> b.pos AND (a.x_px - b.x_px) ** 2 + (a.y_px - b.y_px) ** 2 <= 900)
    SELECT round(s / pairs / (SELECT var_pop(z) FROM z), 6) AS moran_i, (SELECT count(*) FROM z) AS n, pairs FROM w
    """,
    "cells_v",
)
def q_moran(spark, sf):
    p = _cells(spark, sf).select(F.col("pos").alias("id"), F.col("x_px").alias("x"), F.col("y_px").alias("y"), (F.col("pos") % 17).cast("double").alias("v"))
    return spatial.moran_i(p, "v", 30.0).withColumn("moran_i", F.round("moran_i", 6))


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS cell_id, 2 * (w + h) AS n_outline, (w + 1) * (10 + w) + (h - 1) * (10 + w) AS sum_x, (h + 1) * (14 + h) + (w - 1) * (14 + h) AS sum_y, CASE WHEN w < 2 OR h < 2 THEN 0 ELSE (w - 1) * (h - 1) END AS n_shaded
    FROM (SELECT p_partkey, CAST(1 + p_size % 20 AS BIGINT) AS w, 1 + p_partkey % 30 AS h FROM part)
    """
)
def q_overlay_png(spark, sf):
    """The pixels of every cell's figure, decoded: a box's outline and the shade within it."""
    w, h = (1 + F.col("p_size") % 20), (1 + F.col("p_partkey") % 30)
    corners = F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((F.lit(5), F.lit(7)), (5 + w, F.lit(7)), (5 + w, 7 + h), (F.lit(5), 7 + h))))
    rows = read_table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("cell_id"), F.lit("cell").alias("layer"), F.lit(0).alias("part"), F.posexplode(corners).alias("vertex", "p"))
    made = figures.patch_figures(rows.select("cell_id", "layer", "part", "vertex", "p.x", "p.y").withColumnsRenamed({"x": "px", "y": "py"}), 64, fill=("cell",))
    return made.select("cell_id", _pixels("png").alias("p")).select("cell_id", *(F.col(f"p.{n}").alias(n) for n in ("n_outline", "sum_x", "sum_y", "n_shaded")))


@F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in ("n_outline", "sum_x", "sum_y", "n_shaded")]))
def _pixels(files: pd.Series) -> pd.DataFrame:
    """What is drawn in pictures of 64 by 64."""
    out = []
    for data in files:
        at = bytes(data).index(b"IDAT")
        size = int.from_bytes(data[at - 4 : at], "big")
        a = np.frombuffer(zlib.decompress(bytes(data[at + 4 : at + 4 + size])), np.uint8).reshape(64, 193)[:, 1:].reshape(64, 64, 3)
        line, ground = (a == figures.COLOURS["cell"]).all(2), (a == 255).all(2)
        y, x = np.nonzero(line)
        out.append((len(x), x.sum(), y.sum(), (~line & ~ground).sum()))
    return pd.DataFrame(out, columns=["n_outline", "sum_x", "sum_y", "n_shaded"])


# Genes and expression.


def _genes(spark, sf):
    return view(spark, sf, "genes_v").withColumnRenamed("first_pos", "pos")


ALL = "SELECT gene FROM genes_v GROUP BY gene HAVING count(DISTINCT sample) = (SELECT count(DISTINCT sample) FROM genes_v)"


@query(ALL, "genes_v")
def q_gene_intersection(spark, sf):
    return genes.common(_genes(spark, sf))


@query(f"SELECT gene, CAST(row_number() OVER (ORDER BY gene) - 1 AS BIGINT) AS gene_idx FROM ({ALL})", "genes_v")
def q_panel_sorted(spark, sf):
    return genes.sorted_panel(_genes(spark, sf))


@query(f"SELECT gene, CAST(row_number() OVER (ORDER BY first_pos, gene) - 1 AS BIGINT) AS gene_idx FROM genes_v WHERE sample = 0 AND gene IN ({ALL})", "genes_v")
def q_panel_first(spark, sf):
    return genes.first_sample_panel(_genes(spark, sf), 0)


@query(f"SELECT count(*) AS n_given, CAST(count_if(gene IN ({ALL})) AS BIGINT) AS n_common FROM (SELECT DISTINCT gene FROM genes_v WHERE sample = 3)", "genes_v")
def q_panel_explicit(spark, sf):
    """How much of one sample's genes a panel could take; the check itself is unit-tested."""
    given = _genes(spark, sf).filter("sample = 3").select("gene").distinct()
    both = given.join(genes.common(_genes(spark, sf)).withColumn("__ok", F.lit(True)), "gene", "left")
    return both.agg(F.count("*").alias("n_given"), F.count_if(F.col("__ok")).alias("n_common"))


@query(f"SELECT sha256('[\"' || string_agg(gene, '\",\"' ORDER BY gene) || '\"]') AS panel_sha256, count(*) AS n_genes FROM ({ALL})", "genes_v")
def q_panel_sha(spark, sf):
    panel = genes.sorted_panel(_genes(spark, sf)).agg(F.array_sort(F.collect_list("gene")).alias("g"))
    return panel.select(S.panel_sha256(F.col("g")).alias("panel_sha256"), F.size("g").cast("bigint").alias("n_genes"))


@query(
    f"""
    , e AS (SELECT CAST(l_orderkey AS BIGINT) AS cell, CONCAT('G', CAST(l_partkey AS STRING)) AS gene, sum(CAST(l_quantity AS DOUBLE)) AS value FROM lineitem GROUP BY 1, 2),
      p AS (SELECT gene, CAST(row_number() OVER (ORDER BY gene) - 1 AS BIGINT) AS gene_idx FROM ({ALL}))
    SELECT cell, gene_idx, value FROM e JOIN p USING (gene)
    """,
    "genes_v",
)
def q_gene_slice(spark, sf):
    entries = read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("cell"), F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene")).agg(F.sum("l_quantity").alias("value"))
    return genes.slice_genes(entries, genes.sorted_panel(_genes(spark, sf)))


THRESHOLDED = "list_transform(embedding, lambda x: CASE WHEN x > 0.1 THEN x ELSE 0 END)"


def _sparse(spark, sf):
    dense = F.transform("embedding", lambda x: F.when(x > 0.1, x).otherwise(F.lit(0.0).cast("float")))
    return read_table(spark, sf, "embeddings").select("vec_id", sparse.encode(dense).alias("s")).select("vec_id", "s.indices", "s.values")


@query(
    """
    SELECT vec_id, array_to_string(list_transform(list_filter(range(len(embedding)), lambda i: embedding[i + 1] > 0.1), lambda i: CAST(i AS VARCHAR)), ',') AS indices,
           CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS BIGINT) AS nnz, round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0.1), lambda x: CAST(x AS DOUBLE))), 6) AS total
    FROM embeddings
    """
)
def q_sparse_encode(spark, sf):
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double")), 6)
    return _sparse(spark, sf).select("vec_id", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), sparse.nnz(F.col("indices")).alias("nnz"), total.alias("total"))


def _folder(spark, name):
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


@query("SELECT vec_id AS row, CAST(unnest(range(len(embedding))) AS INTEGER) AS gene_idx, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings")
def q_array_store(spark, sf):
    """A matrix that was written as a chunked array, read by rows of chunks."""
    rows = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("row"), F.col("embedding").alias("values"))
    folder = _folder(spark, "array")
    chunked.write_array(rows, folder, (rows.agg(F.max("row")).first()[0] + 1, 64), dtype="float32", tall=100)
    return chunked.read(spark, folder).select("row", F.posexplode("values").alias("gene_idx", "value"))


@query(
    """
    SELECT vec_id AS row, array_to_string(list_transform(list_filter(range(len(embedding)), lambda i: embedding[i + 1] > 0.1), lambda i: CAST(i AS VARCHAR)), ',') AS indices,
           CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS BIGINT) AS nnz, round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0.1), lambda x: CAST(x AS DOUBLE))), 6) AS total
    FROM embeddings
    """
)
def q_csr_store(spark, sf):
    """Sparse rows that were written as three chunked arrays, read by ranges of rows."""
    rows, folder = _sparse(spark, sf).withColumnRenamed("vec_id", "row"), _folder(spark, "csr")
    chunked.write_csr(rows, folder, rows.agg(F.max("row")).first()[0] + 1, tall=1000)
    out = chunked.read(spark, folder, "csr", entries=3000)
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6)
    return out.select("row", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"), sparse.nnz(F.col("indices")).alias("nnz"), total.alias("total"))


@query("SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS gene_idx, CAST(unnest(list_transform(embedding, lambda x: CASE WHEN x > 0.1 THEN x ELSE 0 END)) AS FLOAT) AS value FROM embeddings")
def q_sparse_dense(spark, sf):
    rows = _sparse(spark, sf)
    return rows.select("vec_id", F.posexplode(sparse.decode(F.col("indices"), F.col("values"), 64)).alias("gene_idx", "value"))


@query("SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0.1)) AS BIGINT) AS nnz FROM embeddings")
def q_nnz(spark, sf):
    return _sparse(spark, sf).select("vec_id", sparse.nnz(F.col("indices")).alias("nnz"))


@query("SELECT vec_id, count(*) AS n, round(sum(CAST(x AS DOUBLE)), 6) AS total FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) WHERE x > 0.1 GROUP BY 1")
def q_coordinates(spark, sf):
    """Sparse rows to coordinates and back."""
    back = sparse.from_coordinates(sparse.to_coordinates(_sparse(spark, sf), "vec_id"), "vec_id")
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double")), 6)
    return back.select("vec_id", F.size("indices").cast("bigint").alias("n"), total.alias("total"))


# Manifests.


def _documents(spark, sf):
    return read_table(spark, sf, "documents").select(F.col("source").alias("sample_id"), F.col("doc_id").cast("string").alias("cell_id"), F.col("lang").alias("grp"), F.col("doc_id").alias("pos"))


def _manifest(spark, sf):
    return manifest.dense_index(_documents(spark, sf), "sample_id", "pos").select("global_idx", "sample_id", "cell_id", "grp")


@query("SELECT source AS sample_id, CAST(doc_id AS STRING) AS cell_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS extra FROM documents")
def q_union_manifest(spark, sf):
    docs = _documents(spark, sf).withColumn("odd", F.col("pos") % 2)
    even, odd = docs.filter("odd = 0").select("sample_id", "cell_id", F.col("grp").alias("extra")), docs.filter("odd = 1").select("sample_id", "cell_id")
    return manifest.union_samples([even, odd])


@query("SELECT global_idx, sample_id, cell_id, grp FROM manifest_v", "manifest_v")
def q_global_idx(spark, sf):
    return _manifest(spark, sf)


@query("SELECT cell_id, printf('%07d', global_idx) AS sample_key, printf('%09d', global_idx) AS global_key, sample_id || '/' || cell_id AS obs_name FROM manifest_v", "manifest_v")
def q_keys(spark, sf):
    m = manifest.with_keys(_manifest(spark, sf), "global_idx", "global_idx")
    return m.select("cell_id", "sample_key", "global_key", S.obs_name(F.col("sample_id"), F.col("cell_id")).alias("obs_name"))


ORDERED = "SELECT cell_id, pos, CAST(floor(greatest(0.0, y_px * 20 - 50) / 4096) * 10000 + floor(greatest(0.0, x_px * 20 - 50) / 4096) AS BIGINT) AS tile_key FROM cells_v"


def _ordered(spark, sf):
    at = lambda c: F.col(c) * 20 - 50
    return manifest.spatial_order(_cells(spark, sf).withColumn("tile_key", S.tile_key(at("x_px"), at("y_px"))), "tile_key", "pos")


@query(f"SELECT cell_id, tile_key, CAST(row_number() OVER (ORDER BY tile_key, pos) - 1 AS BIGINT) AS sample_index FROM ({ORDERED})", "cells_v")
def q_spatial_order(spark, sf):
    return _ordered(spark, sf).select("cell_id", "tile_key", "sample_index")


SHARDED = f"SELECT cell_id, i // 500 AS shard_no, i % 500 AS local_index, 'shard-' || printf('%06d', i // 500) || '.tar' AS shard_path FROM (SELECT cell_id, CAST(row_number() OVER (ORDER BY tile_key, pos) - 1 AS BIGINT) AS i FROM ({ORDERED}))"


@query(SHARDED, "cells_v")
def q_shards(spark, sf):
    return manifest.with_shards(_ordered(spark, sf)).select("cell_id", "shard_no", "local_index", "shard_path")


@query(f"SELECT shard_path, count(*) AS n_cells FROM ({SHARDED}) GROUP BY 1", "cells_v")
def q_shard_sizes(spark, sf):
    return manifest.with_shards(_ordered(spark, sf)).groupBy("shard_path").agg(F.count("*").alias("n_cells"))


BUNDLED = """
    SELECT global_idx, sample_id, cell_id, printf('%07d', i) AS sample_key, printf('%09d', global_idx) AS global_key,
           sample_id || '/shard-' || printf('%06d', i // 10) || '.tar' AS shard_path
    FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY global_idx) - 1 AS i FROM manifest_v)
"""


def _bundled(spark, sf):
    return manifest.bundled(_documents(spark, sf), size=10)


@query(BUNDLED, "manifest_v")
def q_bundled_manifest(spark, sf):
    return _bundled(spark, sf)


@query(f"SELECT global_idx, 'shard-' || printf('%06d', dense_rank() OVER (ORDER BY shard_path) - 1) || '.tar' AS new_path FROM ({BUNDLED})", "manifest_v")
def q_shard_remap(spark, sf):
    return manifest.remap_shards(_bundled(spark, sf)).select("global_idx", "new_path")


@query("SELECT global_idx, sample_id, cell_id, label, CAST(len(embedding) AS BIGINT) AS n_values FROM manifest_v JOIN embedded_v USING (global_idx)", "manifest_v", "embedded_v")
def q_manifest_expr_join(spark, sf):
    e = view(spark, sf, "embedded_v")
    return manifest.with_expression(_manifest(spark, sf), e).select("global_idx", "sample_id", "cell_id", "label", F.size("embedding").cast("bigint").alias("n_values"))


@query("SELECT global_idx, sample_id FROM manifest_v WHERE sample_id IN ('src3', 'src7')", "manifest_v")
def q_sample_filter(spark, sf):
    return filters.sample_filter(_manifest(spark, sf), ["src7", "src3"]).select("global_idx", "sample_id")


@query("SELECT cell_id FROM cells_v ORDER BY md5('42:' || cell_id), cell_id LIMIT 25", "cells_v")
def q_sample_topk(spark, sf):
    return filters.uniform_sample(_cells(spark, sf), 25, SEED, "cell_id").select("cell_id")


@query(
    f"""
    SELECT count(*) AS n_rows, 0::BIGINT AS dup_keys, 0::BIGINT AS dup_cells, CAST(count_if(CAST(cell_id AS BIGINT) % 50 = 0) AS BIGINT) AS id_mismatches,
           0.0::DOUBLE AS max_bbox_error FROM ({ORDERED})
    """,
    "cells_v",
)
def q_integrity(spark, sf):
    rows = _ordered(spark, sf).select("sample_index", S.padded(F.col("sample_index"), 7).alias("sample_key"), "cell_id", F.col("pos").alias("gene_row_index"), F.col("x_px").alias("center_x_pixel"), F.col("y_px").alias("center_y_pixel"), (F.col("x_px") - 50).alias("bbox_x0"), (F.col("y_px") - 50).alias("bbox_y0"))
    expression = rows.select(F.col("sample_index").alias("expr_row"), F.when(F.col("gene_row_index") % 50 != 0, F.col("cell_id")).otherwise("wrong").alias("cell_id"))
    return manifest.integrity(rows, expression, BASE)


@query(" UNION ALL ".join(f"SELECT 'tables' AS kind, '{t}' AS key, count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE {t})) AS BIGINT) AS n_cols FROM {t}" for t in TABLES))
def q_catalog(spark, sf):
    return catalog.describe({("tables", t): read_table(spark, sf, t) for t in TABLES})


# Splits.

STAMP = "'expression' AS task, '{0}' AS split_policy, '{1}' AS generated_at_level"
HELD = "CASE WHEN sample_id IN ('src1', 'src2') THEN 'val' WHEN sample_id IN ('src3') THEN 'test' ELSE 'train' END"


def _held(spark, sf):
    m = _manifest(spark, sf)
    return splits.sample_holdout(m, TASK, [f"src{i}" for i in range(20) if i not in (1, 2, 3)], ["src1", "src2"], ["src3"])


@query(f"SELECT global_idx, sample_id, cell_id, {HELD} AS split, {STAMP.format('sample_holdout', 'sample')} FROM manifest_v", "manifest_v")
def q_holdout(spark, sf):
    return _held(spark, sf)


RANKED = "(SELECT {0} AS group_id, row_number() OVER (ORDER BY md5('42:' || {0}), {0}) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT {0} FROM manifest_v))"
RATIO = """
    SELECT global_idx, sample_id, cell_id, group_id, CASE WHEN r < t THEN 'train' WHEN r < t + v THEN 'val' ELSE 'test' END AS split, {1}, 42 AS seed
    FROM manifest_v JOIN (SELECT group_id, r, t, CASE WHEN t + v0 >= n THEN greatest(0, n - t - 1) ELSE v0 END AS v
                          FROM (SELECT *, greatest(1, round_even(n * 0.8::DOUBLE, 0)) AS t, greatest(0, round_even(n * 0.1::DOUBLE, 0)) AS v0 FROM {2})) ON group_id = {0}
"""


@query(RATIO.format("sample_id", STAMP.format("ratio_by_group", "group"), RANKED.format("sample_id")), "manifest_v")
def q_ratio_md5(spark, sf):
    return splits.ratio_by_group(_manifest(spark, sf), TASK, "sample_id")


@query(RATIO.format("grp", STAMP.format("ratio_by_group", "group"), RANKED.format("grp")), "manifest_v")
def q_ratio_clamp(spark, sf):
    """Four groups: val gives way so that test has one."""
    return splits.ratio_by_group(_manifest(spark, sf), TASK, "grp")


FOLDED = f"SELECT global_idx, sample_id, cell_id, group_id, CAST(r % 5 AS INTEGER) AS fold, {{0}} AS split, {STAMP.format('group_kfold', 'group')}, 42 AS seed FROM manifest_v JOIN {RANKED.format('sample_id')} ON group_id = sample_id"


@query(FOLDED.format("'fold_' || (r % 5)"), "manifest_v")
def q_kfold_md5(spark, sf):
    return splits.group_kfold(_manifest(spark, sf), TASK, "sample_id")


@query(FOLDED.format("CASE WHEN r % 5 = 2 THEN 'val' ELSE 'train' END"), "manifest_v")
def q_kfold_fold(spark, sf):
    return splits.group_kfold(_manifest(spark, sf), TASK, "sample_id", fold=2)


GIVEN = "(SELECT sample_id, CASE WHEN sample_id < 'src15' THEN 'train' ELSE 'test' END AS split, global_idx FROM manifest_v)"


def _given(spark, sf):
    return _manifest(spark, sf).select("global_idx", "sample_id", F.when(F.col("sample_id") < "src15", "train").otherwise("test").alias("split"))


@query(f"SELECT global_idx, sample_id, cell_id, split, {STAMP.format('existing_file', 'sample')} FROM manifest_v JOIN (SELECT DISTINCT sample_id, split FROM {GIVEN}) USING (sample_id)", "manifest_v")
def q_existing_sample(spark, sf):
    return splits.existing(_manifest(spark, sf), TASK, _given(spark, sf).select("sample_id", "split"))


@query(
    f"SELECT global_idx, sample_id, cell_id, CASE WHEN global_idx % 3 = 0 THEN 'val' ELSE 'train' END AS split, {STAMP.format('existing_file', 'cell')}, 'split given by cell: cells of one sample may be on both sides' AS leakage_warning FROM manifest_v",
    "manifest_v",
)
def q_existing_global(spark, sf):
    given = _manifest(spark, sf).select("global_idx", F.when(F.col("global_idx") % 3 == 0, "val").otherwise("train").alias("split"))
    return splits.existing(_manifest(spark, sf), TASK, given)


@query(
    f"""
    SELECT global_idx, sample_id, cell_id, s.split, {STAMP.format('existing_file', 'sample')} FROM manifest_v
    JOIN (SELECT sample_id, arg_min(CASE WHEN global_idx % 2 = 0 THEN 'train' ELSE 'val' END, global_idx) AS split FROM manifest_v GROUP BY 1) s USING (sample_id)
    """,
    "manifest_v",
)
def q_existing_both(spark, sf):
    """A file with both keys: the sample counts, and of it the first row."""
    given = _manifest(spark, sf).select("global_idx", "sample_id", F.when(F.col("global_idx") % 2 == 0, "train").otherwise("val").alias("split"))
    return splits.existing(_manifest(spark, sf), TASK, given, order=["global_idx"])


@query(f"SELECT {HELD} AS split, count(*) AS n_cells FROM manifest_v GROUP BY 1", "manifest_v")
def q_split_counts(spark, sf):
    return splits.split_counts(_held(spark, sf))


@query(f"SELECT sample_id, {HELD} AS split, count(*) AS n_cells FROM manifest_v GROUP BY 1, 2", "manifest_v")
def q_split_sample_counts(spark, sf):
    return splits.sample_split_counts(_held(spark, sf))


FLIP = "CASE WHEN global_idx % 97 = 0 THEN 'test' ELSE 'train' END"


def _flipped(spark, sf):
    return _manifest(spark, sf).withColumns({"split": F.expr(FLIP), "group_id": F.col("grp"), "fold": F.expr("CAST(global_idx % 2 AS INT)")})


@query(f"SELECT sample_id, count(DISTINCT {FLIP}) AS n_splits FROM manifest_v GROUP BY 1 HAVING n_splits > 1", "manifest_v")
def q_leak_samples(spark, sf):
    return splits.leaking_samples(_flipped(spark, sf))


@query("SELECT grp AS group_id, count(DISTINCT global_idx % 2) AS n_folds FROM manifest_v GROUP BY 1 HAVING n_folds > 1", "manifest_v")
def q_leak_groups(spark, sf):
    return splits.leaking_groups(_flipped(spark, sf))


@query("SELECT global_idx // 3 AS global_idx, count(*) AS n FROM manifest_v GROUP BY 1 HAVING n > 1", "manifest_v")
def q_dup_idx(spark, sf):
    return splits.duplicates(_manifest(spark, sf).withColumn("global_idx", F.expr("global_idx div 3")))


@query("SELECT global_idx FROM manifest_v WHERE global_idx % 10 = 0", "manifest_v")
def q_uncovered(spark, sf):
    m = _manifest(spark, sf)
    return splits.uncovered(m.filter("global_idx % 10 <> 0"), m)


@query("SELECT global_idx + 5 AS global_idx FROM manifest_v WHERE global_idx + 5 NOT IN (SELECT global_idx FROM manifest_v)", "manifest_v")
def q_phantom(spark, sf):
    m = _manifest(spark, sf)
    return splits.phantoms(m.withColumn("global_idx", F.col("global_idx") + 5), m)


@query(f"SELECT global_idx, cell_id FROM manifest_v WHERE {HELD} = 'val'", "manifest_v")
def q_split_filter(spark, sf):
    return splits.split_rows(_manifest(spark, sf), _held(spark, sf), "val").select("global_idx", "cell_id")


@query(f"SELECT {HELD} AS split, string_agg(CAST(global_idx AS VARCHAR), ',' ORDER BY global_idx) AS members FROM manifest_v WHERE {HELD} <> 'train' GROUP BY 1", "manifest_v")
def q_split_lists(spark, sf):
    held = _held(spark, sf).filter("split <> 'train'")
    return held.groupBy("split").agg(F.array_join(F.transform(F.array_sort(F.collect_list("global_idx")), lambda x: x.cast("string")), ",").alias("members"))


@query(f"SELECT {HELD} AS split, row_number() OVER (PARTITION BY {HELD} ORDER BY global_idx) - 1 AS position, global_idx FROM manifest_v", "manifest_v")
def q_split_rows(spark, sf):
    """The lists of train, val and test as rows."""
    return splits.split_positions(_held(spark, sf))


@query(
    """
    , b AS (SELECT pos AS global_idx, 's' AS sample_id, cell_id, 's:' || CAST(floor(x_px / 250) AS BIGINT) || ':' || CAST(floor(y_px / 250) AS BIGINT) AS group_id FROM cells_v),
      g AS (SELECT group_id, row_number() OVER (ORDER BY md5('42:' || group_id), group_id) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT group_id FROM b)),
      c AS (SELECT *, greatest(1, round_even(n * 0.8::DOUBLE, 0)) AS t, greatest(0, round_even(n * 0.1::DOUBLE, 0)) AS v0 FROM g),
      d AS (SELECT *, CASE WHEN t + v0 >= n THEN greatest(0, n - t - 1) ELSE v0 END AS v FROM c)
    SELECT global_idx, sample_id, cell_id, group_id, CASE WHEN r < t THEN 'train' WHEN r < t + v THEN 'val' ELSE 'test' END AS split,
           'expression' AS task, 'spatial_block' AS split_policy, 'block' AS generated_at_level, 42 AS seed FROM b JOIN d USING (group_id)
    """,
    "cells_v",
)
def q_spatial_block(spark, sf):
    m = _cells(spark, sf).select(F.col("pos").alias("global_idx"), F.lit("s").alias("sample_id"), "cell_id", "x_px", "y_px")
    return splits.spatial_block(m, TASK, "x_px", "y_px", 250.0)


@query(f"SELECT global_idx, sample_id, cell_id, grp AS group_id, CAST(dense_rank() OVER (ORDER BY grp) - 1 AS INTEGER) AS fold, 'fold_' || (dense_rank() OVER (ORDER BY grp) - 1) AS split, {STAMP.format('leave_one_group_out', 'group')} FROM manifest_v", "manifest_v")
def q_logo(spark, sf):
    return splits.leave_one_group_out(_manifest(spark, sf), TASK, "grp")


# Metrics: embeddings as (cell, gene, truth, guess); a guess is the next cell's value mixed in.

PAIRS = """
    p AS (SELECT vec_id AS cell, CAST(unnest(range(len(embedding))) AS INTEGER) AS gene, CAST(unnest(embedding) AS DOUBLE) AS truth FROM embeddings),
    q AS (SELECT cell, gene, truth, truth * 0.5 + sin(cell * 7 + gene * 3) AS guess FROM p)
"""


def _pairs(spark, sf):
    p = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("cell"), F.posexplode(F.col("embedding").cast("array<double>")).alias("gene", "truth"))
    return p.withColumn("guess", F.col("truth") * 0.5 + F.sin((F.col("cell") * 7 + F.col("gene") * 3).cast("double")))


@query(f"WITH {PAIRS} SELECT gene, round(corr(truth, guess), 6) AS pearson FROM q GROUP BY 1")
def q_pearson(spark, sf):
    return metrics.pearson(_pairs(spark, sf)).withColumn("pearson", F.round("pearson", 6))


@query(
    f"""
    WITH {PAIRS}, r AS (SELECT gene, rank() OVER (PARTITION BY gene ORDER BY t) + (count(*) OVER (PARTITION BY gene, t) - 1) / 2.0 AS a, rank() OVER (PARTITION BY gene ORDER BY guess) + (count(*) OVER (PARTITION BY gene, guess) - 1) / 2.0 AS b
                        FROM (SELECT gene, round(truth, 2) AS t, guess FROM q))
    SELECT gene, round(corr(a, b), 6) AS spearman FROM r GROUP BY 1
    """
)
def q_spearman(spark, sf):
    """Truth is rounded, so that ranks have ties."""
    return metrics.spearman(_pairs(spark, sf).withColumn("truth", F.round("truth", 2))).withColumn("spearman", F.round("spearman", 6))


@query(f"WITH {PAIRS} SELECT gene, round(avg((guess - truth) * (guess - truth)), 6) AS mse, round(avg(abs(guess - truth)), 6) AS mae, round(avg(guess - truth), 6) AS bias, count(*) AS n FROM q GROUP BY 1")
def q_mse_mae(spark, sf):
    return metrics.errors(_pairs(spark, sf), "gene").withColumns({c: F.round(c, 6) for c in ("mse", "mae", "bias")})


@query(f"WITH {PAIRS} SELECT gene, round(variance, 6) AS variance FROM (SELECT gene, var_samp(truth) AS variance FROM q GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)")
def q_hvg_topk(spark, sf):
    return metrics.variable_genes(_pairs(spark, sf), 10).withColumn("variance", F.round("variance", 6))


@query(f"WITH {PAIRS} SELECT a.gene AS gene_a, b.gene AS gene_b, round(corr(a.truth, b.truth), 6) AS r FROM q a JOIN q b ON a.cell = b.cell AND a.gene < b.gene WHERE a.gene < 8 AND b.gene < 8 GROUP BY 1, 2")
def q_co_expression(spark, sf):
    return metrics.co_expression(_pairs(spark, sf), list(range(8))).withColumn("r", F.round("r", 6))


@query(f"WITH {PAIRS} SELECT a.gene AS gene_a, b.gene AS gene_b, round(corr(a.truth, b.truth), 6) AS r FROM q a JOIN q b ON a.cell = b.cell AND a.gene < b.gene GROUP BY 1, 2")
def q_co_expression_all(spark, sf):
    """All genes of the table."""
    return metrics.co_expression(_pairs(spark, sf), list(range(64))).withColumn("r", F.round("r", 6))


@query(
    f"""
    WITH {PAIRS}, s AS (SELECT cell, gene % 4 AS pathway, avg(truth) AS truth, avg(guess) AS guess FROM q GROUP BY 1, 2)
    SELECT pathway, round(corr(truth, guess), 6) AS pearson FROM s GROUP BY 1
    """
)
def q_pathway_scores(spark, sf):
    pathways = spark.range(64).select(F.col("id").cast("int").alias("gene"), (F.col("id") % 4).cast("int").alias("pathway"))
    return metrics.pathway_scores(_pairs(spark, sf), pathways).withColumn("pearson", F.round("pearson", 6))


@query(
    f"""
    WITH {PAIRS}, e AS (SELECT cell, gene FROM q WHERE gene < 6 AND truth > 0), n AS (SELECT gene, count(*) AS n FROM e GROUP BY 1),
         b AS (SELECT x.gene AS gene_a, y.gene AS gene_b, count(*) AS n_both FROM e x JOIN e y ON x.cell = y.cell AND x.gene < y.gene GROUP BY 1, 2)
    SELECT gene_a, gene_b, n_both, u.n + v.n - n_both AS n_either FROM b JOIN n u ON u.gene = gene_a JOIN n v ON v.gene = gene_b
    """
)
def q_mutual_exclusivity(spark, sf):
    return metrics.mutual_exclusivity(_pairs(spark, sf), list(range(6)))


@query(
    f"""
    WITH {PAIRS}, e AS (SELECT cell, gene FROM q WHERE truth > 0), n AS (SELECT gene, count(*) FILTER (truth > 0) AS n FROM q GROUP BY 1),
         b AS (SELECT x.gene AS gene_a, y.gene AS gene_b, count(*) AS n_both FROM e x JOIN e y ON x.cell = y.cell AND x.gene < y.gene GROUP BY 1, 2)
    SELECT u.gene AS gene_a, v.gene AS gene_b, coalesce(n_both, 0) AS n_both, u.n + v.n - coalesce(n_both, 0) AS n_either
    FROM n u JOIN n v ON u.gene < v.gene LEFT JOIN b ON b.gene_a = u.gene AND b.gene_b = v.gene
    """
)
def q_mutual_exclusivity_all(spark, sf):
    """All genes of the table."""
    return metrics.mutual_exclusivity(_pairs(spark, sf), list(range(64)))


@query("SELECT lang AS label, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS BIGINT) AS label_id, count(*) AS n FROM documents GROUP BY lang")
def q_label_map(spark, sf):
    return metrics.label_map(read_table(spark, sf, "documents"), "lang")


@query("SELECT CAST(sum(CAST('0x' || substr(sha256(global_idx || '|' || sample_id || '|' || cell_id), 1, 12) AS BIGINT)) AS VARCHAR) AS digest_sum, count(*) AS n_rows FROM manifest_v", "manifest_v")
def q_freeze_hash(spark, sf):
    return metrics.content_hash(_manifest(spark, sf), "global_idx", "sample_id", "cell_id")


# The planner, over inline requests.

REQUESTS = [
    "Keep cells inside tissue with nucleus boundaries, mpp 0.5 patch size 224",
    "Process A_001,A_002 with nucleus overlap > 0.5 and bundle as webdataset",
    "sampled 500 cells, full_ops_level, mpp=0.25",
    "filter the tissue; 100 cells per sample",
    "the nucleus of every cell",
    "nothing special",
]


@query(
    "SELECT request, regexp_matches(lower(request), 'inside tissue|out of tissue|outside tissue|tissue filter|tissue region|filter.*tissue') AS tissue_inside, regexp_matches(lower(request), 'with nucleus boundaries|has nucleus|only cells with nucleus|nucleus boundar|nucleus presence') AS nucleus_presence, regexp_matches(lower(request), 'xenium nucleus.*he nucleus|he nucleus|nucleus overlap|overlap\\s*>') AS xenium_he_nucleus_overlap FROM (VALUES "
    + ", ".join("('" + r.replace("'", "''") + "')" for r in REQUESTS)
    + ") AS v(request)"
)
def q_plan_stages(spark, sf):
    d = spark.createDataFrame([(r,) for r in REQUESTS], "request string")
    return planner.plan_requests(d).select("request", *planner.STAGES)


@query(
    "SELECT request, CAST(coalesce(nullif(regexp_extract(lower(request), 'sampled?\\s+(\\d+)\\s*cell', 1), ''), nullif(regexp_extract(lower(request), '(\\d+)\\s*cell[s]?\\s+(?:per|from each)\\s+sample', 1), '')) AS BIGINT) AS n_sample, CAST(nullif(regexp_extract(lower(request), 'mpp[=\\s]+(\\d+(?:\\.\\d+)?|\\.\\d+)', 1), '') AS DOUBLE) AS mpp, CAST(nullif(regexp_extract(lower(request), 'patch\\s+size[=\\s]+(\\d+)', 1), '') AS BIGINT) AS patch_size, contains(lower(request), 'ops_level') AS ops_level, (contains(lower(request), 'bundle') OR contains(lower(request), 'webdataset')) AS bundle, nullif(regexp_extract(request, '[Pp]rocess\\s+(\\w+(?:,\\w+)+)', 1), '') AS samples FROM (VALUES "
    + ", ".join("('" + r.replace("'", "''") + "')" for r in REQUESTS)
    + ") AS v(request)"
)
def q_plan_args(spark, sf):
    d = spark.createDataFrame([(r,) for r in REQUESTS], "request string")
    return planner.plan_requests(d).select("request", "n_sample", "mpp", "patch_size", "ops_level", "bundle", "samples")


# Shards.


def _shards(spark, sf):
    docs = read_table(spark, sf, "documents").select(F.col("source").alias("sample_id"), F.col("doc_id").cast("string").alias("cell_id"), F.col("doc_id").alias("pos"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("image"))
    rows = manifest.with_keys(manifest.dense_index(docs, "sample_id", "pos", "sample_index"), "sample_index", "sample_index")
    return rows, shards.build_shards(manifest.with_shards(rows, size=100))


@query("SELECT cell_id, sha256(text) AS payload_sha256 FROM manifest_v JOIN documents ON CAST(doc_id AS STRING) = cell_id", "manifest_v")
def q_tar_roundtrip(spark, sf):
    """Every text through a tar shard and back."""
    rows, built = _shards(spark, sf)
    back = shards.members(built).filter("ext = 'jpg'").select(F.col("key").alias("sample_key"), F.sha2("payload", 256).alias("payload_sha256"))
    return rows.join(back, "sample_key").select("cell_id", "payload_sha256")


@query("SELECT cell_id, sha256(text) AS payload_sha256, octet_length(encode(text)) AS jpg_size FROM manifest_v JOIN documents ON CAST(doc_id AS STRING) = cell_id", "manifest_v")
def q_cidx(spark, sf):
    """The same through the index's byte ranges."""
    rows, built = _shards(spark, sf)
    got = shards.byte_range(built, shards.offsets(built)).select("sample_index", "jpg_size", F.sha2("payload", 256).alias("payload_sha256"))
    return rows.join(got, "sample_index").select("cell_id", "payload_sha256", "jpg_size")


from . import registry_samples, registry_whole  # noqa: E402, F401  both register here
