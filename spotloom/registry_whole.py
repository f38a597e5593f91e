"""Queries over whole tables beside others that see a part of them, requests made of the conversations, and stages and files end to end."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions import scalars as S
from .operators import overlays, pipelines, spatial, splits
from .plans import planner
from .registry import HELD, INSIDE, IOU, SEED, _cells, _held, _manifest, _points, _tissue, query
from .session import checkpoint_dir, read_table
from .sources import catalog, store, tiles
from .views import view


@query(INSIDE.replace("tissue_v", "tissues_v").format("x0 * 2 + 10", "x1 * 2 + 10", "y0 * 2 - 20", "y1 * 2 - 20"), "cells_v", "tissues_v")
def q_tissue_affine_all(spark, sf):
    """The shapes of all suppliers, scaled and shifted."""
    shapes = _points(spark, sf).withColumnRenamed("cell_id", "shape_id")
    return spatial.tissue_filter(_cells(spark, sf), shapes, _tissue(spark, sf, "tissues_v"), transform=(2.0, 0.0, 0.0, 2.0, 10.0, -20.0)).select("cell_id")


@query("SELECT poly_id, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM tissues_v", "tissues_v")
def q_polygon_centroid_all(spark, sf):
    c = G.centroid(F.col("rings"))
    return _tissue(spark, sf, "tissues_v").select("poly_id", c["x"].alias("cx"), c["y"].alias("cy"))


@query(
    """
    SELECT poly_id, CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS vertex,
           (unnest([x0, x1, x1, x0]) * 0.5 - 40) * 224 / 100 AS px, (unnest([y0, y0, y1, y1]) * 0.5 - 60) * 224 / 100 AS py FROM tissues_v
    """,
    "tissues_v",
)
def q_overlay_px_all(spark, sf):
    v = _tissue(spark, sf, "tissues_v").select("poly_id", F.posexplode(F.col("rings")[0]).alias("vertex", "p"))
    px = lambda c, o: S.overlay_px(F.col(c), F.lit(0.5), F.lit(float(o)), F.lit(224), F.lit(100))
    return v.select("poly_id", "vertex", px("p.x", 40).alias("px"), px("p.y", 60).alias("py"))


#: A phrase for each turn of a conversation, which makes a request of it; the last asks for nothing.
ASKS = (
    "crop cells inside tissue with nucleus boundaries, mpp 0.5, bundle", "Process A_1,B_2: xenium nucleus against HE nucleus, patch size 256, optimized ops level",
    "sampled 500 cells per sample as WebDataset for cell type classification, mpp=.25", "self-supervised pairs from 20 cells from each sample in the tissue region", "thank you",
)
REQUEST = "text || ' ' || CASE turn % 5 " + " ".join(f"WHEN {k} THEN '{a}'" for k, a in enumerate(ASKS)) + " END"
TURNS = "(SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations)"


def _requests(spark, sf):
    asks = F.element_at(F.lit(list(ASKS)), (F.col("turn") % len(ASKS) + 1).cast("int"))
    return read_table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.coalesce("text", F.lit("")), F.lit(" "), asks).alias("request"))


def _matches(stage: str) -> str:
    return f"regexp_matches(low, '{'|'.join(planner.STAGES[stage][1])}') AS {stage}"


def _holds(words: tuple[str, ...]) -> str:
    return " OR ".join(f"contains(low, '{w}')" for w in words)


@query(
    f"""
    WITH r AS (SELECT conv_id, turn, {REQUEST} AS request FROM {TURNS}), l AS (SELECT *, lower(request) AS low FROM r), f AS (SELECT *, {', '.join(map(_matches, planner.STAGES))} FROM l)
    SELECT conv_id, turn, tissue_inside, nucleus_presence, xenium_he_nucleus_overlap,
    """
    + r"""
           CAST(coalesce(nullif(regexp_extract(low, 'sampled?\s+(\d+)\s*cell', 1), ''), nullif(regexp_extract(low, '(\d+)\s*cell[s]?\s+(?:per|from each)\s+sample', 1), '')) AS BIGINT) AS n_sample,
           CAST(nullif(regexp_extract(low, 'mpp[=\s]+(\d+(?:\.\d+)?|\.\d+)', 1), '') AS DOUBLE) AS mpp, CAST(nullif(regexp_extract(low, 'patch\s+size[=\s]+(\d+)', 1), '') AS BIGINT) AS patch_size,
           nullif(regexp_extract(request, '[Pp]rocess\s+(\w+(?:,\w+)+)', 1), '') AS samples,
    """
    + f"""
           {_holds(planner.LEVEL_WORDS)} AS ops_level, {_holds(planner.BUNDLE_WORDS)} AS bundle,
           'table' || CASE WHEN tissue_inside THEN '_tissue' ELSE '' END || CASE WHEN nucleus_presence THEN '_nucleus' ELSE '' END || CASE WHEN xenium_he_nucleus_overlap THEN '_he' ELSE '' END AS final_table_key
    FROM f
    """
)
def q_plan_conversations(spark, sf):
    """The stages, arguments and final tables of requests that are made of all turns of the conversations."""
    return planner.plan_requests(_requests(spark, sf)).select("conv_id", "turn", *planner.STAGES, "n_sample", "mpp", "patch_size", "ops_level", "bundle", "samples", "final_table_key")


@query(f"WITH l AS (SELECT conv_id, turn, lower({REQUEST}) AS low FROM {TURNS}) SELECT conv_id, turn, CASE {' '.join(f'WHEN {_holds(p)} THEN {t!r}' for t, p in planner.TASK_TYPES.items())} END AS task FROM l")
def q_task_conversations(spark, sf):
    """What such requests are for."""
    return _requests(spark, sf).select("conv_id", "turn", planner.task_type_column(F.col("request")).alias("task"))


# Stages and files end to end.


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


def _stage(spark: SparkSession, sf: str, stage: str, layers: dict[str, DataFrame], transform: tuple | None = None) -> DataFrame:
    """What a stage leaves of a sample's table, with the counts of its report, read as they were written."""
    root = _scratch(spark, stage)
    catalog.write_element(_cells(spark, sf), root, "s", "tables", "table")
    for key, rows in layers.items():
        catalog.write_element(rows, root, "s", "shapes", key)
    if transform:
        spark.createDataFrame([("shapes", "tissue", *transform)], "kind string, key string, a double, b double, d double, e double, xoff double, yoff double").write.parquet(f"{root}/s/transforms.parquet")
    r = pipelines.run_stage(spark, root, "s", stage, report_dir=f"{root}/reports")
    told = store.read_json(f"{root}/reports/{stage}_table.json")
    counts = [F.lit(told[c]).cast("bigint").alias(c) for c in ("n_cells_in", "n_cells_out")]
    shapes = [F.lit(told[c]).alias(c) for c in ("input_shape_key", "output_shape_key")]
    return catalog.element(spark, root, "s", "tables", r.output_table_key).select("cell_id", *counts, *shapes)


@query(
    IOU + ", k AS (SELECT c.cell_id FROM cells_v c JOIN m USING (cell_id) WHERE max_iou >= 0.5) SELECT cell_id, (SELECT count(*) FROM cells_v) AS n_cells_in, (SELECT count(*) FROM k) AS n_cells_out, 'nucleus_boundaries' AS input_shape_key, 'he_nuclei' AS output_shape_key FROM k",
    "cells_v",
    "xen_v",
    "he_v",
)
def q_stage_overlap(spark, sf):
    """The overlap stage on written elements."""
    return _stage(spark, sf, "xenium_he_nucleus_overlap", {"nucleus_boundaries": view(spark, sf, "xen_v").withColumnRenamed("cell_id", "shape_id"), "he_nuclei": view(spark, sf, "he_v")})


@query(
    ", k AS (" + INSIDE.replace("tissue_v", "tissues_v").format("x0 * 2 + 10", "x1 * 2 + 10", "y0 * 2 - 20", "y1 * 2 - 20") + ") SELECT cell_id, (SELECT count(*) FROM cells_v) AS n_cells_in, (SELECT count(*) FROM k) AS n_cells_out, 'cell_circles' AS input_shape_key, 'tissue' AS output_shape_key FROM k",
    "cells_v",
    "tissues_v",
)
def q_stage_transform(spark, sf):
    """The tissue stage on written elements, whose tissue has a transform."""
    shapes = _points(spark, sf).withColumnRenamed("cell_id", "shape_id")
    return _stage(spark, sf, "tissue_inside", {"cell_circles": shapes, "tissue": _tissue(spark, sf, "tissues_v").select("rings")}, (2.0, 0.0, 0.0, 2.0, 10.0, -20.0))


@query(f"SELECT {HELD} AS split, global_idx, cell_id FROM manifest_v", "manifest_v")
def q_export_split(spark, sf):
    """A physical copy by split, read by its partitions."""
    folder = _scratch(spark, "export")
    pipelines.export_split(_manifest(spark, sf), _held(spark, sf), folder)
    return spark.read.parquet(folder).select("split", "global_idx", "cell_id")


@query(
    f"""
    , s AS (SELECT global_idx, sample_id, CASE WHEN global_idx % 97 = 0 THEN 'test' ELSE {HELD} END AS split FROM manifest_v WHERE global_idx % 101 <> 0),
      l AS (SELECT sample_id FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1)
    SELECT (SELECT string_agg(sample_id, ',' ORDER BY sample_id) FROM (SELECT sample_id FROM l ORDER BY 1 LIMIT 5)) AS leaking, (SELECT count(*) FROM manifest_v WHERE global_idx % 101 = 0) AS n_uncovered,
           CAST(1 AS BIGINT) AS n_phantom, CAST(0 AS BIGINT) AS n_repeated, (SELECT count(*) > 0 FROM l) AS leaks
    """,
    "manifest_v",
)
def q_leakage_report(spark, sf):
    """What the checks find of a membership that lost cells, has one too many and puts some on the wrong side."""
    m = _held(spark, sf).filter("global_idx % 101 <> 0").withColumn("split", F.when(F.col("global_idx") % 97 == 0, "test").otherwise(F.col("split")))
    more = m.limit(1).withColumns({"global_idx": F.lit(-1).cast("bigint"), "split": F.lit("train"), "sample_id": F.lit("src0")})
    r = splits.leakage_report(m.unionByName(more), _manifest(spark, sf), "sample_holdout")
    row = (",".join(r["samples_in_several_splits"]), r["n_uncovered"], r["n_phantom"], r["n_repeated"], r["leaks"])
    return spark.createDataFrame([row], "leaking string, n_uncovered bigint, n_phantom bigint, n_repeated bigint, leaks boolean")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS image_sha256 FROM documents")
def q_converted(spark, sf):
    """A column of bytes through a codec and back."""
    rows = read_table(spark, sf, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("image"))
    back = tiles.convert(tiles.convert(rows, zlib.compress), zlib.decompress)
    return back.select("doc_id", F.sha2("image", 256).alias("image_sha256"))


@query(f"SELECT cell_id FROM (SELECT cell_id, row_number() OVER (ORDER BY md5('{SEED}:' || cell_id), cell_id) AS k FROM cells_v) WHERE k <= 36", "cells_v")
def q_grid_sample(spark, sf):
    """The cells of a check's grid of six by six: of 40 that are asked for, whole rows."""
    return overlays.grid_sample(_cells(spark, sf), 40, SEED, square=True).select("cell_id")
