"""Queries over samples that are written and read again: extraction, reports, compiled and packaged data, splits.

Two samples are made of the cells' view: equal ids and positions in both; the second has its axes
exchanged, its shapes in another order and none for a fifth of its cells.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions import scalars as S
from .operators import genes, manifest, metrics, overlays, pipelines, spatial, splits
from .plans import planner
from .registry import ALL, BASE, FLIP, HELD, REQUESTS, SEED, STAMP, TASK, _cells, _documents, _flipped, _genes, _held, _manifest, _ordered, _shards, query
from .session import checkpoint_dir, read_table
from .sources import catalog, files, shard_source, shards, store, tiles
from .streaming import ingest
from .views import view

PATCH, MPP, PER_SHARD = 200, 0.5, 50
LISTS = {"s1": [f"g{k}" for k in range(10)], "s2": [f"g{9 - k}" for k in range(8)]}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/queries/{name}-{uuid.uuid4().hex}"


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    own = _cells(spark, sf)
    x, y = F.col("x_px") * 20, F.col("y_px") * 20
    expression = [F.array((F.col("pos") % 8).cast("int")).alias("indices"), F.array(F.col("pos").cast("float")).alias("values")]
    cells = own.select(F.lit("s1").alias("sample_id"), "cell_id", "pos", *expression).union(own.select(F.lit("s2"), "cell_id", "pos", *expression))
    first = own.select(F.lit("s1").alias("sample_id"), F.col("cell_id").alias("shape_id"), "pos", x.alias("x_px"), y.alias("y_px"))
    return cells, first.union(own.filter("pos % 5 <> 0").select(F.lit("s2"), "cell_id", 1_000_000 - F.col("pos"), y, x))


def _slides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("s1", 20000.0, 20000.0), ("s2", 16000.0, 18000.0)], "sample_id string, width double, height double").withColumn("base", F.lit(2000.0))


#: All cells with a shape, and what the strict policy says of them.
PLACED = """
    , placed AS (SELECT 's1' AS sample_id, cell_id, pos, pos AS shape_pos, x_px * 20 AS x, y_px * 20 AS y, 20000.0 AS w, 20000.0 AS h FROM cells_v
                 UNION ALL SELECT 's2', cell_id, pos, 1000000 - pos, y_px * 20, x_px * 20, 16000.0, 18000.0 FROM cells_v WHERE pos % 5 <> 0),
      told AS (SELECT *, x > 0 AND y > 0 AS positive, x + 1000 <= 0 OR x - 1000 >= w OR y + 1000 <= 0 OR y - 1000 >= h AS full_oob,
                      x - 1000 < 0 OR y - 1000 < 0 OR x + 1000 > w OR y + 1000 > h AS crosses FROM placed),
      kept AS (SELECT *, CAST(floor(greatest(0.0, y - 1000) / 4096) * 10000 + floor(greatest(0.0, x - 1000) / 4096) AS BIGINT) AS tile_key FROM told WHERE positive AND NOT full_oob AND NOT crosses),
      extracted AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY tile_key, pos) - 1 AS i FROM kept),
      compiled AS (SELECT *, row_number() OVER (ORDER BY sample_id, i) - 1 AS global_idx, CASE WHEN sample_id = 's1' THEN pos % 8 ELSE 9 - pos % 8 END AS g FROM extracted)
"""


@query(
    PLACED + "SELECT sample_id, cell_id, i AS sample_index, printf('%07d', i) AS sample_key, CAST(x AS DOUBLE) AS center_x_pixel, CAST(y - 1000 AS DOUBLE) AS bbox_y0, pos AS gene_row_index, 'shard-' || printf('%06d', i // 500) || '.tar' AS shard_path FROM extracted",
    "cells_v",
)
def q_extract_samples(spark, sf):
    rows, _ = pipelines.extract(*_parts(spark, sf), slides=_slides(spark))
    return rows.select("sample_id", "cell_id", "sample_index", "sample_key", "center_x_pixel", "bbox_y0", "gene_row_index", "shard_path")


COUNTS = """
    , source AS (SELECT count(*) AS n FROM cells_v),
      counts AS (SELECT sample_id, count(*) AS n_aligned, CAST(count_if(positive) AS BIGINT) AS n_positive, CAST(count_if(positive AND NOT full_oob AND NOT crosses) AS BIGINT) AS n_valid,
                        CAST(count_if(NOT positive) AS BIGINT) AS d_centroid, CAST(count_if(full_oob) AS BIGINT) AS d_oob, CAST(count_if(crosses AND NOT full_oob) AS BIGINT) AS d_pad FROM told GROUP BY 1)
"""


@query(PLACED + COUNTS + "SELECT sample_id, n AS n_source, n_aligned, n_positive, n_valid, least(n_valid, 20) AS n_out, d_centroid AS drop_non_positive_centroid, d_oob AS drop_full_oob, d_pad AS drop_need_pad FROM counts, source", "cells_v")
def q_extract_report(spark, sf):
    """Counts by sample, with 20 cells asked of each."""
    _, report = pipelines.extract(*_parts(spark, sf), slides=_slides(spark), n_sample=20)
    return report.select("sample_id", "n_source", "n_aligned", "n_positive", "n_valid", "n_out", "drop_non_positive_centroid", "drop_full_oob", "drop_need_pad")


@query(PLACED + ", r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY md5('42:' || cell_id), cell_id) AS k FROM kept) SELECT sample_id, cell_id FROM r WHERE k <= 20", "cells_v")
def q_sample_each(spark, sf):
    """Twenty cells of each sample."""
    rows, _ = pipelines.extract(*_parts(spark, sf), slides=_slides(spark), n_sample=20, seed=SEED)
    return rows.select("sample_id", "cell_id")


_BUILT: dict[tuple, str] = {}


def _reader(sample: str, crops) -> list[bytes]:
    """A tile's stand-in: the header of a JPEG of the patch's size, one in eight of another, and the cell's name."""
    size = lambda c: PATCH + 8 * (int(c) % 8 == 0)
    return [b"\xff\xd8\xff\xc0\x00\x0b\x08" + size(c).to_bytes(2, "big") + size(c).to_bytes(2, "big") + b"\x01\x01\x11\x00" + f"{sample}:{c}".encode() for c in crops["cell_id"]]


def _once(step: str, spark: SparkSession, sf: str, make) -> str:
    """The folder that a step makes, once for a session and a data directory."""
    at = (spark.sparkContext.applicationId, sf, step)
    if at not in _BUILT:
        _BUILT[at] = make()
    return _BUILT[at]


def _elements(spark: SparkSession, sf: str) -> str:
    """Both samples as elements."""

    def make() -> str:
        root = scratch(spark, "samples")
        cells, shapes = _parts(spark, sf)
        tissue = spark.range(1).select(G.box(*(F.lit(float(v)) for v in (0, 0, 9000, 12000))).alias("rings"))
        for row in _slides(spark).collect():
            s, own = row.sample_id, lambda d: d.filter(F.col("sample_id") == row.sample_id).drop("sample_id")  # noqa: B023
            catalog.write_element(own(cells), f"{root}/in", s, "tables", "table")
            catalog.write_element(own(shapes), f"{root}/in", s, "shapes", "cell_circles")
            catalog.write_element(tissue, f"{root}/in", s, "shapes", "tissue")
            catalog.write_element(own(cells).filter("pos % 3 = 0").select(F.col("cell_id").alias("shape_id")), f"{root}/in", s, "shapes", "nucleus_boundaries")
            # Turned by a 3-4-5 triangle: 0.1 microns a pixel once, then twice as coarse.
            levels = [(k, row.height / 2**k, row.width / 2**k, 0.03, 0.04, -0.04, 0.03, 1.0, 1.0) for k in range(3)]
            catalog.write_element(spark.createDataFrame(levels, "level int, height double, width double, a00 double, a10 double, a01 double, a11 double, s00 double, s11 double"), f"{root}/in", s, "images", "slide")
            catalog.write_element(spark.createDataFrame(levels[:1], "level int, height double, width double, a00 double, a10 double, a01 double, a11 double, s00 double, s11 double"), f"{root}/full", s, "images", "slide")
        sizes = pipelines.slides_of(spark, f"{root}/full", ["s1", "s2"], PATCH, MPP)
        sizes.write.mode("overwrite").parquet(f"{root}/slides.parquet")
        # The levels of an image are for inspection; extraction reads the full one.
        for s in ("s1", "s2"):
            for kind, key in (("tables", "table"), ("shapes", "cell_circles")):
                catalog.write_element(catalog.element(spark, f"{root}/in", s, kind, key).drop("sample_id"), f"{root}/full", s, kind, key)
        return root

    return _once("elements", spark, sf, make)


def _extracted(spark: SparkSession, sf: str) -> str:
    """The elements, and beside them both samples extracted."""

    def make() -> str:
        root = _elements(spark, sf)
        pipelines.extract_all(spark, f"{root}/full", f"{root}/out", ["s1", "s2"], patch=PATCH, mpp=MPP, shard_size=PER_SHARD, read=_reader)
        for s, names in LISTS.items():
            store.write_json(f"{root}/out/{s}/genes.json", names)
        return root

    return _once("extracted", spark, sf, make)


def _root(spark: SparkSession, sf: str) -> str:
    """Both samples as elements, extracted, compiled and bundled."""

    def make() -> str:
        root = _extracted(spark, sf)
        pipelines.compile_folder(spark, f"{root}/out", f"{root}/out/compiled", source=shards.read_shards(spark, f"{root}/out"))
        return root

    return _once("compiled", spark, sf, make)


@query("SELECT s AS sample_id, cell_id, pos FROM cells_v, (VALUES ('s1'), ('s2')) AS v(s)", "cells_v")
def q_elements(spark, sf):
    """Tables of all samples, written under keys and read again."""
    return catalog.elements(spark, f"{_elements(spark, sf)}/in", ["s1", "s2"], "tables", "table").select("sample_id", "cell_id", "pos")


@query(
    """
    , k AS (SELECT * FROM (VALUES ('tables', 'table', 4), ('shapes', 'cell_circles', 4), ('shapes', 'tissue', 1), ('shapes', 'nucleus_boundaries', 1), ('images', 'slide', 9)) AS v(kind, key, n_cols)),
      n AS (SELECT count(*) AS n, count_if(pos % 5 <> 0) AS n2, count_if(pos % 3 = 0) AS n3 FROM cells_v)
    SELECT kind, key, CAST(CASE key WHEN 'table' THEN n WHEN 'cell_circles' THEN n2 WHEN 'nucleus_boundaries' THEN n3 WHEN 'tissue' THEN 1 ELSE 3 END AS BIGINT) AS n_rows, CAST(n_cols AS BIGINT) AS n_cols,
           CAST(CASE WHEN kind = 'images' THEN 18000 END AS BIGINT) AS height, CAST(CASE WHEN kind = 'images' THEN 16000 END AS BIGINT) AS width, CAST(CASE WHEN kind = 'images' THEN 3 END AS BIGINT) AS n_levels FROM k, n
    """,
    "cells_v",
)
def q_inspect(spark, sf):
    return catalog.inspect(spark, f"{_elements(spark, sf)}/in", "s2")


@query(
    """
    SELECT s AS sample_id, p AS patch, m AS mpp_target, CAST(0.05 AS DOUBLE) AS slide_mpp, CAST(round_even(p * m / CAST(0.05 AS DOUBLE), 0) AS BIGINT) AS base_size
    FROM (VALUES ('s1'), ('s2')) AS a(s), (VALUES (200), (224)) AS b(p), (VALUES (CAST(0.25 AS DOUBLE)), (0.5)) AS c(m)
    """
)
def q_turned_slides(spark, sf):
    """Microns a pixel of slides whose affine is turned, read from what was written."""
    root, out = _elements(spark, sf), []
    for p in (200, 224):
        for m in (0.25, 0.5):
            out.append(pipelines.slides_of(spark, f"{root}/full", ["s1", "s2"], p, m).select("sample_id", F.lit(p).alias("patch"), F.lit(m).alias("mpp_target"), F.round("slide_mpp", 12).alias("slide_mpp"), F.col("base").cast("bigint").alias("base_size")))
    return manifest.union_samples(out)


@query(
    PLACED
    + COUNTS
    + """
    SELECT sample_id, 'tile_images' AS extract_mode, 'table' AS source_table_key, 'cell_circles' AS source_shape_key, 'auto' AS patch_policy_requested, 'strict_no_padding' AS patch_policy_applied, 'slide' AS image_key,
           n AS n_cells_source, n_aligned AS n_after_shape_alignment, n_positive AS n_after_positive_centroid, n_valid AS n_after_patch_policy, n_valid AS n_out,
           '{' || '"full_oob":' || d_oob || ',"need_pad":' || d_pad || ',"non_positive_centroid":' || d_centroid || ',"requested_subsample":0' || CASE WHEN n > n_aligned THEN ',"unaligned_with_shapes":' || (n - n_aligned) ELSE '' END || '}' AS drops,
           CAST(200 AS BIGINT) AS patch_size, CAST(0.5 AS DOUBLE) AS target_mpp, CAST(0.05 AS DOUBLE) AS slide_mpp, CAST(2000 AS BIGINT) AS base_size,
           CAST(CASE sample_id WHEN 's1' THEN 20000 ELSE 16000 END AS BIGINT) AS image_width_px, CAST(CASE sample_id WHEN 's1' THEN 20000 ELSE 18000 END AS BIGINT) AS image_height_px, CAST(42 AS BIGINT) AS seed, CAST(23 AS BIGINT) AS n_keys, true AS has_paths
    FROM counts, source
    """,
    "cells_v",
)
def q_filter_report_full(spark, sf):
    """The written report of every sample, with all its keys."""
    root = _extracted(spark, sf)
    out = []
    for s in ("s1", "s2"):
        r = store.read_json(f"{root}/out/{s}/meta/filter_report.json")
        paths = r.pop("output_dir") == f"{root}/out/{s}" and r.pop("zarr_path") == f"{root}/full/{s}" and r.pop("warnings") == []
        drops = json.dumps(r.pop("drop_counts_by_reason"), sort_keys=True, separators=(",", ":"))
        out.append({**r, "slide_mpp": round(r["slide_mpp"], 12), "drops": drops, "n_keys": len(r) + 4, "has_paths": paths})
    return spark.createDataFrame(out, "sample_id string, extract_mode string, source_table_key string, source_shape_key string, patch_policy_requested string, patch_policy_applied string, image_key string, n_cells_source bigint, n_after_shape_alignment bigint, n_after_positive_centroid bigint, n_after_patch_policy bigint, n_out bigint, drops string, patch_size bigint, target_mpp double, slide_mpp double, base_size bigint, image_width_px bigint, image_height_px bigint, seed bigint, n_keys bigint, has_paths boolean")


@query(
    PLACED
    + """
    , t AS (SELECT *, x > 0 AND x < 9000 AND y > 0 AND y < 12000 AS inside FROM placed),
      a AS (SELECT sample_id, CAST(count_if(inside) AS BIGINT) AS n1, CAST(count_if(inside AND pos % 3 = 0) AS BIGINT) AS n2 FROM t GROUP BY 1), n AS (SELECT count(*) AS n FROM cells_v)
    SELECT sample_id, 'tissue_inside' AS stage, 'table_tissue' AS output_key, n AS n_in, n1 AS n_out, 'outside_tissue' AS reason, n - n1 AS dropped FROM a, n
    UNION ALL SELECT sample_id, 'nucleus_presence', 'table_tissue_nucleus', n1, n2, 'missing_nucleus_boundary', n1 - n2 FROM a
    """,
    "cells_v",
)
def q_filter_stages(spark, sf):
    """Two stages, each on the table that the one before wrote, as their reports tell."""
    root, copy, folder, out = _elements(spark, sf), scratch(spark, "stages"), scratch(spark, "reports"), []
    for s in ("s1", "s2"):
        for kind, key in (("tables", "table"), ("shapes", "cell_circles"), ("shapes", "tissue"), ("shapes", "nucleus_boundaries")):
            catalog.write_element(catalog.element(spark, f"{root}/in", s, kind, key).drop("sample_id"), copy, s, kind, key)
        key = "table"
        for stage in pipelines.STAGES[:2]:
            r = pipelines.run_stage(spark, copy, s, stage, key, report_dir=f"{folder}/{s}")
            told = store.read_json(f"{folder}/{s}/{stage}_{key}.json")
            key = r.output_table_key
            (reason, n), *_ = told["drop_counts_by_reason"].items()
            out.append((s, told["stage"], told["output_table_key"], told["n_cells_in"], told["n_cells_out"], reason, n))
    return spark.createDataFrame(out, "sample_id string, stage string, output_key string, n_in bigint, n_out bigint, reason string, dropped bigint")


@query("SELECT 's1' AS sample_id, 'skipped' AS state UNION ALL SELECT 's2', 'skipped' UNION ALL SELECT 's3', 'done'")
def q_skip_done(spark, sf):
    """Of three samples two were extracted before."""
    root = _elements(spark, sf)
    for kind, key in (("tables", "table"), ("shapes", "cell_circles"), ("images", "slide")):
        catalog.write_element(catalog.element(spark, f"{root}/full", "s1", kind, key).drop("sample_id"), f"{root}/full", "s3", kind, key)
    out, folder = scratch(spark, "some"), f"{root}/full"
    for s in ("s1", "s2"):
        pipelines.extract_all(spark, folder, out, [s], patch=PATCH, mpp=MPP)
    got = pipelines.extract_all(spark, folder, out, ["s1", "s2", "s3"], patch=PATCH, mpp=MPP)
    return spark.createDataFrame([(s, state) for state, names in got.items() for s in names], "sample_id string, state string")


@query(PLACED + "SELECT sample_id, 'done' AS state, count(*) AS n_cells FROM extracted GROUP BY 1 UNION ALL SELECT 's3', 'failed', 0 UNION ALL SELECT 's4', 'failed', 0", "cells_v")
def q_extract_status(spark, sf):
    """Two samples are extracted though one beside them has other ids than its shapes, and another has no shapes."""
    root, copy, out = _elements(spark, sf), scratch(spark, "status"), scratch(spark, "status-out")
    for s, of in (("s1", "s1"), ("s2", "s2"), ("s3", "s1"), ("s4", "s1")):
        for kind, key in (("tables", "table"), ("shapes", "cell_circles"), ("images", "slide")):
            rows = catalog.element(spark, f"{root}/full", of, kind, key).drop("sample_id")
            if (s, kind) == ("s3", "shapes"):
                rows = rows.withColumn("shape_id", F.concat(F.lit("other-"), "shape_id"))
            if (s, kind) != ("s4", "shapes"):
                catalog.write_element(rows, copy, s, kind, key)
    pipelines.extract_all(spark, copy, out, ["s1", "s2", "s3", "s4"], patch=PATCH, mpp=MPP)
    told = store.read_json(f"{out}/extract_status.json")
    state = spark.createDataFrame([(s, x["state"]) for s, x in told.items()], "sample_id string, state string")
    counts = spark.read.parquet(*(f"{out}/{s}/manifest.parquet" for s, x in told.items() if x["state"] == "done")).groupBy("sample_id").agg(F.count("*").alias("n_cells"))
    return state.join(counts, "sample_id", "left").fillna(0, ["n_cells"])


@query(PLACED + "SELECT global_idx, sample_id, cell_id, 'g' || g AS gene, CAST(g - 2 AS INTEGER) AS gene_idx, CAST(pos AS FLOAT) AS value FROM compiled WHERE g BETWEEN 2 AND 9", "cells_v")
def q_compiled(spark, sf):
    """Manifest and expression of the compiled dataset, by the names on its panel."""
    folder = f"{_root(spark, sf)}/out/compiled"
    panel = F.lit(genes.read_panel(f"{folder}/gene_panel.json"))
    rows = manifest.with_expression(files.read_manifest(spark, f"{folder}/manifest.parquet"), spark.read.parquet(f"{folder}/expression.parquet"))
    each = rows.select("global_idx", "sample_id", "cell_id", F.explode(F.arrays_zip("indices", "values")).alias("e"))
    return each.select("global_idx", "sample_id", "cell_id", F.element_at(panel, F.col("e.indices") + 1).alias("gene"), F.col("e.indices").alias("gene_idx"), F.col("e.values").alias("value"))


@query(
    PLACED + """, s AS (SELECT sample_id, count(*) AS n FROM compiled GROUP BY 1)
    SELECT 'first_sample' AS gene_order_policy, CAST(2 AS BIGINT) AS n_samples, 's1,s2' AS sample_ids, CAST(sum(n) AS BIGINT) AS n_cells, CAST(8 AS BIGINT) AS n_genes,
           sha256('["g2","g3","g4","g5","g6","g7","g8","g9"]') AS gene_panel_sha256, CAST(sum(ceil(n / 500.0)) AS BIGINT) AS n_shards, true AS timed FROM s""",
    "cells_v",
)
def q_compile_report(spark, sf):
    r = store.read_json(f"{_root(spark, sf)}/out/compiled/compile_report.json")
    row = (r["gene_order_policy"], r["n_samples"], ",".join(r["sample_ids"]), r["n_cells"], r["n_genes"], r["gene_panel_sha256"], r["n_shards"], r["elapsed_s"] > 0 and r["bytes"] > 0)
    return spark.createDataFrame([row], "gene_order_policy string, n_samples bigint, sample_ids string, n_cells bigint, n_genes bigint, gene_panel_sha256 string, n_shards bigint, timed boolean")


@query(
    PLACED + """
    SELECT printf('%09d', global_idx) AS global_key, sample_id, cell_id, printf('%07d', i) AS sample_key, CAST(8 AS BIGINT) AS n_genes, CAST(CASE WHEN g BETWEEN 2 AND 9 THEN 1 ELSE 0 END AS BIGINT) AS n_nonzero,
           sample_id || '/shard-' || printf('%06d', i // 500) || '.tar' AS shard_path, sha256('["g2","g3","g4","g5","g6","g7","g8","g9"]') AS gene_panel_sha256, sample_id || ':' || cell_id AS image_tail FROM compiled""",
    "cells_v",
)
def q_bundled_payload(spark, sf):
    """What the bundled shards hold of each cell, beside where the bundled manifest says that it is."""
    folder = f"{_root(spark, sf)}/out/compiled"
    inside = shards.members(shards.read_shards(spark, folder))
    text = F.col("payload").cast("string")
    meta = inside.filter("ext = 'json'").select(F.col("key").alias("global_key"), F.from_json(text, "sample_id string, cell_id string, sample_key string, n_genes bigint, n_nonzero bigint, gene_panel_sha256 string").alias("m"))
    tail = inside.filter("ext = 'jpg'").select(F.col("key").alias("global_key"), F.expr("decode(substring(payload, 16), 'UTF-8')").alias("image_tail"))
    listed = spark.read.parquet(f"{folder}/bundled_manifest.parquet").select("global_key", "shard_path")
    return meta.join(tail, "global_key").join(listed, "global_key").select("global_key", "m.*", "shard_path", "image_tail")


@query(PLACED + "SELECT global_idx, cell_id, CAST(8 AS BIGINT) AS n_values, CAST(CASE WHEN g BETWEEN 2 AND 9 THEN pos ELSE 0 END AS DOUBLE) AS total FROM compiled WHERE sample_id = 's2'", "cells_v")
def q_load_dataset(spark, sf):
    """Dense expression of one sample."""
    rows = pipelines.load_dataset(spark, f"{_root(spark, sf)}/out/compiled", ["s2"])
    return rows.select("global_idx", "cell_id", F.size("expression").cast("bigint").alias("n_values"), F.aggregate("expression", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query(PLACED + "SELECT global_idx, sample_id, cell_id FROM compiled WHERE sample_id = 's2'", "cells_v")
def q_package_split(spark, sf):
    """A package whose split is made afterwards, loaded as its configuration says."""
    root, folder = _root(spark, sf), scratch(spark, "package")
    listed = spark.read.parquet(f"{root}/out/compiled/bundled_manifest.parquet").withColumn("shard_path", F.element_at(F.split("shard_path", "/"), -1))
    pipelines.package(listed, genes.read_panel(f"{root}/out/compiled/gene_panel.json"), folder, task=TASK, defer_split=True)
    pipelines.make_split(spark.read.parquet(f"{folder}/manifest.parquet"), folder, task=TASK, policy="sample_holdout", train=["s1"], val=["s2"])
    return pipelines.load_split(spark, folder, "val").select("global_idx", "sample_id", "cell_id")


@query(
    PLACED + "SELECT sample_id, i AS sample_index, 'shard-' || printf('%06d', i // 50) || '.tar' AS shard_path, cell_id, sample_id || ':' || cell_id AS image_tail FROM extracted",
    "cells_v",
)
def q_shard_source(spark, sf):
    """The cells of all samples' shards, by ranges of their index files."""
    cells = shard_source.read_cells(spark, f"{_root(spark, sf)}/out", cells=20)
    return cells.select("sample_id", "sample_index", "shard_path", F.get_json_object("meta", "$.cell_id").alias("cell_id"), F.expr("decode(substring(image, 16), 'UTF-8')").alias("image_tail"))


@query(
    PLACED + """
    SELECT global_idx, sample_id, cell_id, 'shard-' || printf('%06d', dense_rank() OVER (ORDER BY sample_id, i // 500) - 1) || '.tar' AS shard_path, sample_id || ':' || cell_id AS image_tail FROM compiled
    """,
    "cells_v",
)
def q_package_shards(spark, sf):
    """Every cell's image from a package of two samples, whose shards had the same names: manifest and shards are read as written."""
    compiled, folder = f"{_root(spark, sf)}/out/compiled", scratch(spark, "package")
    listed = spark.read.parquet(f"{compiled}/bundled_manifest.parquet").withColumn("shard_path", F.element_at(F.split("shard_path", "/"), -1))
    pipelines.package(listed, genes.read_panel(f"{compiled}/gene_panel.json"), folder, task=TASK, defer_split=True, source=compiled)
    inside = shard_source.read_cells(spark, folder).filter("sample_id = 'shards'")
    cells = inside.select("shard_path", F.col("sample_index").alias("global_idx"), F.expr("decode(substring(image, 16), 'UTF-8')").alias("image_tail"))
    rows = spark.read.parquet(f"{folder}/manifest.parquet").select("global_idx", "sample_id", "cell_id", "shard_path")
    return rows.join(cells, ["shard_path", "global_idx"]).select("global_idx", "sample_id", "cell_id", "shard_path", "image_tail")


@query(PLACED + ", m AS (SELECT DISTINCT sample_id, i // 500 AS k FROM compiled) SELECT 'training_ready' AS status, 'available' AS split, 'sample' AS level, true AS needs_split, 'gene_expression' AS target, CAST(8 AS BIGINT) AS n_genes, count(*) AS n_shards FROM m", "cells_v")
def q_package_configs(spark, sf):
    root, folder = _root(spark, sf), scratch(spark, "package")
    listed = spark.read.parquet(f"{root}/out/compiled/bundled_manifest.parquet").withColumn("shard_path", F.element_at(F.split("shard_path", "/"), -1))
    membership = splits.sample_holdout(listed, TASK, ["s1"], ["s2"])
    card = pipelines.package(listed, genes.read_panel(f"{root}/out/compiled/gene_panel.json"), folder, task=TASK, membership=membership)
    loader, task = files.read_config(f"{folder}/loader_config.yaml"), files.read_config(f"{folder}/task_config.yaml")
    row = (loader["training_ready_status"], loader["split"]["status"], loader["split"]["generated_at_level"], loader["runtime"]["split_argument_required"], task["target_modality"], task["n_genes"], card["n_shards"])
    return spark.createDataFrame([row], "status string, split string, level string, needs_split boolean, target string, n_genes bigint, n_shards bigint")


@query(PLACED + "SELECT sample_id, cell_id, CAST(trunc((x - 1000) / 4) AS INTEGER) AS crop_x, CAST(trunc((y - 1000) / 4) AS INTEGER) AS crop_y, CAST(500 AS INTEGER) AS crop_w, true AS resized FROM kept", "cells_v")
def q_tile_crops(spark, sf):
    """Where a reader of a level four times coarser crops the tiles."""
    rows, _ = pipelines.extract(*_parts(spark, sf), slides=_slides(spark))
    return tiles.crops(rows, F.lit(2000.0), PATCH, F.lit(4.0)).select("sample_id", "cell_id", "crop_x", "crop_y", "crop_w", "resized")


@query(
    PLACED + """
    SELECT e.sample_id, e.cell_id, CAST(CASE WHEN n.shape_id IS NOT NULL THEN v.k END AS INTEGER) AS vertex,
           CASE WHEN n.shape_id IS NOT NULL THEN ((x + v.dx) * 1.0 - (x - 1000)) * 200 / 2000 END AS px, CASE WHEN n.shape_id IS NOT NULL THEN ((y + v.dy) * 1.0 - (y - 1000)) * 200 / 2000 END AS py
    FROM kept e LEFT JOIN nucleus_ids_v n ON n.shape_id = e.cell_id, (VALUES (0, -5, -5), (1, 5, -5), (2, 5, 5), (3, -5, 5)) AS v(k, dx, dy)
    WHERE n.shape_id IS NOT NULL OR v.k = 0""",
    "cells_v",
    "nucleus_ids_v",
)
def q_boundary_lookup(spark, sf):
    """Outlines of cells that have one, in the pixels of their patches; the others without a vertex."""
    cells, shapes = _parts(spark, sf)
    rows, _ = pipelines.extract(cells, shapes, slides=_slides(spark))
    has = shapes.join(view(spark, sf, "nucleus_ids_v"), "shape_id", "left_semi")
    rings = has.select("sample_id", "shape_id", G.box(F.col("x_px") - 5, F.col("y_px") - 5, F.col("x_px") + 5, F.col("y_px") + 5).alias("rings"))
    return overlays.outlines(rows, rings, "nucleus", scale=F.lit(1.0), patch=F.lit(200), base=F.lit(2000)).select("sample_id", "cell_id", "vertex", "px", "py")


@query(PLACED + "SELECT count(*) AS n_checked, CAST(count_if(pos % 8 <> 0) AS BIGINT) AS n_rendered, CAST(0 AS BIGINT) AS missing_members, CAST(0 AS BIGINT) AS decode_errors, CAST(count_if(pos % 8 = 0) AS BIGINT) AS bad_image_size FROM extracted", "cells_v")
def q_qc_counts(spark, sf):
    """The images of all extracted cells: one in eight has another size."""
    root = _extracted(spark, sf)
    rows = spark.read.parquet(f"{root}/out/s1/manifest.parquet").unionByName(spark.read.parquet(f"{root}/out/s2/manifest.parquet"))
    named = manifest.union_samples([shards.read_shards(spark, f"{root}/out/{s}") for s in ("s1", "s2")])
    got = overlays.qc_counts(rows, named, PATCH)
    overlays.write_viz_report(scratch(spark, "viz"), got, tables={}, overlay_keys=[])
    return got


@query(PLACED + "SELECT sample_id, cell_id, i AS sample_index, sample_id || ':' || cell_id AS tail FROM extracted", "cells_v")
def q_read_ranges(spark, sf):
    """Images by the offsets that extraction put into the manifest, read from the shards' files."""
    root = _extracted(spark, sf)
    rows = spark.read.parquet(f"{root}/out/s1/manifest.parquet").unionByName(spark.read.parquet(f"{root}/out/s2/manifest.parquet"))
    places = rows.select("sample_id", "cell_id", "sample_index", "shard_path", "tar_offset", "jpg_size")
    return shards.read_range(places, f"{root}/out").select("sample_id", "cell_id", "sample_index", F.expr("decode(substring(payload, 16), 'UTF-8')").alias("tail"))


@query(PLACED + "SELECT sample_id, printf('%07d', i) AS sample_key, sample_id || ':' || cell_id AS tail, CAST(pos % 8 AS BIGINT) AS gene FROM extracted", "cells_v")
def q_contrastive(spark, sf):
    """Both views of every cell from one shard."""
    rows, _ = pipelines.extract(*_parts(spark, sf), slides=_slides(spark), shard_size=PER_SHARD)
    full = tiles.read_tiles(rows, _reader).withColumns({"indices": F.array((F.col("gene_row_index") % 8).cast("int")), "values": F.array(F.lit(1.0).cast("float"))})
    pairs = tiles.contrastive_pairs(rows.select("sample_id", "shard_path", "sample_key"), shards.build_shards(full))

    def first(batches):
        for b in batches:
            yield b.assign(gene=[int(shards.unpack_sparse(bytes(x))[0][0]) for x in b["expression"]])[["sample_id", "sample_key", "image", "gene"]]

    return pairs.mapInPandas(first, "sample_id string, sample_key string, image binary, gene bigint").select("sample_id", "sample_key", F.expr("decode(substring(image, 16), 'UTF-8')").alias("tail"), "gene")


# Splits as files.


@query(f"SELECT {HELD} AS split, global_idx FROM manifest_v", "manifest_v")
def q_split_files(spark, sf):
    """The lists of all three splits, from the files."""
    paths = splits.write_split(_held(spark, sf), scratch(spark, "split"), TASK)
    return manifest.union_samples([splits.read_split_list(spark, paths[s]).select(F.lit(s).alias("split"), "global_idx") for s in ("train", "val", "test")])


@query(f"SELECT 'expression' AS task, 'sample_holdout' AS split_policy, 'sample' AS generated_at_level, sample_id, {HELD} AS split, count(*) AS n_cells, (SELECT count(*) FROM manifest_v) AS n_cells_total FROM manifest_v GROUP BY 4, 5", "manifest_v")
def q_split_report(spark, sf):
    report = store.read_json(splits.write_split(_held(spark, sf), scratch(spark, "split"), TASK)["report"])
    rows = [(report["task"], report["split_policy"], report["generated_at_level"], r["sample_id"], r["split"], r["n_cells"], report["n_cells_total"]) for r in report["per_sample_counts"]]
    return spark.createDataFrame(rows, "task string, split_policy string, generated_at_level string, sample_id string, split string, n_cells bigint, n_cells_total bigint")


@query(
    f"SELECT global_idx, sample_id, cell_id, CASE WHEN sample_id < 'src15' THEN 'train' ELSE 'test' END AS split, {STAMP.format('existing_file', 'sample')} FROM manifest_v",
    "manifest_v",
)
def q_split_file_csv(spark, sf):
    """An assignment by sample from a file; a sample's first row counts."""
    path = f"{scratch(spark, 'given')}/split.csv"
    names = [f"src{i}" for i in range(20)]
    lines = [f"{s},{'train' if s < 'src15' else 'test'}\n{s},val\n" for s in names]
    store.write_text(path, "sample_id,split\n" + "".join(lines))
    return splits.existing(_manifest(spark, sf), TASK, files.read_split_file(spark, path))


@query(f"SELECT string_agg(sample_id, ',' ORDER BY sample_id) AS samples, CAST(0 AS BIGINT) AS n_uncovered, CAST(0 AS BIGINT) AS n_repeated, count(*) > 0 AS leaks FROM (SELECT sample_id FROM (SELECT sample_id FROM manifest_v GROUP BY 1 HAVING count(DISTINCT {FLIP}) > 1 ORDER BY 1 LIMIT 5))", "manifest_v")
def q_leakage_report(spark, sf):
    m = _manifest(spark, sf)
    r = splits.leakage_report(_flipped(spark, sf).drop("fold"), m, "sample_holdout")
    return spark.createDataFrame([(",".join(r["samples_in_several_splits"]), r["n_uncovered"], r["n_repeated"], r["leaks"])], "samples string, n_uncovered bigint, n_repeated bigint, leaks boolean")


def _numpy_order(seed: int = SEED) -> str:
    """The order in which numpy's default generator puts the sorted names of the test tables' sources."""
    names = np.array(sorted(f"src{i}" for i in range(20)), dtype=object)
    np.random.default_rng(seed).shuffle(names)
    return "(VALUES " + ", ".join(f"('{s}', {r})" for r, s in enumerate(names.tolist())) + ") AS o(group_id, r)"


@query(f"SELECT global_idx, sample_id, cell_id, group_id, CASE WHEN r < 16 THEN 'train' WHEN r < 18 THEN 'val' ELSE 'test' END AS split, {STAMP.format('ratio_by_group', 'group')}, 42 AS seed FROM manifest_v JOIN {_numpy_order()} ON group_id = sample_id", "manifest_v")
def q_ratio_numpy(spark, sf):
    return splits.ratio_by_group(_manifest(spark, sf), TASK, "sample_id", ordering="numpy")


@query(f"SELECT global_idx, sample_id, cell_id, group_id, CAST(r % 5 AS INTEGER) AS fold, 'fold_' || (r % 5) AS split, {STAMP.format('group_kfold', 'group')}, 42 AS seed FROM manifest_v JOIN {_numpy_order()} ON group_id = sample_id", "manifest_v")
def q_kfold_numpy(spark, sf):
    return splits.group_kfold(_manifest(spark, sf), TASK, "sample_id", ordering="numpy")


# What single rows of the manifest and the panel say.


@query(f"SELECT gene, CAST(4 - r AS BIGINT) AS gene_idx, true AS valid FROM (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS r FROM ({ALL})) WHERE r < 5", "genes_v")
def q_explicit_panel(spark, sf):
    """A given panel, in its own order, that every sample has; equal to itself by its hash and order."""
    given = [r.gene for r in genes.sorted_panel(_genes(spark, sf)).orderBy("gene_idx").limit(5).collect()][::-1]
    panel = genes.resolve_panel(_genes(spark, sf), "explicit", explicit=given)
    genes.validate_panel(panel, given)
    return spark.createDataFrame([(g, i) for i, g in enumerate(panel)], "gene string, gene_idx bigint").withColumn("valid", F.lit(True))


@query(f"SELECT sha256('[\"' || string_agg(gene, '\",\"' ORDER BY gene) || '\"]') AS sha, count(*) AS n_genes, true AS same FROM ({ALL})", "genes_v")
def q_panel_files(spark, sf):
    """A panel and its hash, written and read again."""
    folder, panel = scratch(spark, "panel"), genes.resolve_panel(_genes(spark, sf), "sorted")
    genes.write_panel(folder, panel)
    return spark.createDataFrame([(store.read_text(f"{folder}/gene_panel.sha256"), len(panel), genes.read_panel(f"{folder}/gene_panel.json") == panel)], "sha string, n_genes bigint, same boolean")


@query("SELECT cell_id, '{\"cell_id\":\"' || cell_id || '\",\"pos\":' || pos || '}' AS meta FROM cells_v", "cells_v")
def q_cell_json(spark, sf):
    return _cells(spark, sf).select("cell_id", S.cell_json("cell_id", "pos").alias("meta"))


@query("SELECT pos, 'fold_' || (pos % 5) AS label, CASE WHEN pos % 5 = 2 THEN 'val' ELSE 'train' END AS held FROM cells_v", "cells_v")
def q_fold_label(spark, sf):
    fold = F.col("pos") % 5
    return _cells(spark, sf).select("pos", S.fold_label(fold).alias("label"), S.fold_label(fold, 2).alias("held"))


@query("SELECT lang AS label, lower(lpad(to_hex(dense_rank() OVER (ORDER BY lang) - 1), 2, '0')) || '000000' AS payload FROM documents GROUP BY lang")
def q_class_payload(spark, sf):
    """A class as it stands in a shard: four bytes, the least first."""
    labels = metrics.label_map(read_table(spark, sf, "documents"), "lang")
    cells = labels.select(F.lit("s").alias("sample_id"), F.lit("x.tar").alias("shard_path"), F.col("label").alias("sample_key"), F.col("label_id").alias("sample_index"), F.col("label").alias("cell_id"), F.lit(b"i").alias("image"), F.col("label_id").cast("int").alias("class_idx"))
    return shards.members(shards.build_shards(cells)).filter("ext = 'cls'").select(F.col("key").alias("label"), F.lower(F.hex("payload")).alias("payload"))


DIGEST = " || ',' || ".join(f"CAST(sum(CAST('0x' || substr(d, {11 * k + 1}, {min(11, 64 - 11 * k)}) AS HUGEINT)) AS VARCHAR)" for k in range(6))


@query(
    f"SELECT sha256({DIGEST}) AS digest, count(*) AS n_rows FROM (SELECT sha256(length(CAST(global_idx AS VARCHAR)) || ':' || global_idx || length(sample_id) || ':' || sample_id || length(cell_id) || ':' || cell_id) AS d FROM manifest_v)",
    "manifest_v",
)
def q_freeze_digest(spark, sf):
    """One hash of a manifest, whatever the order of its rows."""
    return metrics.table_digest(_manifest(spark, sf).repartition(3), "global_idx", "sample_id", "cell_id")


@query("SELECT count(*) AS cells, CAST(count(DISTINCT source || '/' || (i // 100)) AS BIGINT) AS shards, true AS timed FROM (SELECT source, row_number() OVER (ORDER BY source, doc_id) - 1 AS i FROM documents)")
def q_profile(spark, sf):
    """How much a reader got through: cells and shards, with the seconds."""
    _, built = _shards(spark, sf)
    got = pipelines.profile(built)
    return spark.createDataFrame([(got["cells"], got["shards"], got["cells_per_s"] > 0)], "cells bigint, shards bigint, timed boolean")


@query(
    f"""
    , o AS (SELECT cell_id, pos, row_number() OVER (ORDER BY tile_key, pos) - 1 AS i FROM (SELECT cell_id, pos, CAST(floor(greatest(0.0, y_px * 20 - 50) / 4096) * 10000 + floor(greatest(0.0, x_px * 20 - 50) / 4096) AS BIGINT) AS tile_key FROM cells_v)),
      r AS (SELECT CASE WHEN pos % 40 = 0 THEN 'same' ELSE printf('%07d', i) END AS k, CASE WHEN pos % 25 = 0 THEN 'twice' ELSE cell_id END AS c, CASE WHEN pos % 90 = 0 THEN 7.0 ELSE 0.0 END AS e, pos FROM o)
    SELECT count(*) AS n_rows, count(*) - count(DISTINCT k) AS dup_keys, count(*) - count(DISTINCT c) AS dup_cells, CAST(count_if(pos % 50 = 0) AS BIGINT) AS id_mismatches, CAST(max(e) AS DOUBLE) AS max_bbox_error FROM r
    """,
    "cells_v",
)
def q_integrity_found(spark, sf):
    """A manifest with repeated keys and cells, wrong ids and a box that is off."""
    pos = F.col("pos")
    rows = _ordered(spark, sf).select(
        "sample_index", F.when(pos % 40 == 0, "same").otherwise(S.padded(F.col("sample_index"), 7)).alias("sample_key"), F.when(pos % 25 == 0, "twice").otherwise(F.col("cell_id")).alias("cell_id"), pos.alias("gene_row_index"),
        F.col("x_px").alias("center_x_pixel"), F.col("y_px").alias("center_y_pixel"), (F.col("x_px") - 50 + F.when(pos % 90 == 0, 7.0).otherwise(0.0)).alias("bbox_x0"), (F.col("y_px") - 50).alias("bbox_y0"),
    )
    expression = rows.select(F.col("sample_index").alias("expr_row"), F.when(F.col("gene_row_index") % 50 != 0, F.col("cell_id")).otherwise("wrong").alias("cell_id"))
    return manifest.integrity(rows, expression, BASE)


@query(
    """
    , c AS (SELECT x.cell_id, h.x0 - x.x0 AS a0, h.x1 - x.x0 AS a1, h.y0 - x.y0 AS b0, h.y1 - x.y0 AS b1 FROM xen_v x JOIN he_v h ON x.x0 <= h.x1 AND h.x0 <= x.x1 AND x.y0 <= h.y1 AND h.y0 <= x.y1),
      p AS (SELECT cell_id, greatest(least(a1, 10) - greatest(a0, 0), 0) * greatest(least(b1, 4) - greatest(b0, 0), 0) + greatest(least(a1, 4) - greatest(a0, 0), 0) * greatest(least(b1, 10) - greatest(b0, 4), 0) AS i FROM c)
    SELECT cell_id, round(max(i / (64 + 100 - i)), 9) AS max_iou FROM p GROUP BY 1
    """,
    "xen_v",
    "he_v",
)
def q_iou_concave(spark, sf):
    """Cells in the shape of an L against boxes."""
    corner = lambda dx, dy: G.point(F.col("x0") + dx, F.col("y0") + dy)
    cells = view(spark, sf, "xen_v").withColumn("ring", F.array(*(corner(x, y) for x, y in ((0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)))))
    boxes = view(spark, sf, "he_v").withColumn("ring", G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))[0])
    return spatial.max_iou(cells, boxes).select("cell_id", F.round("max_iou", 9).alias("max_iou"))


@query("SELECT source AS sample_id, count(*) AS n_cells FROM documents GROUP BY 1")
def q_stream_counts(spark, sf):
    """Manifests as they land in a folder, read as a stream that ends when all are read, without repeats."""
    folder = scratch(spark, "landing")
    rows = _documents(spark, sf).select("sample_id", "cell_id", F.lit("x").alias("shard_path"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"))
    rows.union(rows.filter("CAST(cell_id AS BIGINT) % 2 = 0")).write.parquet(f"{folder}/in")
    stream = ingest.deduplicated(ingest.manifest_stream(spark, f"{folder}/in", rows.schema), "at")
    ingest.append_to(stream, f"{folder}/out", f"{folder}/state").awaitTermination()
    return ingest.cells_by_sample(spark.read.parquet(f"{folder}/out")).select("sample_id", "n_cells")


@query("SELECT request, 'table' || CASE WHEN t THEN '_tissue' ELSE '' END || CASE WHEN n THEN '_nucleus' ELSE '' END || CASE WHEN h THEN '_he' ELSE '' END AS final_table_key FROM (SELECT request, regexp_matches(lower(request), 'inside tissue|out of tissue|outside tissue|tissue filter|tissue region|filter.*tissue') AS t, regexp_matches(lower(request), 'with nucleus boundaries|has nucleus|only cells with nucleus|nucleus boundar|nucleus presence') AS n, regexp_matches(lower(request), 'xenium nucleus.*he nucleus|he nucleus|nucleus overlap|overlap\\s*>') AS h FROM (VALUES " + ", ".join("('" + r.replace("'", "''") + "')" for r in REQUESTS) + ") AS v(request))")
def q_plan_keys(spark, sf):
    return planner.plan_requests(spark.createDataFrame([(r,) for r in REQUESTS], "request string")).select("request", "final_table_key")


TASKS = ["an HE2ST model", "classify each cell type", "self-supervised pairs", "a foundation model", "the neighborhood graph", "spatial transcriptomics prediction", "tiles only"]


@query(
    "SELECT request, CASE WHEN contains(r, 'he2st') OR contains(r, 'spatial transcriptomics prediction') THEN 'he2st' WHEN contains(r, 'cell type') THEN 'celltype' WHEN contains(r, 'self-supervised') OR contains(r, 'contrastive') THEN 'contrastive' WHEN contains(r, 'foundation model') THEN 'multimodal_pretraining' WHEN contains(r, 'neighborhood graph') THEN 'spatial_neighbor' END AS task_type FROM (SELECT request, lower(request) AS r FROM (VALUES "
    + ", ".join(f"('{t}')" for t in TASKS)
    + ") AS v(request))"
)
def q_task_types(spark, sf):
    return spark.createDataFrame([(t,) for t in TASKS], "request string").select("request", planner.task_type_column(F.col("request")).alias("task_type"))


@query(
    "SELECT * FROM (VALUES (0, 'inspect --root /d --samples A B'), (1, 'filter tissue_inside --root /d --samples A B --in table --out table_tissue --tissue-key tissue'), (2, 'extract --root /d --samples A B --output out --mpp 0.5 --patch-size 224 --table-key table_tissue'), (3, 'compile --root out --output out/compiled --bundle')) AS v(step, command)"
)
def q_commands(spark, sf):
    plan = planner.parse("cells inside tissue, mpp 0.5 patch size 224, bundle")
    return spark.createDataFrame(list(enumerate(planner.render(plan, ["A", "B"], "/d"))), "step int, command string")
