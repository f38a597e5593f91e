"""Many samples end to end: equal ids and positions in two samples, stages, commands, shards, bundles and packages."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotloom import __main__ as cli
from spotloom.functions import geometry as G
from spotloom.operators import align, filters, manifest, metrics, overlays, pipelines, reports, spatial, splits
from spotloom.plans import planner
from spotloom.sources import catalog, files, shards, store, tiles

POINTS = {"A": [(40, 40), (60, 60), (-50, 10), (-5, 10), (1, 10), (95, 95), (30, 70), (70, 30)], "B": [(50, 50), (20, 20), (180, 90), (10, 10), (100, 100), (5, 5), (150, 60), (90, 90)]}
SIZE = {"A": 100, "B": 200}


def cells_of(spark, shuffled=("B",)):
    """Two samples with equal ids and positions; in one the shapes come in another order."""
    rows = [(s, f"c{k}", k, [k % 3], [float(k + 1)]) for s in POINTS for k in range(8)]
    cells = spark.createDataFrame(rows, "sample_id string, cell_id string, pos bigint, indices array<int>, values array<float>")
    at = lambda s, k: 7 - k if s in shuffled else k
    places = [(s, f"c{k}", at(s, k), x + 10.0, y + 10.0) for s, p in POINTS.items() for k, (x, y) in enumerate(p)]
    return cells, spark.createDataFrame(places, "sample_id string, shape_id string, pos bigint, x_px double, y_px double")


def slides(spark):
    return spark.createDataFrame([(s, float(n), float(n), 20.0, 0.5) for s, n in SIZE.items()], "sample_id string, width double, height double, base double, slide_mpp double")


def kept(sample):
    """The strict policy, in plain words: a positive centre, and all of the tile on the slide."""
    n = SIZE[sample]
    return {f"c{k}" for k, (x, y) in enumerate(POINTS[sample]) if x + 10 > 0 and y + 10 > 0 and min(x, y) >= 0 and max(x, y) + 20 <= n}


def write_samples(spark, root):
    cells, shapes = cells_of(spark)
    for s, n in SIZE.items():
        own = lambda d: d.filter(F.col("sample_id") == s).drop("sample_id")  # noqa: B023, E731
        catalog.write_element(own(cells), root, s, "tables", "table")
        catalog.write_element(own(shapes).withColumns({"x": F.col("x_px"), "y": F.col("y_px")}), root, s, "shapes", "cell_circles")
        catalog.write_element(spark.createDataFrame([(float(n), float(n), 1.0, 0.0, 0.0, 1.0, 2.0, 2.0, 0)], "width double, height double, a00 double, a01 double, a10 double, a11 double, s00 double, s11 double, level int"), root, s, "images", "slide")
        catalog.write_element(spark.range(1).select(G.box(*(F.lit(float(v)) for v in (0, 0, 75, 75))).alias("rings")), root, s, "shapes", "tissue")
        catalog.write_element(spark.createDataFrame([(f"c{k}",) for k in range(0, 8, 2)], "shape_id string"), root, s, "shapes", "nucleus_boundaries")


def test_samples_with_equal_ids_keep_apart(spark):
    cells, shapes = cells_of(spark)
    found, _ = align.align_samples(cells, shapes)
    assert {r.sample_id: r["mode"] for r in found.collect()} == {"A": "exact", "B": "intersection"}
    rows, report = pipelines.extract(cells, shapes, slides=slides(spark), shard_size=2)
    got = rows.collect()
    assert {s: {r.cell_id for r in got if r.sample_id == s} for s in POINTS} == {s: kept(s) for s in POINTS}
    for r in got:
        x, y = POINTS[r.sample_id][int(r.cell_id[1:])]
        assert (r.center_x_pixel, r.center_y_pixel, r.bbox_x0, r.gene_row_index) == (x + 10, y + 10, x, int(r.cell_id[1:]))
    for s in POINTS:
        own = sorted((r for r in got if r.sample_id == s), key=lambda r: r.sample_index)
        assert [r.sample_index for r in own] == list(range(len(own))) and [r.cell_id for r in own] == sorted(kept(s))
    assert {r.sample_id: (r.n_source, r.n_aligned, r.n_out) for r in report.collect()} == {s: (8, 8, len(kept(s))) for s in POINTS}


def test_samples_are_drawn_one_by_one(spark):
    cells, shapes = cells_of(spark)
    rows, report = pipelines.extract(cells, shapes, slides=slides(spark), n_sample=3)
    assert {r.sample_id: r["count"] for r in rows.groupBy("sample_id").count().collect()} == {"A": 3, "B": 3}
    assert {r.sample_id: filters.drop_reasons(r.asDict())["requested_subsample"] for r in report.collect()} == {s: len(kept(s)) - 3 for s in POINTS}
    with pytest.raises(AssertionError):
        pipelines.extract(cells, shapes, slides=slides(spark), n_sample=7)
    many = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("cell_id"), F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("sample_id"))
    got = {(r.sample_id, r.cell_id) for r in filters.sample_each(many, 50, 1, "cell_id").collect()}
    order = many.orderBy(F.md5(F.concat(F.lit("1:"), "cell_id")), "cell_id").collect()
    assert got == {(s, r.cell_id) for s in "AB" for r in [x for x in order if x.sample_id == s][:50]}
    drawn = filters.numpy_sample(spark.range(200).withColumnRenamed("id", "pos"), 9, 5, "pos").orderBy("draw").collect()
    assert [r.pos for r in drawn] == np.random.default_rng(5).choice(200, 9, replace=False).tolist()


def test_samples_are_aligned_once(spark, tmp_path):
    """Manifest and report read the cells that were aligned, and don't each read the shapes again; one sample is exact, one isn't."""
    cells, shapes = cells_of(spark)
    shapes.write.parquet(f"{tmp_path}/shapes.parquet")
    for n in (0, 3):
        rows, report = pipelines.extract(cells, spark.read.parquet(f"{tmp_path}/shapes.parquet"), slides=slides(spark), n_sample=n)
        assert rows.inputFiles() == report.inputFiles() == []
        assert rows.count() == (n * 2 or sum(len(kept(s)) for s in POINTS))
        assert {r.sample_id: (r.n_source, r.n_aligned, r.n_valid) for r in report.collect()} == {s: (8, 8, len(kept(s))) for s in POINTS}


def test_alignment_errors_show_examples(spark):
    cells, shapes = cells_of(spark)
    wrong = shapes.withColumn("shape_id", F.when(F.col("sample_id") == "B", F.concat(F.lit("x"), "shape_id")).otherwise(F.col("shape_id")))
    with pytest.raises(ValueError, match=r"\['B'\].*c0.*xc"):
        align.align_samples(cells, wrong)


def test_spatial_filters_keep_samples_apart(spark):
    cells, shapes = cells_of(spark)
    points = shapes.select("sample_id", "shape_id", F.col("x_px").alias("x"), F.col("y_px").alias("y"))
    tissue = spark.createDataFrame([("A", 0.0, 0.0, 75.0, 75.0)], "sample_id string, x0 double, y0 double, x1 double, y1 double").select("sample_id", G.box(*(F.col(c) for c in ("x0", "y0", "x1", "y1"))).alias("rings"))
    got = {(r.sample_id, r.cell_id) for r in spatial.tissue_filter(cells, points, tissue, grid=16.0).collect()}
    assert got == {("A", f"c{k}") for k, (x, y) in enumerate(POINTS["A"]) if 0 < x + 10 < 75 and 0 < y + 10 < 75}
    assert spatial.tissue_counts(cells, points, tissue).first().asDict() == {"n_in": 16, "n_kept": len(got), "outside_tissue": 16 - len(got)}
    box = lambda rows: spark.createDataFrame(rows, "sample_id string, cell_id string, x0 double, y0 double, x1 double, y1 double")
    a, b = box([("A", "c0", 0.0, 0.0, 10.0, 10.0), ("B", "c0", 0.0, 0.0, 10.0, 10.0)]), box([("A", "h", 1.0, 1.0, 10.0, 10.0)])
    assert [(r.sample_id, r.cell_id) for r in spatial.overlap_filter(cells, a, b).collect()] == [("A", "c0")]
    assert spatial.overlap_counts(cells, a, b).first().asDict() == {"n_in": 16, "n_kept": 1, "no_nucleus": 14, "low_overlap": 1}


def test_points_in_a_jagged_ring_against_all_sides(spark):
    """An outline of many sides over many grid cells, tried against every side for every point."""
    r = np.random.default_rng(0)
    angle = np.sort(r.random(400)) * 2 * np.pi
    ring = np.stack([300 + np.cos(angle) * r.uniform(100, 280, 400), 300 + np.sin(angle) * r.uniform(100, 280, 400)], 1)
    points = r.uniform(0, 600, (800, 2))
    poly = spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in ring]],)], "rings array<array<struct<x:double,y:double>>>")
    df = spark.createDataFrame(pd.DataFrame({"id": range(800), "x": points[:, 0], "y": points[:, 1]}))
    q = np.roll(ring, -1, 0)
    odd = [sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, q, strict=True)) % 2 for x, y in points]
    for grid in (20.0, 64.0, 1000.0):
        assert {x.id for x in spatial.inside(df, poly, grid).collect()} == {i for i, o in enumerate(odd) if o}


def test_overlap_of_concave_rings():
    u = np.array([(0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6)], float)
    bar = np.array([(-1, 4), (7, 4), (7, 5), (-1, 5)], float)
    assert abs(G.overlap_area(u, bar) - 4) < 1e-9 and abs(G.overlap_area(bar, u[::-1]) - 4) < 1e-9 and abs(G.overlap_area(u, u) - 28) < 1e-9
    assert G.overlap_area(u, bar + 100) == 0
    r = np.random.default_rng(2)
    for _ in range(20):
        angle = lambda: np.sort(r.random(9)) * 2 * np.pi
        star = lambda: (lambda t: np.stack([np.cos(t), np.sin(t)], 1) * r.uniform(0.4, 1, 9)[:, None] + r.uniform(-0.3, 0.3, 2))(angle())
        a, b = star(), star()
        grid = np.stack(np.meshgrid(np.linspace(-1.4, 1.4, 561), np.linspace(-1.4, 1.4, 561)), -1).reshape(-1, 2)
        inside = lambda ring: sum(((p[1] > grid[:, 1]) != (s[1] > grid[:, 1])) & (grid[:, 0] < (s[0] - p[0]) * (grid[:, 1] - p[1]) / (s[1] - p[1] if s[1] != p[1] else 1) + p[0]) for p, s in zip(ring, np.roll(ring, -1, 0), strict=True)) % 2 == 1
        assert abs(G.overlap_area(a, b) - (inside(a) & inside(b)).sum() * (2.8 / 560) ** 2) < 0.03


def jpeg(width, height):
    """The header of a JPEG, which is all that the checks read."""
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + b"\x01\x01\x11\x00"


def reader(sample, crops):
    return [jpeg(20, 20) + f"{sample}:{c}".encode() for c in crops["cell_id"]]


def test_commands_from_samples_to_a_split(spark, tmp_path):
    """inspect, filter, extract, compile with bundles, package and make-split, each on what the one before wrote."""
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_samples(spark, root)
    seen = cli.inspect(["--root", root, "--report-dir", str(tmp_path / "r")])
    assert [s["sample_id"] for s in seen] == ["A", "B"] and seen[0]["images"] == [{"key": "slide", "height": 100, "width": 100, "n_levels": 1}]
    assert json.loads((tmp_path / "r" / "A" / "inspect_report.json").read_text())["tables"] == [{"key": "table", "n_obs": 8, "n_vars": 4}]
    said = cli.filter_(["tissue_inside", "--root", root, "--report-dir", str(tmp_path / "r")])
    inside = {s: {f"c{k}" for k, (x, y) in enumerate(p) if 0 < x + 10 < 75 and 0 < y + 10 < 75} for s, p in POINTS.items()}
    assert [(r["n_in"], r["n_out"]) for r in said] == [(8, len(inside["A"])), (8, len(inside["B"]))]
    assert json.loads((tmp_path / "r" / "A" / "tissue_inside_table.json").read_text())["drop_counts_by_reason"] == {"outside_tissue": 8 - len(inside["A"])}
    cli.filter_(["nucleus_presence", "--root", root, "--in", "table_tissue"])
    assert {r.cell_id for r in catalog.element(spark, root, "A", "tables", "table_tissue_nucleus").collect()} == inside["A"] & {"c0", "c2", "c4", "c6"}
    with pytest.raises(ValueError, match="no cells overlap"):
        pipelines.filter_stage("nucleus_presence", catalog.element(spark, root, "A", "tables", "table"), {"nuclei": spark.createDataFrame([("q",)], "shape_id string")})

    asked = ["--root", root, "--output", out, "--mpp", "0.25", "--patch-size", "20"]
    assert planner.parse_args(asked).patch_policy == "strict_no_padding"
    args = dict(patch=20, mpp=0.5, shard_size=2, read=reader)
    assert pipelines.extract_all(spark, root, out, ["A", "B"], **args) == {"done": ["A", "B"], "skipped": []}
    assert cli.extract(asked) == {"done": [], "skipped": ["A", "B"]}
    report = json.loads((tmp_path / "out" / "A" / "meta" / "filter_report.json").read_text())
    assert sorted(report) == sorted(reports.FILTER_REPORT) and len(report) == 23
    assert (report["n_cells_source"], report["n_out"], report["base_size"], report["patch_policy_applied"]) == (8, len(kept("A")), 20, "strict_no_padding")
    rows = spark.read.parquet(f"{out}/A/manifest.parquet")
    assert {"tar_offset", "jpg_size"} <= set(rows.columns) and rows.count() == len(kept("A"))
    places = rows.select("sample_id", "shard_path", "tar_offset", "jpg_size", "cell_id")
    assert {bytes(r.payload).split(b"\x00")[-1].decode() for r in shards.read_range(places, out).collect()} == {f"A:{c}" for c in kept("A")}
    for s in POINTS:
        store.write_json(f"{out}/{s}/genes.json", ["g1", "g0", "g2"] if s == "A" else ["g0", "g1", "gx"])
    made = cli.compile_(["--root", out, "--output", f"{out}/compiled", "--bundle"])
    n = sum(len(kept(s)) for s in POINTS)
    assert (made["n_cells"], made["n_genes"], made["n_shards"], made["sample_ids"]) == (n, 2, 2, ["A", "B"]) and made["elapsed_s"] > 0 and made["bytes"] > 0
    listed = spark.read.parquet(f"{out}/compiled/bundled_manifest.parquet")
    assert [r.global_idx for r in listed.orderBy("global_idx").collect()] == list(range(n))
    whole = shards.read_shards(spark, f"{out}/compiled")
    meta = {r.key: json.loads(bytes(r.payload)) for r in shards.members(whole).filter("ext = 'json'").collect()}
    assert sorted(meta) == [f"{k:09d}" for k in range(n)] and set(meta["000000000"]) == {"global_idx", "sample_id", "cell_id", "sample_key", "n_genes", "n_nonzero", "gene_panel_sha256"}
    # Expression by hand: the cell's gene, by its sample's list, if it is on the panel.
    panel = json.loads((tmp_path / "out" / "compiled" / "gene_panel.json").read_text())
    assert panel == ["g1", "g0"]
    lists = {"A": ["g1", "g0", "g2"], "B": ["g0", "g1", "gx"]}
    for row in shards.members(whole).filter("ext = 'expr.npz'").collect():
        m = meta[row.key]
        k = int(m["cell_id"][1:])
        gene = lists[m["sample_id"]][k % 3]
        expected = ([panel.index(gene)], [float(k + 1)]) if gene in panel else ([], [])
        got = shards.unpack_sparse(bytes(row.payload))
        assert (got[0].tolist(), got[1].tolist()) == expected and m["n_nonzero"] == len(expected[0])
    data = pipelines.load_dataset(spark, f"{out}/compiled")
    item = pipelines.row_at(data, 0)
    assert item["sample_id"] == "A" and len(item["expression"]) == 2
    with pytest.raises(IndexError):
        pipelines.row_at(data, 999)

    compiled = files.read_manifest(spark, f"{out}/compiled/manifest.parquet")
    folder = str(tmp_path / "package")
    flat = listed.withColumn("shard_path", F.element_at(F.split("shard_path", "/"), -1))
    card = pipelines.package(flat, panel, folder, task="he2st", defer_split=True, source=whole.withColumn("cidx", F.lit(b"")))
    assert card["training_ready_status"] == "split_pending"
    with pytest.raises(RuntimeError, match="split_pending"):
        pipelines.load_split(spark, folder, "train")
    assert cli.make_split(["--package", folder, "--policy", "sample_holdout", "--train", "A", "--val", "B"])["training_ready_status"] == "training_ready"
    assert pipelines.load_split(spark, folder, "val").count() == len(kept("B"))
    config = files.read_config(f"{folder}/loader_config.yaml")
    assert config["runtime"] == {"split_argument_required": True} and config["split"]["generated_at_level"] == "sample" and config["split"]["required"] is True
    assert files.read_config(f"{folder}/task_config.yaml")["input_modality"] == "he_image" and files.read_config(f"{folder}/task_config.yaml")["n_genes"] == 2
    first = pipelines.freeze(folder, spark)
    assert first == pipelines.freeze(folder, spark) and first["n_cells"] == n
    assert pipelines.profile(whole)["cells"] == n
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
    bad = splits.sample_holdout(flat, "t", ["A"], ["B"]).withColumn("split", F.when(F.col("global_idx") == 0, "val").otherwise(F.col("split")))
    assert pipelines.package(flat, panel, str(tmp_path / "bad"), task="t", membership=bad)["training_ready_status"] == "validation_failed"
    assert splits.leakage_report(bad, flat, "sample_holdout")["samples_in_several_splits"] == ["A"]
    pipelines.export_split(compiled, splits.sample_holdout(compiled, "t", ["A"], ["B"]), str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).filter("split = 'val'").count() == len(kept("B"))


def shard_rows(spark, n=6):
    cells = spark.createDataFrame([("S", f"c{k}", k, f"{k:07d}", f"shard-{k // 3:06d}.tar", jpeg(20 + 4 * (k == 5), 20) if k != 4 else b"junk", [k], [float(k)], k % 2) for k in range(n)], "sample_id string, cell_id string, sample_index bigint, sample_key string, shard_path string, image binary, indices array<int>, values array<float>, class_idx int")
    return cells, shards.build_shards(cells)


def test_images_are_counted_and_lost_members_are_errors(spark):
    cells, built = shard_rows(spark)
    rows = cells.select("sample_id", "cell_id", "sample_key", "shard_path")
    assert shards.payloads(rows, built).filter("payload IS NULL").count() == 0
    more = rows.union(rows.limit(1).withColumn("sample_key", F.lit("0000099")))
    with pytest.raises(KeyError, match="0000099"):
        shards.payloads(more, built)
    assert overlays.qc_counts(more, built, 20).first().asDict() == {"n_checked": 7, "n_rendered": 4, "missing_members": 1, "decode_errors": 1, "bad_image_size": 1}
    report = overlays.write_viz_report
    assert overlays.grid_sample(rows, 25).count() == 6 and overlays.grid_sample(rows, 25, square=True).count() == 4 and callable(report)
    got = {r.sample_key: (shards.jpeg_size(bytes(r.image)), shards.unpack_sparse(bytes(r.expression))[0].tolist()) for r in tiles.contrastive_pairs(rows, built).collect()}
    assert got["0000002"] == ((20, 20), [2]) and got["0000005"] == ((24, 20), [5])
    classes = {r.key: bytes(r.payload) for r in shards.members(built).filter("ext = 'cls'").collect()}
    assert classes["0000003"] == b"\x01\x00\x00\x00"


def test_batches_for_a_loader(spark):
    _, built = shard_rows(spark)
    read = {"cls": lambda b: int.from_bytes(b, "little"), "expr.npz": lambda b: shards.unpack_sparse(b)[1].tolist(), "json": json.loads}
    batches = list(shards.samples_of(built, read, batch=4))
    cells = [c for b in batches for c in b]
    assert max(map(len, batches)) <= 4 and sorted(c["json"]["cell_id"] for c in cells) == [f"c{k}" for k in range(6)]
    assert all(c["cls"] == int(c["json"]["cell_id"][1:]) % 2 and c["expr.npz"] == [float(c["json"]["cell_id"][1:])] and isinstance(c["jpg"], bytes) for c in cells)
    shares = [[c["__key__"] for b in shards.samples_of(built, {}, worker=w, workers=2) for c in b] for w in range(2)]
    assert sorted(shares[0] + shares[1]) == sorted(c["__key__"] for c in cells) and not set(shares[0]) & set(shares[1])


def test_hooks_and_crops(spark):
    rows = spark.createDataFrame([("A", "c0", 10.9, -3.9), ("B", "c1", 0.0, 7.0)], "sample_id string, cell_id string, bbox_x0 double, bbox_y0 double")
    got = tiles.crops(rows, F.lit(20.0), 10, F.lit(2.0)).orderBy("cell_id").collect()
    assert [(r.crop_x, r.crop_y, r.crop_w, r.out_w, r.resized) for r in got] == [(5, -1, 10, 10, False), (0, 3, 10, 10, False)]
    images = tiles.read_tiles(rows, reader)
    assert {r.cell_id: bytes(r.image)[-4:] for r in images.collect()} == {"c0": b"A:c0", "c1": b"B:c1"}
    assert {bytes(r.image) for r in tiles.convert(images, lambda b: b[-4:]).collect()} == {b"A:c0", b"B:c1"}


def test_outlines_of_cells(spark):
    rows = spark.createDataFrame([("A", "c0", 0.0, 0.0), ("A", "c1", 10.0, 10.0), ("A", "c9", 0.0, 0.0)], "sample_id string, cell_id string, bbox_x0 double, bbox_y0 double")
    shape = spark.createDataFrame([("A", "c0", 1.0, 2.0), ("A", "c1", 3.0, 4.0), ("A", "c1", 30.0, 40.0), ("B", "c9", 0.0, 0.0)], "sample_id string, shape_id string, x double, y double")
    rings = shape.select("sample_id", "shape_id", G.box(F.col("x"), F.col("y"), F.col("x") + 1, F.col("y") + 1).alias("rings"))
    got = overlays.outlines(rows, rings, "nucleus", scale=F.lit(2.0), patch=F.lit(20), base=F.lit(10)).collect()
    assert len([r for r in got if r.cell_id == "c0"]) == 4 and len([r for r in got if r.cell_id == "c1"]) == 8
    assert [(r.part, r.px) for r in got if r.cell_id == "c9"] == [(None, None)]
    first = next(r for r in got if r.cell_id == "c1" and (r.part, r.vertex) == (1, 0))
    assert (first.px, first.py) == ((30 * 2 - 10) * 2, (40 * 2 - 10) * 2)
    boxes = overlays.tile_boxes(rows, F.lit(20.0)).filter("cell_id = 'c1'").first()
    assert (boxes.x0, boxes.x1) == (10, 30)


def test_split_lists_files_and_order(spark, tmp_path):
    m = spark.createDataFrame([(k, "AABBCC"[k], f"cell_{k}") for k in range(6)], "global_idx bigint, sample_id string, cell_id string")
    out = splits.split_membership(m, "sample_holdout", "t", train=["A", "B"], val=["C"])
    paths = splits.write_split(out, str(tmp_path / "s"), "t")
    assert [sorted(r.global_idx for r in splits.read_split_list(spark, paths[s]).collect()) for s in ("train", "val", "test")] == [[0, 1, 2, 3], [4, 5], []]
    one = splits.write_split_list(out, "train", str(tmp_path / "train.json"))
    assert json.loads(open(one).read()) == [0, 1, 2, 3] and sorted(r.global_idx for r in splits.read_split_list(spark, one).collect()) == [0, 1, 2, 3]
    report = json.loads(open(paths["report"]).read())
    assert report["n_cells_total"] == 6 and report["counts_by_split"] == {"train": 4, "val": 2} and report["per_sample_counts"][0] == {"sample_id": "A", "split": "train", "n_cells": 2} and report["created_at"]
    # The first row of the file counts, not the least name.
    (tmp_path / "s.csv").write_text("sample_id,split\nA,val\nA,train\nB,train\nB,test\nC,test\n")
    given = splits.existing(m, "t", files.read_split_file(spark, str(tmp_path / "s.csv")))
    assert {r.sample_id: r.split for r in given.collect()} == {"A": "val", "B": "train", "C": "test"}
    (tmp_path / "g.csv").write_text("global_idx,split\n" + "".join(f"{k},train\n" for k in range(6)) + "0,val\n")
    with pytest.warns(UserWarning, match="2 rows"):
        given = splits.existing(m, "t", files.read_split_file(spark, str(tmp_path / "g.csv")))
    assert {r.split for r in given.collect()} == {"train"} and given.count() == 6
    with pytest.warns(UserWarning, match="val"):
        splits.ratio_by_group(m, "t", "sample_id", (0.5, 0.45, 0.05))


def test_no_window_sees_all_rows(spark):
    """Ranks of many rows: no window without a partition but over tables of counts."""
    rows = spark.range(5000).select((F.col("id") * 37 % 5000).alias("pos"), (F.col("id") % 7).alias("tile_key"), F.lit("s").alias("sample_id"), (F.col("id") % 50).cast("double").alias("truth"), F.rand(1).alias("guess"), F.lit(1).alias("gene"))
    for df, expected in ((manifest.dense_index(rows, "sample_id", "pos", block=500), "global_idx"), (manifest.spatial_order(rows, "tile_key", "pos"), "sample_index")):
        got = sorted((r[expected], r.tile_key, r.pos) for r in df.collect())
        key = (lambda x: x[2]) if expected == "global_idx" else (lambda x: x[1:])
        assert [g[0] for g in got] == list(range(5000)) and got == sorted(got, key=key)
    groups = rows.select(F.col("pos").cast("string").alias("g"))
    ranked = {r.g: r["rank"] for r in manifest.hashed_ranks(groups, F.md5("g"), "g").collect()}
    order = [r.g for r in groups.orderBy(F.md5("g"), "g").collect()]
    assert [ranked[g] for g in order] == list(range(5000))
    values = rows.select("truth", "guess").toPandas()
    assert abs(metrics.spearman(rows).first().spearman - values["truth"].rank().corr(values["guess"].rank())) < 1e-9


def test_names_of_samples_and_tasks(spark, tmp_path):
    (tmp_path / "A_1.zarr").mkdir(), (tmp_path / "B_2.zarr").mkdir(), (tmp_path / "x").mkdir()
    assert [catalog.sample_name(p) for p in catalog.find_samples(spark, f"{tmp_path}/*.zarr")] == ["A_1", "B_2"]
    assert [catalog.sample_name(p) for p in catalog.find_samples(spark, f"{tmp_path}/*.zarr", ["B_2"])] == ["B_2"]
    with pytest.raises(ValueError):
        catalog.find_samples(spark, f"{tmp_path}/*.none")
    assert planner.task_type("self-supervised pretraining") == "contrastive" and planner.task_type("nothing") is None
    d = spark.createDataFrame([("cell type please",), ("none",)], "r string")
    assert [r.t for r in d.select(planner.task_type_column(F.col("r")).alias("t")).collect()] == ["celltype", None]
    assert planner.ready_status(False, extracted=True) == "patch_compiled_only" and planner.ready_status(True) == "compile_only"
    steps = cli.plan(["inside tissue, bundle", "--root", "/d", "--samples", "A"])
    for step in steps:
        name = step.split()[0]
        assert name in cli.COMMANDS
    cells, shapes = cells_of(spark)
    assert catalog.describe({("tables", "t"): cells}).first().n_rows == 16 and shapes.count() == 16


def planned_samples(spark, root):
    """Samples as commands expect them by default: an image of the default key with its tiles, and lists of genes."""
    write_samples(spark, root)
    for s in SIZE:
        catalog.write_element(catalog.element(spark, root, s, "images", "slide").drop("sample_id"), root, s, "images", "he_image")
        patches = [(f"c{k}", jpeg(20, 20) + f"{s}:c{k}".encode()) for k in range(8)]
        catalog.write_element(spark.createDataFrame(patches, "cell_id string, image binary"), root, s, "images", "he_image_patches")
        names = ["g1", "g0", "g2"] if s == "A" else ["g0", "g1", "gx"]
        spark.createDataFrame([(g, k) for k, g in enumerate(names)], "gene string, pos int").write.parquet(f"{root}/{s}/genes/table.parquet")


def test_a_printed_plan_runs_line_by_line(spark, tmp_path):
    """What ``plan`` prints is executed, and nothing else."""
    import shlex

    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    planned_samples(spark, root)
    for line in cli.plan(["cells inside tissue, mpp 0.5, patch size 20, bundle", "--root", root, "--output", out, "--samples", "A", "B"]):
        name, *argv = shlex.split(line)
        cli.COMMANDS[name](argv)
    inside = {s: {f"c{k}" for k, (x, y) in enumerate(POINTS[s]) if 0 < x + 10 < 75 and 0 < y + 10 < 75} & kept(s) for s in POINTS}
    report = json.loads((tmp_path / "out" / "A" / "meta" / "filter_report.json").read_text())
    assert (report["patch_policy_requested"], report["patch_policy_applied"], report["source_table_key"], report["image_key"]) == ("auto", "strict_no_padding", "table_tissue", "he_image")
    assert json.loads((tmp_path / "out" / "A" / "meta" / "overlay_keys.json").read_text()) == {"tissue": "tissue", "cell": "cell_circles", "nucleus": "nucleus_boundaries"}
    assert json.loads((tmp_path / "out" / "compiled" / "gene_panel.json").read_text()) == ["g1", "g0"]
    whole = shards.read_shards(spark, f"{out}/compiled")
    got = {bytes(r.payload).split(b"\x00")[-1].decode() for r in shards.members(whole).filter("ext = 'jpg'").collect()}
    assert got == {f"{s}:{c}" for s in POINTS for c in inside[s]}
    assert spark.read.parquet(f"{out}/compiled/manifest.parquet").count() == len(got)


def test_options_take_effect_or_are_refused(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    planned_samples(spark, root)
    asked = ["--root", root, "--output", out, "--mpp", "0.5", "--patch-size", "20"]
    for option, value, kind in (("--image-key", "nope", ValueError), ("--tissue-key", "nope", SystemExit), ("--cell-key", "nope", SystemExit), ("--nucleus-key", "nope", SystemExit), ("--cell-id-column", "nope", KeyError), ("--shapes-key", "nope", ValueError), ("--table-key", "nope", ValueError)):
        with pytest.raises(kind, match="nope"):
            cli.extract([*asked, option, value])
    named = catalog.element(spark, root, "A", "tables", "table").drop("sample_id").withColumn("barcode", F.col("cell_id")).withColumn("cell_id", F.lit("x"))
    catalog.write_element(named, root, "A", "tables", "other")
    assert cli.extract([*asked, "--samples", "A", "--table-key", "other", "--cell-id-column", "barcode", "--tissue-key", "none", "--filter-report-name", "f.json", "--shard-size", "2"]) == {"done": ["A"], "skipped": []}
    rows = spark.read.parquet(f"{out}/A/manifest.parquet").collect()
    assert {r.cell_id for r in rows} == kept("A") and max(r.shard_no for r in rows) == (len(kept("A")) - 1) // 2
    assert (tmp_path / "out" / "A" / "meta" / "f.json").exists() and json.loads((tmp_path / "out" / "A" / "meta" / "overlay_keys.json").read_text())["tissue"] is None
    with pytest.warns(UserWarning, match="A is done with .*'patch_size': 20"):
        cli.extract(["--root", root, "--output", out, "--samples", "A", "--table-key", "other", "--cell-id-column", "barcode", "--filter-report-name", "f.json"])


def test_a_broken_sample_does_not_fail_the_rest(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    planned_samples(spark, root)
    for name in ("no_shapes", "no_ids", "broken"):
        for kind, key in (("tables", "table"), ("shapes", "cell_circles"), ("images", "slide")):
            if (name, kind) != ("no_shapes", "shapes"):
                rows = catalog.element(spark, root, "A", kind, key).drop("sample_id")
                rows = rows.withColumn("shape_id", F.concat(F.lit("q"), "shape_id")) if (name, kind) == ("no_ids", "shapes") else rows
                catalog.write_element(rows, root, name, kind, key)
    for part in (tmp_path / "in" / "broken" / "tables" / "table.parquet").glob("part-*"):
        part.write_bytes(b"not a table")
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    every = ["A", "B", "broken", "no_ids", "no_shapes"]
    got = pipelines.extract_all(spark, root, out, every, patch=20, mpp=0.5)
    assert got == {"done": ["A", "B"], "skipped": [], "failed": ["broken", "no_ids", "no_shapes"]}
    told = json.loads((tmp_path / "out" / "extract_status.json").read_text())
    assert told["A"] == {"state": "done"} and "no id in common" in told["no_ids"]["reason"] and "cell_circles" in told["no_shapes"]["reason"] and told["broken"]["state"] == "failed"
    for s in POINTS:
        assert {r.cell_id for r in spark.read.parquet(f"{out}/{s}/manifest.parquet").collect()} == kept(s)
        assert spark.read.parquet(f"{out}/{s}/expression.parquet").count() == len(kept(s))
    assert not list((tmp_path / "out").glob("_staging*")) and not (tmp_path / "out" / "broken").exists()
    assert pipelines.extract_all(spark, root, out, ["A", "B"], patch=20, mpp=0.5) == {"done": [], "skipped": ["A", "B"]}
    with pytest.raises(ValueError, match="no sample could be extracted"):
        pipelines.extract_all(spark, root, out, ["no_ids"], patch=20, mpp=0.5)


def test_elements_need_no_extraction(spark, sf_dir, monkeypatch):
    """Queries over elements alone neither build shards nor compile."""
    from spotloom import registry, registry_samples

    def never(*_, **__):
        raise AssertionError("built for nothing")

    monkeypatch.setattr(registry_samples, "_BUILT", {})
    monkeypatch.setattr(registry_samples.pipelines, "compile_folder", never)
    monkeypatch.setattr(registry_samples.shards, "write_shards", never)
    for name in ("q_elements", "q_inspect", "q_turned_slides", "q_filter_stages", "q_skip_done", "q_extract_status"):
        assert registry.QUERIES[name](spark, sf_dir).count() > 0
