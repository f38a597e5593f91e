"""Operators on small fixtures with literal expectations."""

import json
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.functions import geometry as G
from spotloom.functions import scalars as S
from spotloom.functions import sparse
from spotloom.operators import align, filters, genes, manifest, metrics, pipelines, reports, spatial, splits
from spotloom.plans import planner
from spotloom.sources import catalog, files, shards


def column(df, name):
    return [r[name] for r in df.collect()]


# Filters.


def masks(spark, points, size=100.0, base=20.0, origin=True):
    rows = [(i, float(x + base / 2 if origin else x), float(y + base / 2 if origin else y)) for i, (x, y) in enumerate(points)]
    return filters.with_masks(spark.createDataFrame(rows, "i int, x_px double, y_px double"), size, size, base).orderBy("i")


def test_positive_centroid_is_strict(spark):
    d = masks(spark, [(10, 10), (-1, 5), (0, 5), (5, -1)], origin=False)
    assert column(d, "positive") == [True, False, False, False]


def test_strict_policy(spark):
    d = masks(spark, [(40, 40), (-50, 10), (-5, 10)])
    assert column(d, "full_oob") == [False, True, False]
    assert column(d, "need_pad") == [False, False, True]
    assert filters.policy_counts(d, "strict_no_padding").first().asDict() == {"full_oob": 1, "need_pad": 1}


def test_minimal_policy(spark):
    d = masks(spark, [(10, 10), (-5, 10), (95, 10), (-25, 10), (90, 90)])
    assert column(d.filter(filters.keeps("minimal")), "i") == [0, 1, 2, 4]
    assert "need_pad" not in filters.policy_counts(d, "minimal").columns


def test_end_to_end_filter(spark):
    d = masks(spark, [(40, 40), (60, 60), (-50, 10), (-5, 10), (0, 10), (95, 95)])
    assert column(filters.survivors(d.filter("sx0 > 0 or sx0 < 0")), "i") == [0, 1]


def test_policies_are_checked_before_any_job():
    assert filters.resolve_policy("auto") == "strict_no_padding"
    with pytest.raises(NotImplementedError):
        filters.validate_policy("strict_with_padding")
    with pytest.raises(ValueError):
        filters.validate_policy("minimal", "full_scale0")
    with pytest.raises(SystemExit):
        planner.parse_args(["--root", "r", "--output", "o", "--patch-policy", "minimal", "--extract-mode", "full_scale0"])
    assert planner.parse_args(["--root", "r", "--output", "o"]).patch_size == 224


def test_sample_picks():
    assert filters.pick_samples(["b", "a"], ["b", "a"]) == ["b", "a"]
    assert filters.pick_samples(["b", "a"], ["b", "x"], strict=False) == ["b"]
    for strict in (True, False):
        with pytest.raises(ValueError):
            filters.pick_samples(["a"], ["x"], strict)


def test_uniform_sample(spark):
    d = spark.range(50).withColumnRenamed("id", "k")
    assert filters.uniform_sample(d, 0, 1, "k").count() == 50
    assert column(filters.uniform_sample(d, 5, 1, "k"), "k") == column(filters.uniform_sample(d.repartition(3), 5, 1, "k"), "k")
    with pytest.raises(AssertionError):
        filters.uniform_sample(d, 51, 1, "k")


# Scalars.


def test_base_size_rounds_half_to_even(spark):
    d = spark.createDataFrame([(5.0, 0.5, 1.0), (7.0, 0.5, 1.0), (224.0, 0.5, 0.2125)], "p double, t double, m double")
    assert column(d.select(S.base_size(F.col("p"), F.col("t"), F.col("m")).alias("b")), "b") == [2, 4, 527]


def test_keys_keep_long_numbers(spark):
    d = spark.createDataFrame([(3,), (123456789012,)], "i bigint")
    assert column(d.select(S.padded(F.col("i"), 7).alias("k")), "k") == ["0000003", "123456789012"]


def test_panel_hash_is_that_of_compact_json(spark):
    d = spark.createDataFrame([(["A", "B"],)], "g array<string>")
    assert column(d.select(S.panel_sha256(F.col("g")).alias("h")), "h") == [genes.panel_sha256(["A", "B"])]


def test_unknown_column_lists_the_known(spark):
    with pytest.raises(KeyError, match="available"):
        S.with_cell_ids(spark.range(1), "cell_id")


# Alignment.


def layer(spark, ids, name):
    return spark.createDataFrame([(i, k) for k, i in enumerate(ids)], f"{name} string, pos bigint")


def test_exact_alignment_keeps_duplicates(spark):
    mode, out = align.align(layer(spark, ["a", "b", "b"], "cell_id"), layer(spark, ["a", "b", "b"], "shape_id"))
    assert mode == "exact" and sorted((r.row_pos, r.table_pos, r.shape_pos) for r in out.collect()) == [(0, 0, 0), (1, 1, 1), (2, 2, 2)]


def test_intersection_takes_last_positions(spark):
    mode, out = align.align(layer(spark, ["a", "b", "b", "z"], "cell_id"), layer(spark, ["b", "a", "b"], "shape_id"))
    assert mode == "intersection" and sorted((r.row_pos, r.table_pos, r.shape_pos) for r in out.collect()) == [(0, 0, 1), (1, 2, 2), (2, 2, 2)]


def test_no_common_id_is_an_error(spark):
    with pytest.raises(ValueError):
        align.align(layer(spark, ["a"], "cell_id"), layer(spark, ["b"], "shape_id"))


def test_presence(spark):
    cells, nuclei = layer(spark, ["c0", "c1", "c2", "c3", "c4"], "cell_id"), layer(spark, ["c0", "c2", "c4"], "shape_id")
    assert align.presence_counts(cells, nuclei).first().asDict() == {"n_in": 5, "n_kept": 3, "no_nucleus": 2}
    with pytest.raises(ValueError):
        align.require_rows(align.presence(cells, layer(spark, ["x"], "shape_id")))


# Geometry.


def ring(spark, points):
    return spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in points]],)], "rings array<array<struct<x:double,y:double>>>")


def test_points_on_an_edge_are_outside(spark):
    p = spark.createDataFrame([("in", 50.0, 50.0), ("out", 150.0, 150.0), ("near", 10.0, 10.0), ("edge", 0.0, 50.0), ("corner", 100.0, 100.0)], "id string, x double, y double")
    square = ring(spark, [(0, 0), (100, 0), (100, 100), (0, 100)])
    for grid in (7.0, 64.0, 1000.0):
        assert sorted(column(spatial.inside(p, square, grid), "id")) == ["in", "near"]


def test_concave_ring_and_hole(spark):
    p = spark.createDataFrame([("arm", 5.0, 15.0), ("notch", 15.0, 15.0)], "id string, x double, y double")
    assert column(spatial.inside(p, ring(spark, [(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20)])), "id") == ["arm"]
    hole = spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in r] for r in ([(0, 0), (20, 0), (20, 20), (0, 20)], [(4, 14), (6, 14), (6, 16), (4, 16)])],)], "rings array<array<struct<x:double,y:double>>>")
    assert column(spatial.inside(p, hole), "id") == ["notch"]


def test_centroid(spark):
    c = ring(spark, [(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20)]).select(G.centroid(F.col("rings")).alias("c")).first()["c"]
    assert (round(c["x"], 6), round(c["y"], 6)) == (round(25 / 3, 6), round(25 / 3, 6))


def test_polygon_overlap():
    l_shape = np.array([(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)], float)
    box = np.array([(0, 0), (6, 0), (6, 6), (0, 6)], float)
    assert abs(G.overlap_area(l_shape, box) - 20) < 1e-9
    assert abs(G.overlap_area(np.roll(l_shape[::-1], 2, 0), box) - 20) < 1e-9
    assert abs(G.polygon_iou(box, np.array([(3, 0), (9, 0), (9, 6), (3, 6)], float)) - 1 / 3) < 1e-9


def test_iou_keeps_the_best(spark):
    a = spark.createDataFrame([("c0", 0.0, 0.0, 10.0, 10.0), ("c1", 50.0, 50.0, 60.0, 60.0)], "cell_id string, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame([(1, 1.0, 1.0, 9.0, 9.0), (2, 8.0, 8.0, 18.0, 18.0), (3, 59.0, 59.0, 69.0, 69.0)], "k int, x0 double, y0 double, x1 double, y1 double")
    got = {r.cell_id: (round(r.max_iou, 9), r.n_candidates) for r in spatial.max_iou(a, b, grid=4.0).collect()}
    assert got == {"c0": (0.64, 2), "c1": (round(1 / 199, 9), 1)}
    assert column(spatial.overlap_filter(a.select("cell_id"), a, b), "cell_id") == ["c0"]


# Genes and expression.


def gene_table(spark, *samples):
    return spark.createDataFrame([(s, g, k) for s, names in enumerate(samples) for k, g in enumerate(names)], "sample int, gene string, pos int")


def test_panels(spark):
    t = gene_table(spark, ["B", "A", "C"], ["A", "B", "D"])
    assert genes.resolve_panel(t) == ["B", "A"]
    assert genes.resolve_panel(t, "sorted") == ["A", "B"]
    assert genes.resolve_panel(gene_table(spark, ["A", "C"], ["C", "A"]), "explicit", explicit=["C", "A"]) == ["C", "A"]
    for bad in ({"policy": "explicit", "explicit": ["X"]}, {"policy": "explicit"}, {"policy": "other"}):
        with pytest.raises(ValueError):
            genes.resolve_panel(t, **bad)
    with pytest.raises(ValueError):
        genes.resolve_panel(gene_table(spark, ["A"], ["B"]))
    with pytest.raises(ValueError):
        genes.validate_panel(["A", "B"], ["B", "A"])


def test_panel_files(tmp_path):
    genes.write_panel(tmp_path, ["A", "B"])
    assert genes.read_panel(tmp_path / "gene_panel.json") == ["A", "B"]
    assert (tmp_path / "gene_panel.sha256").read_text() == genes.panel_sha256(["A", "B"])


def test_sparse_rows(spark):
    d = spark.createDataFrame([(1, [0.0, 2.5, 0.0, 1.0]), (2, [0.0, 0.0, 0.0, 0.0])], "k int, v array<float>").select("k", sparse.encode(F.col("v")).alias("s")).select("k", "s.*")
    got = {r.k: (r.indices, list(r.d)) for r in d.withColumn("d", sparse.decode(F.col("indices"), F.col("values"), 4)).collect()}
    assert got == {1: ([1, 3], [0.0, 2.5, 0.0, 1.0]), 2: ([], [0.0] * 4)}


# Manifests.


def small_manifest(spark):
    return spark.createDataFrame([(k, "AABBCC"[k], f"cell_{k}", "g1" if k < 4 else "g2") for k in range(6)], "global_idx bigint, sample_id string, cell_id string, patient string")


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_dense_index_is_that_of_a_global_window(spark, block):
    rows = spark.createDataFrame([("s" if k % 3 else None, k * 7 % 41) for k in range(41)], "sample_id string, pos bigint")
    got = {(r.sample_id, r.pos): r.global_idx for r in manifest.dense_index(rows, "sample_id", "pos", block=block).collect()}
    order = sorted(got, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert [got[k] for k in order] == list(range(41))


def test_union_fills_missing_columns(spark):
    out = manifest.union_samples([spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int")])
    assert sorted((r.a, r.b) for r in out.collect()) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        manifest.union_samples([])


def test_extract_and_compile(spark):
    cells = spark.createDataFrame([("A", f"c{k}", k) for k in range(6)], "sample_id string, cell_id string, pos bigint")
    shapes = spark.createDataFrame([(f"c{k}", k, x + 10.0, y + 10.0) for k, (x, y) in enumerate([(40, 40), (60, 60), (-50, 10), (-5, 10), (1, 10), (95, 95)])], "shape_id string, pos bigint, x_px double, y_px double")
    rows, report = pipelines.extract(cells, shapes, width=100, height=100, base=20, shard_size=2)
    assert sorted(column(rows, "cell_id")) == ["c0", "c1", "c4"]
    assert report.first()["n_out"] == 3 and filters.drop_reasons(report.first().asDict())["full_oob"] == 1
    entries = spark.createDataFrame([("A", 0, "B", 1.0), ("A", 2, "A", 2.0), ("A", 2, "Z", 9.0)], "sample_id string, expr_row bigint, gene string, value float")
    out, expression, panel = pipelines.compile_dataset([rows], entries, gene_table(spark, ["B", "A"], ["A", "B"]))
    assert panel == ["B", "A"] and sorted(column(out, "global_idx")) == [0, 1, 2]
    assert {r.global_idx: (r.indices, r["values"]) for r in expression.collect()} == {0: ([0], [1.0]), 1: ([], []), 2: ([1], [2.0])}


def test_compiled_dataset_round_trip(spark, tmp_path):
    rows = small_manifest(spark).withColumn("shard_path", F.concat("sample_id", F.lit("/x.tar")))
    expression = rows.select("global_idx", F.array(F.lit(1)).alias("indices"), F.array(F.lit(2.0).cast("float")).alias("values"))
    pipelines.write_compiled(rows, expression, ["A", "B"], str(tmp_path / "c"), policy="sorted")
    got = pipelines.load_dataset(spark, str(tmp_path / "c"), ["B"])
    assert [(r.global_idx, list(r.expression)) for r in got.orderBy("global_idx").collect()] == [(2, [0.0, 2.0]), (3, [0.0, 2.0])]
    with pytest.raises(ValueError):
        pipelines.package(rows, ["A", "B"], str(tmp_path / "p"), task="t")
    pipelines.package(rows, ["A", "B"], str(tmp_path / "p"), task="t", defer_split=True)
    with pytest.raises(RuntimeError):
        pipelines.load_split(spark, str(tmp_path / "p"), "train")
    card = pipelines.make_split(rows, str(tmp_path / "p"), task="t", policy="sample_holdout", train=["A", "B"], val=["C"])
    assert card["training_ready_status"] == "training_ready" and card["n_shards"] == 3
    assert sorted(column(pipelines.load_split(spark, str(tmp_path / "p"), "val"), "global_idx")) == [4, 5]
    assert pipelines.load_split(spark, str(tmp_path / "p"), "test").count() == 0
    assert '"training_ready"' in (tmp_path / "p" / "loader_config.yaml").read_text()


# Splits.


def test_holdout(spark):
    m = small_manifest(spark)
    out = splits.split_membership(m, "sample_holdout", "t", train=["A", "B"], val=["C"])
    assert splits.validate(out, m) == []
    assert splits.summarize(out, "t")["counts_by_split"] == {"train": 4, "val": 2}
    for bad in ({"train": ["A", "A"], "val": ["B", "C"]}, {"train": ["A"]}, {"train": ["A", "B", "C", "D"]}, {"train": ["A", "B", "C"], "val": None}):
        with pytest.raises(ValueError):
            splits.split_membership(m, "sample_holdout", "t", **bad)


@pytest.mark.parametrize("ordering", ["md5", "numpy"])
def test_ratio_keeps_groups_whole(spark, ordering):
    out = splits.split_membership(small_manifest(spark), "ratio_by_group", "t", group="patient", ratios=(0.5, 0.25, 0.25), ordering=ordering)
    by = {r.group_id: r.n for r in out.groupBy("group_id").agg(F.countDistinct("split").alias("n")).collect()}
    assert by == {"g1": 1, "g2": 1} and set(column(out, "generated_at_level")) == {"group"}


def test_ratio_counts_clamp():
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert [splits.ratio_counts(n, (0.8, 0.1, 0.1)) for n in (1, 2, 5, 10)] == [(1, 0), (2, 0), (4, 0), (8, 1)]
    with pytest.warns(UserWarning):
        assert splits.ratio_counts(5, (0.8, 0.2, 0.0)) == (4, 0)


def test_kfold(spark):
    m = small_manifest(spark)
    out = splits.split_membership(m, "group_kfold", "t", group="patient", n_folds=2, seed=0)
    assert set(column(out, "split")) == {"fold_0", "fold_1"} and splits.validate(out, m) == []
    for bad in ({"n_folds": 1}, {"n_folds": 2, "fold": 2}):
        with pytest.raises(ValueError):
            splits.split_membership(m, "group_kfold", "t", group="patient", **bad)


def test_existing_files(spark, tmp_path):
    m = small_manifest(spark)
    (tmp_path / "s.csv").write_text("global_idx,split\n" + "".join(f"{k},{'val' if k > 3 else 'train'}\n" for k in range(6)))
    out = splits.split_membership(m, "existing_file", "t", external=files.read_split_file(spark, str(tmp_path / "s.csv")))
    assert len(splits.validate(out, m)) == 1
    (tmp_path / "s.tsv").write_text("sample_id\tsplit\nA\ttrain\nB\ttrain\n")
    with pytest.raises(ValueError):
        splits.split_membership(m, "existing_file", "t", external=files.read_split_file(spark, str(tmp_path / "s.tsv")))
    with pytest.raises(ValueError):
        files.read_split_file(spark, "x.xlsx")


def test_leaks_and_coverage_are_errors(spark):
    m = small_manifest(spark)
    out = splits.split_membership(m, "sample_holdout", "t", train=["A", "B"], val=["C"])
    flipped = out.withColumn("split", F.when(F.col("global_idx") == 0, "val").otherwise(F.col("split")))
    with pytest.raises(ValueError, match="leakage detected"):
        splits.validate(flipped, m)
    for bad in (out.filter("global_idx > 0"), out.unionByName(out.limit(1)), out.withColumn("global_idx", F.col("global_idx") + 1)):
        with pytest.raises(ValueError):
            splits.validate(bad, m)


@pytest.mark.parametrize("policy", ["random_cell", "defer_split", "other"])
def test_refused_policies(spark, policy):
    with pytest.raises(ValueError):
        splits.split_membership(small_manifest(spark), policy, "t")
    with pytest.raises(ValueError):
        splits.split_membership(spark.range(3), "sample_holdout", "t", train=[])


def test_split_files(spark, tmp_path):
    out = splits.split_membership(small_manifest(spark), "sample_holdout", "t", train=["A", "B"], val=["C"])
    paths = splits.write_split(out, str(tmp_path), "t", "p")
    assert [r.global_idx for r in spark.read.json(paths["val"]).collect()] == [4, 5]
    assert json.loads(open(paths["report"]).read())["n_cells_total"] == 6


# Shards.


def test_shards_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([("S", f"c{k}", k, f"{k:07d}", f"shard-{k // 3:06d}.tar", bytes([k] * (k + 1)), [k], [float(k)]) for k in range(6)], "sample_id string, cell_id string, sample_index bigint, sample_key string, shard_path string, image binary, indices array<int>, values array<float>")
    built = shards.build_shards(cells)
    written = shards.write_shards(built, str(tmp_path / "out")).collect()
    assert len(written) == 4
    back = shards.read_shards(spark, str(tmp_path / "out"))
    got = {(r.key, r.ext): bytes(r.payload) for r in shards.members(back).collect()}
    assert len(got) == 18 and got["0000002", "jpg"] == b"\x02\x02\x02"
    assert shards.unpack_sparse(got["0000004", "expr.npz"])[1].tolist() == [4.0]
    assert json.loads(got["0000005", "json"])["cell_id"] == "c5"
    index = built.filter("shard_path = 'shard-000001.tar'").first()["cidx"]
    assert len(index) == 12 + 3 * 32 and [r[0] for r in shards.unpack_index(bytes(index))] == [3, 4, 5]
    places = shards.byte_range(built, shards.offsets(built))
    assert {r.sample_index: bytes(r.payload) for r in places.collect()} == {k: bytes([k] * (k + 1)) for k in range(6)}


# Catalog and reports.


def test_catalog(spark, tmp_path):
    root = str(tmp_path)
    catalog.write_element(spark.range(4), root, "s1", "tables", "table")
    catalog.write_element(spark.range(2), root, "s1", "tables", "table")
    assert catalog.element(spark, root, "s1", "tables", "table").count() == 2
    with pytest.raises(KeyError, match="available"):
        catalog.element(spark, root, "s1", "tables", "x")
    assert [(r.kind, r.key, r.n_rows) for r in catalog.inspect(spark, root, "s1").collect()] == [("tables", "table", 2)]
    with pytest.raises(ValueError):
        catalog.discover_samples(spark, root)
    assert catalog.resolve_key(["cell_circles", "tissue_region"], catalog.TISSUE_KEYS) == "tissue_region"
    assert catalog.resolve_key(["a"], catalog.CELL_KEYS, "none") is None and catalog.resolve_key(["a"], (), "a") == "a"
    assert catalog.new_keys(["a"], ["a", "c", "b"]) == "b"
    with pytest.raises(RuntimeError):
        catalog.new_keys(["a"], ["a"], required=True)


def test_stage_report(tmp_path):
    r = reports.StageReport("tissue_inside", "z", "table", "table_tissue", 3, 2, {"outside_tissue": 1})
    path = reports.write_stage_report(r, tmp_path)
    assert path.name == "tissue_inside_table.json" and "report_path" not in json.loads(path.read_text())
    assert reports.overlap_reasons({"no_nucleus": 0, "low_overlap": 2}) == {"low_he_overlap": 2}


# Planner.


def test_plan_chains_tables():
    p = planner.parse("Process A_1,B_2: cells inside tissue with nucleus boundaries, sampled 500 cells, mpp=0.25. bundle")
    assert p.names == ["tissue_inside", "nucleus_presence"] and p.final_key == "table_tissue_nucleus"
    assert p.extract["n_sample"] == 500 and p.extract["mpp"] == 0.25 and p.compile == {"bundle": True, "samples": ["A_1", "B_2"]}
    steps = planner.render(p, ["A_1"], "/data")
    assert [s.split()[0] for s in steps] == ["inspect", "filter", "filter", "extract", "compile"] and "shapes" not in steps[3]


def test_the_nucleus_asks_for_the_overlap_stage():
    assert planner.stages_in("crop the nucleus") == ["xenium_he_nucleus_overlap"]


def test_ready_status():
    assert [planner.ready_status(False), planner.ready_status(True, False), planner.ready_status(True, has_split=True), planner.ready_status(True, deferred=True)] == ["not_compiled", "validation_failed", "training_ready", "split_pending"]


def test_split_positions_of_all_splits(spark):
    """All rows of all three splits, counted from 0 within each, over several blocks of the index."""
    rows = [(k * 70_000, ("train", "val", "train", "test")[k % 4]) for k in range(10)]
    got = sorted(tuple(r) for r in splits.split_positions(spark.createDataFrame(rows, "global_idx bigint, split string")).collect())
    assert got == sorted((s, n, i) for s in ("train", "val", "test") for n, i in enumerate(i for i, x in rows if x == s))


# Metrics and plans.


def test_spearman_with_ties(spark):
    d = spark.createDataFrame([("g", float(t), float(p)) for t, p in [(1, 1), (2, 3), (2, 2), (4, 5)]], "gene string, truth double, guess double")
    assert abs(metrics.spearman(d).first()["spearman"] - 0.9486832980505138) < 1e-9


def test_exclusive_genes_are_pairs(spark):
    """a and b never meet, c is never expressed."""
    d = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "b", 1.0), (3, "a", 0.0), (1, "d", 1.0)], "cell int, gene string, truth double")
    got = {(r.gene_a, r.gene_b): (r.n_both, r.n_either) for r in metrics.mutual_exclusivity(d, ["a", "b", "c", "d"]).collect()}
    assert got == {("a", "b"): (0, 3), ("a", "c"): (0, 1), ("a", "d"): (1, 1), ("b", "c"): (0, 2), ("b", "d"): (0, 3), ("c", "d"): (0, 1)}


def test_queries_over_all_genes(spark, sf_dir):
    from spotloom import registry

    assert registry.q_mutual_exclusivity_all(spark, sf_dir).count() == registry.q_co_expression_all(spark, sf_dir).count() == 64 * 63 // 2


def test_spatial_join_has_no_nested_loop(spark, sf_dir):
    from spotloom import registry

    plan = registry.q_iou_max(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sample_filter_reaches_the_scan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("source", "sample_id")
    plan = filters.sample_filter(rows, ["src1"]).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(source" in plan or "EqualTo(source" in plan


def test_streaming_ingest(spark, tmp_path):
    from spotloom.streaming import ingest

    rows = small_manifest(spark).withColumn("shard_path", F.lit("s"))
    rows.write.parquet(str(tmp_path / "in"))
    ingest.append_to(ingest.manifest_stream(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
