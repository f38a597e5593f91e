"""Figures pixel by pixel, and cells by their number from a loader's own process."""

import pickle
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import figures, pipelines
from spotloom.sources import loader, shards

from .test_shards import built


def pixels(data):
    """A PNG as it was written: one part of data, lines without a filter."""
    data = bytes(data)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and data[-12:] == b"\x00\x00\x00\x00IEND\xae\x42\x60\x82"
    w, h = struct.unpack(">II", data[16:24])
    at = data.index(b"IDAT")
    (size,) = struct.unpack(">I", data[at - 4 : at])
    assert struct.unpack(">I", data[at + 4 + size : at + 8 + size])[0] == zlib.crc32(data[at : at + 4 + size])
    lines = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + size]), np.uint8).reshape(h, w * 3 + 1)
    assert not lines[:, 0].any()
    return lines[:, 1:].reshape(h, w, 3)


def test_masks_against_points():
    r = np.random.default_rng(0)
    for _ in range(20):
        rings = [r.uniform(-5, 30, (r.integers(3, 9), 2)) for _ in range(r.integers(1, 4))]
        got = figures.fill_mask(rings, 20, 25)
        for y in range(20):
            for x in range(25):
                odd = sum((p[1] > y + 0.5) != (q[1] > y + 0.5) and x + 0.5 >= p[0] + (y + 0.5 - p[1]) * (q[0] - p[0]) / (q[1] - p[1]) for ring in rings for p, q in zip(ring, np.roll(ring, -1, 0), strict=True)) % 2
                assert got[y, x] == odd
    square = figures.line_mask(np.array([(2, 3), (6, 3), (6, 5), (2, 5)], float), 10, 10)
    assert square.sum() == 12 and square[3, 2:7].all() and square[4, [2, 6]].all() and not square[4, 3:6].any()
    assert figures.line_mask(np.array([(-9, -9), (30, 30)], float), 8, 8).sum() == 8 and figures.line_mask(np.array([(3.0, 3.0)]), 8, 8).sum() == 1


def test_patches_are_drawn_on_their_tiles(spark):
    rows = [("A", "c0", "cell", 0, k, x, y) for k, (x, y) in enumerate([(1, 1), (6, 1), (6, 6), (1, 6)])]
    rows += [("A", "c0", "nucleus", 0, k, x, y) for k, (x, y) in enumerate([(1, 1), (3, 1), (3, 3), (1, 3)])] + [("A", "c1", "cell", None, None, None, None)]
    lines = spark.createDataFrame(rows, "sample_id string, cell_id string, layer string, part int, vertex int, px int, py int")
    ground = np.arange(8 * 8 * 3, dtype=np.uint8)
    tiles = spark.createDataFrame([("A", "c1", ground.tobytes())], "sample_id string, cell_id string, rgb binary")
    got = {r.cell_id: pixels(r.png) for r in figures.patch_figures(lines, 8, fill=("cell",), tiles=tiles).collect()}
    assert (got["c1"] == ground.reshape(8, 8, 3)).all()
    a = got["c0"]
    assert tuple(a[1, 1]) == figures.COLOURS["nucleus"] and tuple(a[6, 6]) == figures.COLOURS["cell"] and tuple(a[0, 0]) == (255, 255, 255)
    assert tuple(a[4, 4]) == tuple(np.rint(255 * 0.6 + np.array(figures.COLOURS["cell"]) * 0.4).astype(int))


def test_slides_and_files(spark, tmp_path):
    boxes = spark.createDataFrame([("A", x, y, x + 2, y + 2) for x, y in [(0.0, 0.0), (0.0, 0.0), (90.0, 40.0), (500.0, -7.0)]] + [("B", 1.0, 1.0, 3.0, 3.0)], "sample_id string, x0 double, y0 double, x1 double, y1 double")
    slides = spark.createDataFrame([("A", 100.0, 50.0), ("B", 4.0, 4.0)], "sample_id string, width double, height double")
    made = figures.slide_figures(boxes, slides, side=10)
    got = {r.sample_id: pixels(r.png)[:, :, 0] for r in made.collect()}
    assert got["A"].shape == (5, 10) and got["B"].shape == (4, 4)
    assert got["A"][0, 0] == 0 and got["A"][4, 9] == got["A"][0, 9] == round(255 - 255 * np.log(2) / np.log(3)) and (got["A"] == 255).sum() == 47
    assert figures.write_figures(made, str(tmp_path)) == 2
    assert sorted(p.name for p in (tmp_path / "viz").iterdir() if not p.name.endswith(".crc")) == ["A.png", "B.png"]
    assert (pixels((tmp_path / "viz/A.png").read_bytes())[:, :, 0] == got["A"]).all()


def test_open_files_are_bounded(tmp_path):
    for k in range(5):
        (tmp_path / f"f{k}").write_bytes(bytes([k]) * 4)
    h = loader.Handles(2)
    for k in (0, 1, 0, 2, 0, 1):  # 2 puts out 1, not 0, which was used since; then 1 puts out 2
        assert h.get(str(tmp_path / f"f{k}")).read_at(1, 0) == bytes([k])
    assert (h.opened, h.evicted, len(h)) == (4, 2, 2)
    h.close_all()
    assert len(h) == 0


def test_items_equal_the_dataset(spark, tmp_path):
    cells, rows = built(spark)
    shards.write_shards(rows, str(tmp_path))
    listed = pipelines.attach_offsets(cells.drop("image"), rows).withColumn("global_idx", F.col("sample_index") + F.when(F.col("sample_id") == "B", 7).otherwise(0))
    expression = spark.range(14).select(F.col("id").alias("global_idx"), F.array(F.col("id").cast("int")).alias("indices"), F.array(F.lit(1.5)).alias("values"))
    items = loader.CellReader.of(listed, str(tmp_path), order="global_idx", expression=expression, handles=2)
    images = {(r.sample_id, r.cell_id): bytes(r.image) for r in cells.collect()}
    assert len(items) == 14
    for i in [3, 13, 0, 7, 3, *range(14), -1]:
        got = items[i]
        assert got["global_idx"] == i % 14 and got["image"] == images[got["sample_id"], got["cell_id"]] and got["indices"] == [i % 14]
    assert len(items.handles) == 2 and items.handles.evicted > 0
    again = pickle.loads(pickle.dumps(items))
    assert again[5]["image"] == items[5]["image"] and again.handles.opened == 1
    with pytest.raises(IndexError):
        items[14]
    with pytest.raises(ValueError, match="tar_offset"):
        loader.CellReader.of(cells, str(tmp_path), order="sample_index")
    assert [x["meta"]["cell_id"] for x in loader.index_of(f"{tmp_path}/A/shard-000001.idx")] == ["c3", "c4", "c5"]
    items.close(), again.close()


def test_patches_are_no_groups_of_their_own(spark):
    """Cells are rows of a task; one that has a tile alone keeps its ground, whatever its key."""
    lines = spark.createDataFrame([(None, "cell", 0, k, x, y) for k, (x, y) in enumerate([(1, 1), (3, 1), (3, 3)])], "cell_id string, layer string, part int, vertex int, px int, py int")
    ground = bytes(range(75))
    tiles = spark.createDataFrame([("only", ground), (None, bytes(75))], "cell_id string, rgb binary")
    made = figures.patch_figures(lines, 5, tiles=tiles)
    assert "InPandas" not in made._jdf.queryExecution().toString()
    got = {r.cell_id: pixels(r.png) for r in made.collect()}
    assert got["only"].tobytes() == ground and tuple(got[None][1, 1]) == figures.COLOURS["cell"] and not got[None][0].any()
