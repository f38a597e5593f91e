"""Classes of images by hubs and the rest against all links of all corners."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.llm import image_roots, images
from spotloom.llm.registry import QUERIES

from .test_images import CORNER, all_links


@pytest.fixture(scope="module")
def mixed(spark):
    """Noisy copies of some images, one of many, images without copies or corners, unreadable and null ones, and a repeated content."""
    rng, rows = np.random.default_rng(6), []
    for i, n in enumerate((30, 6, 4, 1, 1, 1, 1)):
        a = np.kron(rng.uniform(20, 235, (8, 8)), np.ones((8, 8)))
        rows += [(100 * i + k, images.write_netpbm(np.rot90(a, k % 2) + rng.normal(0, 20, a.shape))) for k in range(n)]
    rows += [(900, images.write_netpbm(np.zeros((64, 64)))), (901, b"P5 no image"), (902, None), (903, b""), (904, rows[0][1]), (None, rows[1][1])]
    return spark.createDataFrame(rows, "id bigint, media binary").cache()


def classes(spark, table, *limits) -> dict:
    out = images.classes_by(table, "id", "media", lambda media, names: image_roots.roots(media, names, *limits))
    return {(r.id, r.content): r.class_id for r in out.collect()}


@pytest.mark.parametrize("limits", [(), (1024, 700), (20, 50_000), (12, 700), (3, 700)])
def test_roots_are_components_of_all_links(spark, mixed, limits):
    """All at once, in blocks, with hubs, with rounds of few hubs, and with hubs that link few."""
    rows = mixed.select("id", F.sha2(F.coalesce("media", F.lit(b"")), 256).alias("content"), F.xxhash64(F.sha2(F.coalesce("media", F.lit(b"")), 256)).alias("img"), "media")
    linked = all_links(rows.select("img", "media").mapInArrow(images._corners, CORNER).dropDuplicates(["img", "k"]).collect())
    rows = rows.drop("media").collect()
    root = {r.img: r.img for r in rows}
    for _ in root:
        for u, v in linked:
            root[u] = root[v] = min(root[u], root[v])
    least = {}
    for r in rows:
        if r.id is not None:
            least[root[r.img]] = min(r.id, least.get(root[r.img], r.id))
    expected = {(r.id, r.content): least[root[r.img]] for r in rows}
    assert len(set(expected.values())) < len(expected) - 20 and len(set(expected.values())) > 3
    assert classes(spark, mixed, *limits) == expected
    assert classes(spark, mixed.limit(0), *limits) == {}


@pytest.mark.parametrize("way", ["rest", "links"])
def test_what_is_joined_is_not_compared_again(monkeypatch, way):
    """An image meets no more of a block once it is joined to all of it, and a task tells no more links than join something."""
    rng = np.random.default_rng(2)
    a = np.kron(rng.uniform(20, 235, (8, 8)), np.ones((8, 8)))
    data = [images.write_netpbm(a + rng.normal(0, 3, a.shape)) for _ in range(60)]
    b = next(image_roots._packed(iter([image_roots.pa.RecordBatch.from_arrays([image_roots.pa.array(range(60)), image_roots.pa.array(data)], ["img", "media"])])))
    held, pairs = image_roots._unpacked(b), 0
    near = image_roots._near

    def counted(x, y):
        nonlocal pairs
        pairs += len(x) * len(y)
        return near(x, y)

    monkeypatch.setattr(image_roots, "_near", counted)
    monkeypatch.setattr(image_roots, "PAIRS", 1 << 16)
    label = np.zeros(60, np.int64) if way == "rest" else np.arange(60)
    others = image_roots._pack(held[0] + 100, b["corners"].to_pylist())
    out = [r for o in image_roots._met(held, label, -1, False, way, iter([others])) for r in o.to_pylist()]
    if way == "rest":
        assert not out and pairs < len(held[2]) ** 2 / 8
    else:
        assert len(out) == 119  # sixty and sixty images are one


def test_query_moves_no_corners(spark, sf_dir):
    """Neither corners nor matches are shuffled: a few rows for each image are."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm

    def written() -> int:
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        none = jvm.java.util.ArrayList
        stages = sc._jsc.sc().statusStore().stageList(none(), False, False, sc._gateway.new_array(jvm.double, 0), none())
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = written()
    out = QUERIES["op5_image_copies"](spark, sf_dir)
    n = out.count()
    assert n == 500 and written() - before < 100 * n
