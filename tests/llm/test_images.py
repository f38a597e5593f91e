"""Links of images against brute force over all their corners."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.llm import images

CORNER = "img bigint, k int, x double, y double, s double, t double, d0 bigint, d1 bigint"


def all_links(rows: list) -> set:
    """Links by comparing every two corners, whatever bits they share; votes are counted one by one."""
    half = lambda v: np.floor(np.array(v) + 0.5)
    img, d = np.array([r.img for r in rows]), np.array([(r.d0, r.d1) for r in rows], np.int64).view(np.uint64)
    x, y, s, t = half([r.x * 16 for r in rows]) / 16, half([r.y * 16 for r in rows]) / 16, half([r.s * 64 for r in rows]) / 64, half([(r.t + np.pi) * 512 for r in rows]) / 512
    votes, whole = {}, {}
    for a in range(len(rows)):
        for b in np.nonzero((img > img[a]) & (np.bitwise_count(d ^ d[a]).sum(1) <= images.NEAR))[0]:
            pair, ratio, turn = (int(img[a]), int(img[b])), s[a] / s[b], t[b] - t[a]
            tx = x[b] - ratio * (x[a] * np.cos(turn) - y[a] * np.sin(turn))
            ty = y[b] - ratio * (x[a] * np.sin(turn) + y[a] * np.cos(turn))
            places = (x[a] // images.PLACE, y[a] // images.PLACE), (x[b] // images.PLACE, y[b] // images.PLACE)
            at = [(*pair, half(np.log2(ratio) * 2).item(), half(turn * 6 / np.pi).item() % 12, i, j, np.floor(tx / 16 + i / 2), np.floor(ty / 16 + j / 2)) for i in (0, 1) for j in (0, 1)]
            for held in [whole.setdefault(pair, (set(), set())), *(votes.setdefault(k, (set(), set())) for k in at)]:
                for side, place in zip(held, places, strict=True):
                    side.add(place)
    return {k[:2] for k, v in votes.items() if min(map(len, v)) >= max(images.CONSENSUS, images.SHARE * min(map(len, whole[k[:2]])))}


@pytest.fixture(scope="module")
def noisy(spark):
    """Copies of three images with much noise, some turned: most of their corners share no window of 48 bits."""
    rng, rows = np.random.default_rng(4), []
    for i, n in enumerate((30, 5, 5)):
        a = np.kron(rng.uniform(20, 235, (8, 8)), np.ones((8, 8)))
        rows += [(100 * i + k, images.write_netpbm(np.rot90(a, k % 2) + rng.normal(0, 20, a.shape))) for k in range(n)]
    return spark.createDataFrame(rows, "img bigint, media binary").cache()


@pytest.mark.parametrize("rows", [100, 500_000])
def test_every_link(spark, noisy, rows):
    """No link is left out, in small blocks or large ones; the tables leave out some."""
    found = noisy.mapInArrow(images._corners, CORNER).cache()
    expected = all_links(found.collect())
    got = [(r.u, r.v) for r in images.every_link(found, rows).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    tables = {(r.u, r.v) for r in images.links(found).collect()}
    assert len(expected - tables) > 20


def test_classes_hold_every_link(spark, noisy):
    """Images that only the whole comparison links are in one class."""
    got = {r.id: r.class_id for r in images.image_classes(noisy, "img", "media", images.every_link).collect()}
    name = {r.img: r.number for r in noisy.select("img", F.xxhash64(F.sha2("media", 256)).alias("number")).collect()}
    found = noisy.select(F.xxhash64(F.sha2("media", 256)).alias("img"), "media").mapInArrow(images._corners, CORNER)
    linked = all_links(found.collect())
    assert linked and all(got[a] == got[b] for a in name for b in name if (name[a], name[b]) in linked)
