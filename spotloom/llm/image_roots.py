"""Classes of images by all links within the radius, without corners or matches on disk.

The links are those of ``images.every_link``, of which only the components count. So images
that are known to be of one component are never compared again:

1. Of a sample all links are found. Its largest component, and more images that link to it, are
   the hubs; hubs that link many images come first.
2. Every image is described where it is read and compared with the hubs until one links it. What
   no hub links is the rest. While that is many and halves, it meets other hubs.
3. The rest is compared with all images, in blocks that every task holds. A task drops the links
   within what it has joined already.

A link between two images is within the hubs' component or has an end in the rest, so that none is
left out. If hubs link less than half of all images, all are the rest: then the comparisons are
as many as pairs of images. Images are described anew in each step: nothing is written
but names, a few samples and links, fewer than the images of a task and its block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import BROADCAST_ROWS
from .images import CONSENSUS, CORNERS, NEAR, PLACE, SCALES, SHARE, corner_columns
from .simhash import components

#: Images of the first sample; up to so many, all are compared.
SAMPLE = 512
#: A rest so small is compared with all images at once.
FEW = 32
#: Pairs of corners that are compared at a time, about, and corners of a product's sides.
PAIRS, ROWS, COLS = 1 << 22, 1024, 2048
#: Ratios of scales, in half octaves, and turns.
_RATIOS = round(2 * np.log2(max(SCALES) / min(SCALES)))
_TURNS = (2 * _RATIOS + 1) * 12

PACKED = "img bigint, corners binary"

#: (names, starts, corners) of images; a corner is its place and two words of bits.
Held = tuple[np.ndarray, np.ndarray, np.ndarray]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(img, corners) of (img, media); empty where an image can't have links, as it has too few places."""
    half = lambda v, n: np.floor(v + 0.5).astype(np.int64) & (1 << n) - 1
    seen, told = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def noted() -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen.append(np.unique(b.column(0).to_numpy()))
            yield b

    for c in corner_columns(noted()):
        if not len(c["img"]):
            continue
        g = half(c["x"] * 16, 20) | half(c["y"] * 16, 20) << 20 | half(c["s"] * 64, 7) << 40 | half((c["t"] + np.pi) * 512, 12) << 47
        order = np.lexsort((c["k"], c["img"]))
        names, starts = np.unique(c["img"][order], return_index=True)
        rows = np.stack([g, c["d0"], c["d1"]], 1)[order]
        of = np.repeat(np.arange(len(names)), np.diff(np.r_[starts, len(rows)]))
        enough = _distinct(of, _cell(rows[:, 0]), len(names)) >= CONSENSUS
        told.append(names[enough])
        yield _pack(told[-1], [r.tobytes() for r, e in zip(np.split(rows, starts[1:]), enough, strict=True) if e])
    rest = np.setdiff1d(np.concatenate(seen), np.concatenate(told))
    yield _pack(rest, [b""] * len(rest))


def _pack(names: np.ndarray, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(data, pa.binary())], ["img", "corners"])


def _unpacked(b: pa.RecordBatch | pa.Table) -> Held:
    sizes = pc.binary_length(b["corners"]).to_numpy(zero_copy_only=False) // 24 if len(b) else np.zeros(0, np.int64)
    return b["img"].to_numpy(), np.r_[0, np.cumsum(sizes, dtype=np.int64)], np.frombuffer(b"".join(b["corners"].to_pylist()), np.int64).reshape(-1, 3)


def _picked(held: Held, rows: np.ndarray) -> Held:
    """Some images, in this order."""
    names, starts, corners = held
    n = starts[rows + 1] - starts[rows]
    new = np.r_[0, np.cumsum(n)]
    return names[rows], new, corners[np.repeat(starts[rows] - new[:-1], n) + np.arange(new[-1])]


def _joined(a: Held, b: Held) -> Held:
    return np.r_[a[0], b[0]], np.r_[a[1], a[1][-1] + b[1][1:]], np.concatenate([a[2], b[2]])


def _signs(corners: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(corners[:, 1:]).view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def _near(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The corners within ``NEAR`` bits: a product of signs is the bits that agree less those that differ."""
    out, other = [], _signs(y)
    for at in range(0, len(x), ROWS):
        own = _signs(x[at : at + ROWS])
        for to in range(0, len(y), COLS):
            part = other[to : to + COLS]
            few = np.flatnonzero(own @ part.T >= own.shape[1] - 2 * NEAR)
            out.append((few // len(part) + at, few % len(part) + to))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _cell(g: np.ndarray) -> np.ndarray:
    """The place of a corner as a number: x and y in sixteenths of a pixel are the low bits."""
    return (g & (1 << 20) - 1) // (16 * PLACE) << 13 | (g >> 20 & (1 << 20) - 1) // (16 * PLACE)


def _distinct(of: np.ndarray, cell: np.ndarray, n: int) -> np.ndarray:
    """How many cells each of n has."""
    return np.bincount(np.unique(of << 26 | cell) >> 26, minlength=n)


def _linked(x: Held, y: Held) -> tuple[np.ndarray, np.ndarray]:
    """Which images of x and y are linked; votes as in ``images.links``."""
    p, q = _near(x[2], y[2])
    m = len(y[0])
    u, v = (np.repeat(np.arange(len(h[0])), np.diff(h[1])) for h in (x, y))
    of = u[p] * m + v[q]
    # The image of the smaller name comes first.
    swap = x[0][u[p]] > y[0][v[q]]
    a, b = x[2][p, 0], y[2][q, 0]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    bits = lambda g, at, n: (g >> at & (1 << n) - 1).astype(np.float64)
    step = np.log2(bits(a, 40, 7) / 64) - np.log2(bits(b, 40, 7) / 64)
    turn = (bits(b, 47, 12) / 512 - np.pi) - (bits(a, 47, 12) / 512 - np.pi)
    way = (np.rint(step * 2).astype(np.int64) + _RATIOS) * 12 + np.rint(turn * (6 / np.pi)).astype(np.int64) % 12
    way += of * _TURNS
    many = np.flatnonzero(np.bincount(way, minlength=len(x[0]) * m * _TURNS)[way] >= CONSENSUS)
    ga, gb, way, ratio, turn = a[many], b[many], way[many], np.exp2(step[many]), turn[many]
    ax, ay, bx, by = bits(ga, 0, 20) / 16, bits(ga, 20, 20) / 16, bits(gb, 0, 20) / 16, bits(gb, 20, 20) / 16
    tx = bx - ratio * (ax * np.cos(turn) - ay * np.sin(turn))
    ty = by - ratio * (ax * np.sin(turn) + ay * np.cos(turn))
    most = np.zeros(len(x[0]) * m, np.int64)
    for h in (0, 0.5):
        for k in (0, 0.5):
            at, to = (np.floor(c / 16 + o).astype(np.int64) + (1 << 15) for c, o in ((tx, h), (ty, k)))
            _, place, count = np.unique(way << 32 | at << 16 | to, return_inverse=True, return_counts=True)
            own = count[place] >= CONSENSUS
            bins, place = np.unique(place[own], return_inverse=True)
            agree = np.minimum(*(_distinct(place, _cell(g[own]), len(bins)) for g in (ga, gb)))
            np.maximum.at(most, way[own] // _TURNS, agree[place])
    # The share of all matched places counts, too.
    found = np.flatnonzero(most >= CONSENSUS)
    own = (most >= CONSENSUS)[of]
    number = np.searchsorted(found, of[own])
    least = np.minimum(*(_distinct(number, _cell(g[own]), len(found)) for g in (a, b)))
    found = found[most[found] >= SHARE * least]
    return found // m, found % m


def _met(block: Held, label: np.ndarray, outside: int, half: bool, say: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The images of a task against a block's, of which those with one label need not be compared.

    ``outside`` is the label of images that are not in the block, -1 if they have none; with ``half`` these meet only
    those of greater names. ``say`` is ``links`` that join what wasn't, ``all`` links, or ``rest``: (img, corners) of those without a label.
    """
    label, order, end = label.copy(), np.argsort(block[0]), len(block[0])
    sorted_names = block[0][order]
    for b in batches:
        x = _unpacked(b)
        none, x = x[0][np.diff(x[1]) == 0], _picked(x, np.flatnonzero(np.diff(x[1])))
        at = np.minimum(np.searchsorted(sorted_names, x[0]), max(end - 1, 0))
        inside = sorted_names[at] == x[0] if end else np.zeros(len(x[0]), bool)
        own = np.where(inside, label[order[at]], outside) if end else np.full(len(x[0]), outside)
        once = inside | half
        needed = lambda low, high: (own[:, None] != label[None, low:high]) & (~once[:, None] | (x[0][:, None] < block[0][None, low:high]))  # noqa: B023, E731
        low, active, found = 0, 0, []
        while low < end and len(x[0]):
            if not active:  # what is of one label already is passed over
                need = needed(low, end)
                if not need.any():
                    break
                low, rows = low + int(need.any(0).argmax()), np.flatnonzero(need.any(1))
                active = int((x[1][rows + 1] - x[1][rows]).sum())
            cols = min(max(PAIRS // active, 256), 8 * COLS)
            high = max(low + 1, min(int(np.searchsorted(block[1], block[1][low] + cols, "right")) - 1, low + PAIRS // (_TURNS * len(x[0]))))
            need = needed(low, high)
            rows, ys = np.flatnonzero(need.any(1)), np.flatnonzero(need.any(0)) + low
            active = int((x[1][rows + 1] - x[1][rows]).sum())
            for u, v in zip(*_linked(_picked(x, rows), _picked(block, ys)), strict=True) if len(rows) else ():
                u, v = rows[u], ys[v]
                if not need[u, v - low] or (say != "all" and own[u] == label[v]):
                    continue
                found.append((x[0][u], block[0][v]))
                if say != "all":
                    old, new = max(own[u], label[v]), min(own[u], label[v])
                    if new < 0:
                        own[u] = old
                    else:
                        label[label == old] = new
                        own[own == old] = new
            low = high
        if say == "rest":
            left = np.flatnonzero(own < 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[x[0][left], none]), pa.array(np.r_[np.diff(x[1])[left], np.zeros(len(none), np.int64)])], ["img", "n"])
        elif found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["u", "v"])


def _meet(packed: DataFrame, block: Held, label: np.ndarray, outside: int = -1, half: bool = False, say: str = "links") -> DataFrame:
    """``_met`` in every task; the block is held by each, its size doesn't follow the table."""
    held = packed.sparkSession.sparkContext.broadcast((block, label))
    return packed.mapInArrow(lambda batches: _met(*held.value, outside, half, say, batches), "img bigint, n bigint" if say == "rest" else "u bigint, v bigint")


def _collected(packed: DataFrame, corners: int = 0) -> tuple[Held, DataFrame]:
    """Images by their names, on the driver and as a table for all cores; if ``corners`` is given, as many as have so many together."""
    table = cut(packed.filter(F.length("corners") > 0).dropDuplicates(["img"]))
    if corners:
        sizes = sorted(map(tuple, table.select("img", F.length("corners") / 24).collect()))
        some = int(np.searchsorted(np.cumsum([n for _, n in sizes]), corners, "right"))
        table = table.filter(F.col("img") <= sizes[some - 1][0]) if some else table.limit(0)
    held = _unpacked(table.toArrow())
    return _picked(held, np.argsort(held[0])), table.repartition(table.sparkSession.sparkContext.defaultParallelism)


def _hubs(sample: Held, links: list) -> np.ndarray:
    """The images of a sample's largest component; each next one links most that none before does."""
    m = len(sample[0])
    at = {int(k): i for i, k in enumerate(sample[0])}
    near = np.eye(m, dtype=np.float32)
    for u, v in links:
        near[at[u], at[v]] = near[at[v], at[u]] = 1
    root, old = np.arange(m), None
    while old is None or (root != old).any():
        old, root = root, np.where(near > 0, root[None], m).min(1)
    left = (root == np.bincount(root).argmax()).astype(np.float32)
    out, free = [], left > 0
    while left.any():
        gain = np.where(free, near @ left, -1)
        out.append(int(gain.argmax()))
        free[out[-1]] = False
        left *= 1 - near[out[-1]]
    return np.r_[out, np.flatnonzero(free)].astype(int)


def _between(low: float, high: float) -> Column:
    """Whether an image is of this part of all, by its name."""
    part = F.pmod(F.xxhash64("img", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    return (part >= low) & (part < high)


def roots(media: DataFrame, names: DataFrame, sample: int = SAMPLE, corners: int = CORNERS) -> DataFrame:
    """(img, root) of all ``names`` (img): the components of all links among ``media`` (img, media)."""
    packed = lambda some: some.select("img", "media").mapInArrow(_packed, PACKED)
    of = lambda ids: media.join(F.broadcast(ids.filter("n > 0").select("img")), "img", "left_semi")
    same = lambda held: np.zeros(len(held[0]), np.int64)
    n, rest, hub, left = names.count(), None, None, 0
    if n > sample:
        to = sample / n
        first, table = _collected(packed(media.filter(_between(0, to))), corners)
        links = _meet(table, first, np.arange(len(first[0])), say="all").collect()
        if links:
            hubs, mean = _picked(first, _hubs(first, links)), max(1, int(first[1][-1]) // len(first[0]))
            more = max(1, corners - int(hubs[1][-1])) // mean
            others, table = _collected(packed(media.filter(_between(to, to + more / n))), corners)
            apart = [r.img for r in _meet(table, hubs, same(hubs), say="rest").collect()]
            hub, hubs, to = int(hubs[0][0]), _joined(hubs, _picked(others, np.flatnonzero(~np.isin(others[0], apart)))), to + more / n
            rest = cut(_meet(packed(media), hubs, same(hubs), say="rest").dropDuplicates(["img"]))
            left, before = rest.filter("n > 0").count(), n
            while FEW < left <= min(before / 2, BROADCAST_ROWS) and to < 1:
                more = corners // mean
                known = media.filter(_between(to, to + more / n)).join(F.broadcast(rest.select("img")), "img", "left_anti")
                (hubs, _), to = _collected(packed(known), corners), to + more / n
                still = _meet(packed(of(rest)), hubs, same(hubs), say="rest").dropDuplicates(["img"])
                rest = cut(rest.filter("n = 0").union(still))
                left, before = rest.filter("n > 0").count(), left
    whole = rest is None or left > n / 2
    if whole:
        rest = cut(packed(media).select("img", (F.length("corners") / 24).cast("bigint").alias("n")).dropDuplicates(["img"]))
    blocks = -(-int(rest.agg(F.sum("n")).first()[0] or 0) // corners)
    found = None
    for k in range(blocks):
        own = rest.filter(F.pmod(F.xxhash64("img", F.lit(6)), F.lit(blocks)) == k)
        block, _ = _collected(packed(of(own)))
        met = cut(_meet(packed(media), block, np.arange(1, len(block[0]) + 1), 0 if blocks == 1 and not whole else -1, whole))
        found = met if found is None else found.union(met)
        if k % 4 == 3:  # no more rows than images, however many blocks there are
            found = cut(components(found).toDF("u", "v"))
    node = names.select("img").distinct()
    if not whole:
        node = node.join(rest.select("img", F.lit(True).alias("own")), "img", "left").select("img", F.when(F.col("own"), F.col("img")).otherwise(hub).alias("node"))
    else:
        node = node.select("img", F.col("img").alias("node"))
    if found is None:
        return node.withColumnRenamed("node", "root")
    if not whole:  # images outside the rest are the hub's
        for c in ("u", "v"):
            found = found.join(rest.select(F.col("img").alias(c), F.lit(True).alias("own")), c, "left").withColumn(c, F.when(F.col("own"), F.col(c)).otherwise(hub)).drop("own")
    return node.join(components(found), "node", "left").select("img", F.coalesce("root", "node").alias("root"))
