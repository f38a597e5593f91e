"""Copies among images by local descriptors: crops and edits share corners.

An image is a media column with grey or colour netpbm bytes (P5 or P6), the one raster format
that needs no codec. At three scales all Harris corners above a threshold are kept, so that
their number grows with the image and a strong overlay hides none; each is turned to the
direction of its patch's intensity centroid and described by 128 binary tests. Pairs of
descriptors at 16 or fewer differing bits propose a similarity transform, and two images are
copies if enough corners propose the same one from different places of both.

Equal images are one class from the start, so only different contents are compared. Classes are
the components of the links. ``image_roots`` finds those of all links without the links themselves,
which are found in one of two ways:

* ``every_link`` leaves none out: images are dealt to blocks, and every two blocks
  meet in a group that holds all corners of both, so that matches are found and voted on where
  they lie and only links leave a task. The work grows with the square of the corners. Tables that
  cover 16 of 128 bits would propose half of all pairs anyway.
* ``links``, the default, takes the pairs that share an entry of a Hamming table, one for each 48-bit window of
  the 128 bits, which is few of those at more than some bits. An entry is divided into blocks of about
  ``BLOCK`` corners and every two blocks meet in a group of their own, so that a crowd is many
  small tasks; its pairs grow with the square of its different corners.

Defined cases: a null or unreadable image, or one without corners (flat, or smaller than a
patch), is a class with its equals alone; rows that repeat an id are one image for each
content; null ids belong to classes but never name one unless all its ids are null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import named, slices
from .simhash import components

SCALES = (1.0, 0.75, 0.5)
RADIUS = 9
TESTS = 128
NEAR = 16
#: Corners of a table entry that are compared in one group.
BLOCK = 256
#: Corners of a block of images, about: some 20 MB.
CORNERS = 500_000
#: Places that must agree on one transform.
CONSENSUS = 4
#: The part of the matched places that must agree; among unrelated large images a seventieth did.
SHARE = 1 / 12
#: Pixels of a place: one feature is a corner at several scales, which is no agreement.
PLACE = 8

_rng = np.random.default_rng(20)
_PAIRS = np.clip(_rng.normal(0, RADIUS / 2.2, (TESTS, 2, 2)), -RADIUS + 1, RADIUS - 1)
_OFFSETS = np.stack(np.meshgrid(np.arange(-RADIUS, RADIUS + 1), np.arange(-RADIUS, RADIUS + 1), indexing="ij"), -1).reshape(-1, 2)
_OFFSETS = _OFFSETS[(_OFFSETS**2).sum(1) <= RADIUS**2]


def read_netpbm(data: bytes | None) -> np.ndarray | None:
    """A P5 or P6 image as grey values, None if it isn't one."""
    if not data or data[:2] not in (b"P5", b"P6"):
        return None
    try:
        parts, at = [], 2
        while len(parts) < 3:
            while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
                at = data.index(b"\n", at) + 1 if data[at : at + 1] == b"#" else at + 1
            end = at
            while data[end : end + 1].isdigit():
                end += 1
            parts.append(int(data[at:end]))
            at = end
        width, height, _ = parts
        depth = 1 if data[:2] == b"P5" else 3
        return np.frombuffer(data, np.uint8, width * height * depth, at + 1).reshape(height, width, depth).astype(np.float32).mean(2)
    except ValueError:
        return None


def write_netpbm(grey: np.ndarray) -> bytes:
    """Grey values as a P5 image."""
    h, w = grey.shape
    return b"P5 %d %d 255\n" % (w, h) + np.clip(np.rint(grey), 0, 255).astype(np.uint8).tobytes()


def _blur(a: np.ndarray) -> np.ndarray:
    p = np.pad(a, ((0, 0), (2, 2), (0, 0)), mode="edge")
    a = (p[:, :-4] + 4 * p[:, 1:-3] + 6 * p[:, 2:-2] + 4 * p[:, 3:-1] + p[:, 4:]) / 16
    p = np.pad(a, ((0, 0), (0, 0), (2, 2)), mode="edge")
    return (p[:, :, :-4] + 4 * p[:, :, 1:-3] + 6 * p[:, :, 2:-2] + 4 * p[:, :, 3:-1] + p[:, :, 4:]) / 16


def _resize(a: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return a
    h, w = int(a.shape[1] * scale), int(a.shape[2] * scale)
    y, x = (np.arange(h) + 0.5) / scale - 0.5, (np.arange(w) + 0.5) / scale - 0.5
    y0, x0 = np.clip(y.astype(int), 0, a.shape[1] - 2), np.clip(x.astype(int), 0, a.shape[2] - 2)
    fy, fx = np.clip(y - y0, 0, 1)[None, :, None].astype(np.float32), np.clip(x - x0, 0, 1)[None, None, :].astype(np.float32)
    top = a[:, y0][:, :, x0] * (1 - fx) + a[:, y0][:, :, x0 + 1] * fx
    low = a[:, y0 + 1][:, :, x0] * (1 - fx) + a[:, y0 + 1][:, :, x0 + 1] * fx
    return top * (1 - fy) + low * fy


def describe(stack: np.ndarray) -> tuple[np.ndarray, ...]:
    """(image, x, y, scale, angle, bits) of the corners of equally large images (n, h, w)."""
    found = []
    for scale in SCALES:
        a = _blur(_resize(stack, scale))
        n, h, w = a.shape
        m = RADIUS + 1
        if h <= 2 * m + 2 or w <= 2 * m + 2:
            continue
        gy, gx = np.gradient(a, axis=(1, 2))
        xx, yy, xy = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        r = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        core = r[:, m:-m, m:-m]
        peak = core > 1.0
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dy or dx:
                    other = r[:, m + dy : h - m + dy, m + dx : w - m + dx]
                    peak &= core > other if (dy, dx) > (0, 0) else core >= other
        img, y, x = np.nonzero(peak)
        found.append((img, y + m, x + m, np.full(len(img), scale), core[img, y, x] / scale, a))
    out = []
    if found:
        img, y, x, scale, strength = (np.concatenate([f[k] for f in found]) for k in range(5))
        level = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        order = np.lexsort((x, y, level, -np.round(strength, 3), img))
        parts = [(k, own[z : z + 4096]) for k in range(len(found)) for own in [order[level[order] == k]] for z in range(0, len(own), 4096)]
        for k, own in parts:
            f = found[k]
            a, i, py, px = f[5], img[own], y[own], x[own]
            patch = a[i[:, None], py[:, None] + _OFFSETS[:, 0], px[:, None] + _OFFSETS[:, 1]]
            angle = np.arctan2((patch * _OFFSETS[:, 0]).sum(1), (patch * _OFFSETS[:, 1]).sum(1))
            c, s = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
            qy, qx = _PAIRS[None, :, :, 0] * c + _PAIRS[None, :, :, 1] * s, _PAIRS[None, :, :, 1] * c - _PAIRS[None, :, :, 0] * s
            ry = np.clip(np.rint(py[:, None, None] + qy).astype(int), 0, a.shape[1] - 1)
            rx = np.clip(np.rint(px[:, None, None] + qx).astype(int), 0, a.shape[2] - 1)
            v = a[i[:, None, None], ry, rx]
            out.append((i, (px + 0.5) / scale[own], (py + 0.5) / scale[own], scale[own], angle, v[:, :, 0] < v[:, :, 1]))
    if not out:
        return tuple(np.zeros(0) for _ in range(5)) + (np.zeros((0, TESTS), bool),)
    return tuple(np.concatenate([o[k] for o in out]) for k in range(6))


def corner_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Corners of (img, media); a content that a task has just seen isn't described again."""
    seen: set[int] = set()
    for b in slices(batches, 128):
        ids, by = b.column(0).to_numpy(), {}
        if len(seen) > 100_000:
            seen.clear()
        for k, data in enumerate(b.column(1).to_pylist()):
            if int(ids[k]) in seen:
                continue
            seen.add(int(ids[k]))
            if (grey := read_netpbm(data)) is not None and min(grey.shape) > 2:
                by.setdefault(grey.shape, []).append((k, grey))
        # Stacks of about a million pixels at most, so that large images don't add up.
        stacks = [same[z : z + n] for (h, w), same in by.items() for n in [max(1, (1 << 20) // (h * w))] for z in range(0, len(same), n)]
        for some in stacks:
            rows = np.array([k for k, _ in some])
            img, x, y, scale, angle, bits = describe(np.stack([g for _, g in some]))
            img = img.astype(int)
            order = np.argsort(img, kind="stable")
            start = np.searchsorted(img[order], img[order])
            number = np.empty(len(img), np.int32)
            number[order] = np.arange(len(img)) - start
            packed = np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1, 2)
            yield {"img": ids[rows[img]], "k": number, **{n: v.astype(np.float64) for n, v in zip("xyst", (x, y, scale, angle), strict=True)}, "d0": packed[:, 0], "d1": packed[:, 1]}


def _corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cols in corner_columns(batches):
        yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in cols.items()})


def _window(at: int, of: str = "") -> Column:
    """48 bits from bit ``at`` of (d0, d1), around the end, tagged with the table."""
    low, high = (of + "d0", of + "d1") if at < 64 else (of + "d1", of + "d0")
    at %= 64
    part = F.shiftrightunsigned(low, at) if at else F.col(low)
    if at > 16:
        part = part.bitwiseOR(F.shiftleft(high, 64 - at))
    return part.bitwiseAND((1 << 48) - 1)


def _pairs(entries: DataFrame) -> DataFrame:
    """(a, b) of different images for all corners that share an entry; a corner is a struct."""
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = shared.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("m"))
    own = entries.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("c.img", "c.k"), "m").cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.struct("c", "own").alias("one"))
    # Dealt by blocks: by key alone, all blocks of a crowd would be one task's.
    each = dealt.repartition("key", "i", "j").groupBy("key", "i", "j").agg(F.collect_list("one").alias("all"))
    both = each.select("i", "j", F.explode("all").alias("a"), "all").select("i", "j", "a", F.explode("all").alias("b"))
    return both.filter("a.c.img < b.c.img and (i = j or a.own <> b.own)").select(F.col("a.c").alias("a"), F.col("b.c").alias("b"))


def _place() -> Column:
    """A corner's place in one long: x and y in sixteenths of a pixel, scale and turn."""
    part = lambda v, n, at: F.shiftleft(F.round(v).cast("bigint").bitwiseAND((1 << n) - 1), at)
    return part(F.col("x") * 16, 20, 0).bitwiseOR(part(F.col("y") * 16, 20, 20)).bitwiseOR(part(F.col("s") * 64, 7, 40)).bitwiseOR(part((F.col("t") + np.pi) * 512, 12, 47))


def links(corners: DataFrame) -> DataFrame:
    """(u, v): images with enough corners of different places that agree on one similarity transform, of corners that share a table entry."""
    key = lambda j, of="": _window(32 * j % 128, of).bitwiseOR(F.lit(j % 4 << 48))  # noqa: E731  a window tagged with its table
    corner = F.struct("img", "k", "g", "d0", "d1").alias("c")
    entries = corners.withColumn("g", _place()).select(corner, F.explode(F.array(*map(key, range(4)))).alias("key"))
    apart = F.bit_count(F.col("a.d0").bitwiseXOR(F.col("b.d0"))) + F.bit_count(F.col("a.d1").bitwiseXOR(F.col("b.d1")))
    near = _pairs(entries).filter(apart <= NEAR)
    narrow = near.select(F.col("a.img").alias("u"), F.col("b.img").alias("v"), F.col("a.g").alias("ga"), F.col("b.g").alias("gb"))
    # Dealt by image pair once; the votes below are counted where they lie.
    dealt = narrow.repartition("u", "v")
    bits = lambda g, at, n: F.shiftrightunsigned(g, at).bitwiseAND((1 << n) - 1)

    def opened(g: str) -> Column:
        c = F.col(g)
        return F.struct((bits(c, 0, 20) / 16).alias("x"), (bits(c, 20, 20) / 16).alias("y"), (bits(c, 40, 7) / 64).alias("s"), (bits(c, 47, 12) / 512 - np.pi).alias("t"))

    near = dealt.select("u", "v", opened("ga").alias("p"), opened("gb").alias("q"))
    # The transform that a match proposes: ratio of scales, turn, and where it puts the origin.
    ratio, turn = F.col("p.s") / F.col("q.s"), F.col("q.t") - F.col("p.t")
    tx = F.col("q.x") - ratio * (F.col("p.x") * F.cos(turn) - F.col("p.y") * F.sin(turn))
    ty = F.col("q.y") - ratio * (F.col("p.x") * F.sin(turn) + F.col("p.y") * F.cos(turn))
    bins = [F.round(F.log2(ratio) * 2).cast("int").alias("r"), F.pmod(F.round(turn * 6 / np.pi), F.lit(12)).cast("int").alias("w")]
    shifts = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))).alias("h")
    cell = lambda c: F.struct(F.floor(F.col(c + ".x") / PLACE), F.floor(F.col(c + ".y") / PLACE))
    votes = near.select("u", "v", cell("p").alias("ka"), cell("q").alias("kb"), *bins, tx.alias("tx"), ty.alias("ty"), shifts)
    votes = votes.withColumn("bx", F.floor(F.col("tx") / 16 + F.col("h.i") / 2)).withColumn("by", F.floor(F.col("ty") / 16 + F.col("h.j") / 2))
    agree = votes.groupBy("u", "v", "r", "w", "h", "bx", "by").agg(F.size(F.collect_set("ka")).alias("ca"), F.size(F.collect_set("kb")).alias("cb"))
    agree = agree.groupBy("u", "v").agg(F.max(F.least("ca", "cb")).alias("most")).filter(F.col("most") >= CONSENSUS)
    # Many matches agree here and there by chance: the share of all matched places counts, too.
    whole = votes.groupBy("u", "v").agg(F.size(F.collect_set("ka")).alias("na"), F.size(F.collect_set("kb")).alias("nb"))
    return agree.join(whole, ["u", "v"]).filter(F.col("most") >= SHARE * F.least("na", "nb")).select("u", "v")


def every_link(corners: DataFrame, rows: int = CORNERS) -> DataFrame:
    """(u, v) as ``links`` has them, of all corners within ``NEAR`` bits, in blocks of about ``rows`` corners.

    A block is sent to a group for each block; a group holds two, and the matches of some images at a time.
    """
    # Enough blocks for some groups a core, however few corners there are.
    m = max(1, -(-corners.count() // rows), math.isqrt(8 * corners.sparkSession.sparkContext.defaultParallelism))
    dealt = corners.select("img", _place().alias("g"), "d0", "d1", F.pmod(F.xxhash64("img"), F.lit(m)).cast("int").alias("own"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    dealt = dealt.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "img", "g", "d0", "d1")
    return dealt.repartition(m * (m + 1) // 2, "i", "j").groupBy("i", "j").applyInArrow(_linked, "u bigint, v bigint")


def _linked(group: pa.Table) -> pa.Table:
    """The links between the images of two blocks, or within one."""
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    own, img, g = (group[c].to_numpy() for c in ("own", "img", "g"))
    # By block and image; numbers of images go up with their names within a block.
    order = np.lexsort((img, own))
    own, img, g = own[order], img[order], g[order]
    d = [group[c].to_numpy()[order].view(np.uint64) for c in ("d0", "d1")]
    number = np.cumsum(np.r_[True, (img[1:] != img[:-1])]) - 1
    starts = np.r_[np.flatnonzero(np.diff(number, prepend=-1)), len(img)]
    end = int(np.searchsorted(own, i, "right"))
    bits = lambda at, n: (g >> at & (1 << n) - 1).astype(np.float64)
    at = {"x": bits(0, 20) / 16, "y": bits(20, 20) / 16, "s": np.log2(bits(40, 7) / 64), "t": bits(47, 12) / 512 - np.pi}
    found, held, n = [], [], 0
    for a, z in _pieces(starts, 0, end, 64):
        for b, y in _pieces(starts, 0 if i == j else end, len(img), 1 << 14):
            if i == j and number[y - 1] <= number[a]:
                continue
            p, q = _near(d, a, z, b, y)
            if i == j:
                p, q = (c[number[p] < number[q]] for c in (p, q))
            else:  # the image of the smaller name comes first
                p, q = np.where(img[p] < img[q], p, q), np.where(img[p] < img[q], q, p)
            held.append(_promising(number, at, p, q))
            n += len(held[-1][0])
            if n > 500_000:
                found.append(_voted(number, at, *map(np.concatenate, zip(*held, strict=True))))
                held, n = [], 0
    if n:
        found.append(_voted(number, at, *map(np.concatenate, zip(*held, strict=True))))
    pairs = np.concatenate([np.zeros((0, 2), np.int64), *found])
    return pa.table({"u": img[starts[pairs[:, 0]]], "v": img[starts[pairs[:, 1]]]})


def _pieces(starts: np.ndarray, low: int, high: int, rows: int) -> Iterator[tuple[int, int]]:
    """(from, to) of whole images, each of about ``rows`` corners or of one image."""
    while low < high:
        end = int(min(high, starts[max(np.searchsorted(starts, low + rows, "right") - 1, np.searchsorted(starts, low, "right"))]))
        yield low, end
        low = end


def _near(d: list[np.ndarray], a: int, z: int, b: int, y: int) -> tuple[np.ndarray, np.ndarray]:
    """The corners of [a, z) and [b, y) within ``NEAR`` bits."""
    out, step = [], max(1, (1 << 17) // (y - b))
    for k in range(a, z, step):
        part = np.bitwise_count(d[0][k : min(k + step, z), None] ^ d[0][b:y]).ravel()
        few = np.flatnonzero(part <= NEAR)
        p, q = few // (y - b) + k, few % (y - b) + b
        near = part[few] + np.bitwise_count(d[1][p] ^ d[1][q]) <= NEAR
        out.append((p[near], q[near]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _promising(number: np.ndarray, at: dict, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """(p, q, bin, many) of the image pairs of which ``CONSENSUS`` matches agree on a ratio of scales and a turn, and which matches do."""
    r = np.rint((at["s"][p] - at["s"][q]) * 2).astype(np.int64)
    w = np.rint((at["t"][q] - at["t"][p]) * (6 / np.pi)).astype(np.int64) % 12
    u, v = number[p], number[q]
    of = (u - (u.min() if len(u) else 0)) * (int(v.max() - v.min()) + 1 if len(v) else 1) + (v - (v.min() if len(v) else 0))
    turn = (r + 16) * 12 + w
    _, place, count = np.unique(of * 384 + turn, return_inverse=True, return_counts=True)
    many = count[place] >= CONSENSUS
    keep = np.isin(of, np.unique(of[many]))
    return p[keep], q[keep], turn[keep], many[keep]


def _distinct(of: np.ndarray, cell: np.ndarray, n: int) -> np.ndarray:
    """How many cells each of n has."""
    return np.bincount(np.unique(of << 26 | cell) >> 26, minlength=n)


def _voted(number: np.ndarray, at: dict, p: np.ndarray, q: np.ndarray, turn: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The image pairs whose matches agree on a transform, by all their matches; votes as in ``links``."""
    ka, kb = ((at["x"][c] // PLACE).astype(np.int64) << 13 | (at["y"][c] // PLACE).astype(np.int64) for c in (p, q))
    pairs, of = np.unique(number[p] << 31 | number[q], return_inverse=True)
    least = np.minimum(_distinct(of, ka, len(pairs)), _distinct(of, kb, len(pairs)))
    p, q, ka, kb, of, turn = (c[many] for c in (p, q, ka, kb, of, turn))
    ratio, by = np.exp2(at["s"][p] - at["s"][q]), at["t"][q] - at["t"][p]
    tx = at["x"][q] - ratio * (at["x"][p] * np.cos(by) - at["y"][p] * np.sin(by))
    ty = at["y"][q] - ratio * (at["x"][p] * np.sin(by) + at["y"][p] * np.cos(by))
    most = np.zeros(len(pairs), np.int64)
    for h in (0, 0.5):
        for k in (0, 0.5):
            bx, bz = (np.floor(c / 16 + o).astype(np.int64) + (1 << 15) for c, o in ((tx, h), (ty, k)))
            bins, place = np.unique((of * 384 + turn) << 32 | bx << 16 | bz, return_inverse=True)
            agree = np.minimum(_distinct(place, ka, len(bins)), _distinct(place, kb, len(bins)))
            np.maximum.at(most, (bins >> 32) // 384, agree)
    linked = pairs[(most >= CONSENSUS) & (most >= SHARE * least)]
    return np.stack([linked >> 31, linked & (1 << 31) - 1], 1)


def image_classes(images: DataFrame, id_col: str, media_col: str, find: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """(id, content, class_id): one row for each image; the class's smallest id names it. ``find`` gives the links of corners."""

    def roots(media: DataFrame, names: DataFrame) -> DataFrame:
        described = media.mapInArrow(_corners, "img bigint, k int, x double, y double, s double, t double, d0 bigint, d1 bigint")
        corners = cut(described.dropDuplicates(["img", "k"]))  # narrow rows move, not the images
        return components(find(corners)).withColumnRenamed("node", "img")

    return classes_by(images, id_col, media_col, roots)


def classes_by(images: DataFrame, id_col: str, media_col: str, find: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """(id, content, class_id) as ``image_classes``; ``find`` gives (img, root) of (img, media) and the distinct (img)."""
    data = named(media_col).cast("binary")
    digest = F.sha2(F.coalesce(data, F.lit(b"")), 256)
    # A number for each content: its digest's head, on which images are compared and rows move.
    number = F.xxhash64(F.lower(F.hex("digest"))).alias("img")
    rows = cut(images.select(named(id_col).cast("bigint").alias("id"), F.unhex(digest).alias("digest")))
    numbered = rows.groupBy(number).agg(F.min("id").alias("least"))
    roots = find(images.select(F.xxhash64(digest).alias("img"), data.alias("media")), numbered.select("img"))
    placed = numbered.join(roots, "img", "left").select("img", "least", F.coalesce("root", "img").alias("root"))
    names = placed.join(placed.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("img", "class_id")
    return rows.select("id", "digest", number).join(names, "img").select("id", F.lower(F.hex("digest")).alias("content"), "class_id")


def textures(vectors: DataFrame, id_col: str, vector_col: str, side: int = 64) -> DataFrame:
    """(id, media): each vector drawn as an image, its values the low frequencies of a cosine transform."""
    n = 8
    wave = np.cos(np.pi * (np.arange(side)[:, None] + 0.5) * np.arange(1, n + 1)[None, :] / side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            media = []
            for v in b.column(1).to_pylist():
                if not v:
                    media.append(None)
                    continue
                c = np.zeros(n * n)
                c[: len(v)] = [x or 0.0 for x in v[: n * n]]
                grey = wave @ c.reshape(n, n) @ wave.T
                low, high = grey.min(), grey.max()
                media.append(write_netpbm((grey - low) * (255 / (high - low)) if high > low else grey * 0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(media, pa.binary())], ["id", "media"])

    return vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, "id bigint, media binary")
