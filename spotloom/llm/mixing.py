"""Mixing sources to target weights by cube-method balanced sampling.

Targets are shares by weight of a multiple of all words, capped at a multiple of each
source's own words with the excess reshared: the level of a water filling, found with two
running sums over the table of sources, one row for each, which one task sorts. A source's documents then all have one expected
number of copies; its whole part is taken outright and its fraction is an inclusion
probability for the cube method (Deville and Tillé 2004, the fast flight of Chauvet and
Tillé 2006): three undecided documents at a time move along the null space of the two
balancing constraints, number of documents and number of words, until one of them is decided.

The flight runs over blocks of about ``BLOCK`` documents dealt by a hash, so that a source
with a third of all rows is many blocks; a block leaves a dozen documents or fewer undecided,
which fly again at the next level, until a source is one block and its last dozen are landed
on the corner of the cube whose totals are nearest to the target. Every choice is drawn from hashes of the
data, so reruns agree.

Defined cases: a null text has no words; a null source is a source of its own and comes last;
rows that repeat id, source and text share one decision; documents of no words are sampled
like others and take no words; a source without any words has target zero; an empty table
gives an empty result; other columns are ignored by the decision and kept by ``mixed``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .common import WORD, by_place, named

#: Documents of a block, about.
BLOCK = 4_000
#: Documents of a block that don't fly: with the two that a flight leaves, they are landed.
LAND = 10


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, units, target, rank) from (source, size, m)."""
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("units"))
    alone = Window.partitionBy(F.lit(0))  # one row for each source
    ranked = by.withColumn("rank", F.row_number().over(alone.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.lit([float(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("total", F.sum("source_size").over(alone) * F.lit(float(share))).withColumn("level", F.col("cap") / F.col("w"))
    up = alone.orderBy("level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # What all sources take when the water stands at this source's brim.
    taken = F.sum("cap").over(up) + F.col("level") * (F.sum("w").over(alone) - F.sum("w").over(up))
    ranked = ranked.withColumn("full", taken <= F.col("total"))
    left = F.max("total").over(alone) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(alone)
    rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(alone)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", left * F.col("w") / rest))
    return ranked.select("source", "source_size", "units", target.alias("target"), "rank")


def flight(p: np.ndarray, m: np.ndarray, x: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move probabilities to 0 or 1 with sum(p m) and sum(p x) kept; two or fewer stay between.

    ``draw``: a uniform number for each document. All steps are deterministic.
    """
    p, pool, at, n, step = p.tolist(), [], 0, len(p), 0
    m, x, draw = m.tolist(), x.tolist(), draw.tolist()
    while True:
        while len(pool) < 3 and at < n:
            if 0 < p[at] < 1:
                pool.append(at)
            at += 1
        if len(pool) == 3:
            i, j, k = pool
            u = (m[j] * x[k] - m[k] * x[j], m[k] * x[i] - m[i] * x[k], m[i] * x[j] - m[j] * x[i])
            if not any(u):  # parallel columns: one constraint
                u = (m[j], -m[i], 0) if m[i] or m[j] else (1, 0, 0)
        elif len(pool) == 2 and m[pool[0]] * x[pool[1]] == m[pool[1]] * x[pool[0]]:
            u = (m[pool[1]], -m[pool[0]])
        else:
            break
        up = down = float("inf")
        for t, v in zip(pool, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[t]) / v), min(down, p[t] / v)
            elif v < 0:
                up, down = min(up, p[t] / -v), min(down, (1 - p[t]) / -v)
        by = up if draw[step % n] * (up + down) < down else -down
        step += 1
        for t, v in zip(pool, u, strict=True):
            q = p[t] + by * v
            p[t] = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
        pool = [t for t in pool if 0 < p[t] < 1]
    return np.array(p)


def landing(p: np.ndarray, m: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The corner for the last undecided documents whose totals come nearest to those expected."""
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    corner = np.arange(2 ** len(left))[:, None] >> np.arange(len(left)) & 1
    words = np.abs(corner @ x[left] - p[left] @ x[left]) / max(1.0, x[left].mean())
    rows = np.abs(corner @ m[left] - p[left] @ m[left]) / max(1.0, m[left].mean())
    p = p.copy()
    p[left] = corner[np.argmin(4 * words + rows / 4)]
    return p


def _fly(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["key", "doc_id"], kind="stable")
    draw = (block["key"].to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / 2.0**53
    m = block["m"].to_numpy().astype(float)
    x = m * block["size"].to_numpy()
    p = block["p"].to_numpy().copy()
    fly = max(0, len(p) - LAND)
    p[:fly] = flight(p[:fly], m[:fly], x[:fly], draw[:fly])
    if block["blocks"].iat[0] == 1:
        p = landing(p, m, x)
    return block.assign(p=p)


def copies(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, extra): the decision for units (doc_id, key, rank, size, m, p, units)."""
    if block < 4 * (LAND + 2):
        raise ValueError(f"a block needs {4 * (LAND + 2)} documents at least, so that levels shrink")
    schema = "doc_id bigint, key bigint, rank int, size bigint, m bigint, p double, blocks bigint"
    blocks = F.ceil(F.col("units") / block).cast("bigint")
    todo = units.withColumn("blocks", F.greatest(blocks, F.lit(1))).select("doc_id", "key", "rank", "size", "m", "p", "blocks")
    most = units.agg(F.max("units")).first()[0] or 0
    decided = []
    while True:
        dealt = todo.withColumn("salt", F.pmod(F.xxhash64("key", F.lit(len(decided))), F.col("blocks")))
        flown = cut(dealt.groupBy("rank", "salt").applyInPandas(lambda b: _fly(b.drop(columns="salt")), schema))
        decided.append(flown.filter("p = 0 or p = 1"))
        most = -(-most // block)
        if most <= 1:
            break
        most *= LAND + 2  # what a block leaves at most
        todo = flown.filter("p > 0 and p < 1").withColumn("blocks", F.ceil((LAND + 2) * F.col("blocks") / block).cast("bigint"))
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.select("doc_id", "key", F.col("p").cast("int").alias("extra"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """(doc_id, key, size, source, source_size, target, copies): how often the mix takes each row."""
    rows = cut(_rows(docs, id_col, text_col, source_col))
    units = rows.groupBy("doc_id", "key", "source").agg(F.first("size").alias("size"), F.count("*").alias("m"))
    by = cut(targets(units, weights, share, most))
    expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    by = by.withColumn("base", F.floor(expected).cast("int")).withColumn("p", expected - F.floor(expected)).withColumnRenamed("source", "__source")
    joined = units.join(by, units["source"].eqNullSafe(by["__source"])).filter("p > 0")
    extra = copies(joined, block).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "extra")
    out = rows.join(by, rows["source"].eqNullSafe(by["__source"]))
    out = out.join(extra, (out["key"] == extra["__key"]) & out["doc_id"].eqNullSafe(extra["__id"]), "left")
    return out.select("doc_id", "key", "size", "source", "source_size", "target", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("copies"))


def _key(id_col: str, text_col: str, source_col: str):
    return F.xxhash64(named(id_col).cast("bigint"), named(source_col).cast("string"), named(text_col).cast("string"))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    words = F.coalesce(F.regexp_count(named(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(named(id_col).cast("bigint").alias("doc_id"), _key(id_col, text_col, source_col).alias("key"), words.alias("size"), named(source_col).cast("string").alias("source"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged, whatever their names."""
    rows, (i, t, s) = by_place(docs, id_col, text_col, source_col)
    found = mix(rows, weights, share, most, i, t, s).filter("copies > 0")
    found = found.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("copies").alias("__copies")).distinct()
    on = (_key(i, t, s) == F.col("__key")) & F.col(i).cast("bigint").eqNullSafe(F.col("__id"))
    many = rows.join(found, on).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return many.select(*rows.columns).toDF(*docs.columns)


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of each document."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
