"""Numbers by blocks: dense indices of skewed orders, and sums of pairs of genes by blocks of genes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotloom.operators import manifest, metrics

ORDERS = {
    "outlier": lambda r: [*range(600), 10**15],
    "both ends": lambda r: [-(2**62), *range(300), 2**62],
    "sparse": lambda r: r.sample(range(-(10**14), 10**14), 500),
    "doubling": lambda r: [2**k for k in range(60)] + [-(2**k) for k in range(60)],
    "clusters": lambda r: [c + k for c in (0, 10**6, 10**12) for k in range(200)],
}


@pytest.mark.parametrize("name", ORDERS)
def test_dense_index_of_skewed_orders(spark, name, monkeypatch):
    """Equal to a global window, with no block of more than a few times the rows that are wanted."""
    rows = [("a", x) for x in ORDERS[name](random.Random(1))] + [("b", x) for x in range(90)] + [(None, 5)]
    df = spark.createDataFrame(rows, "sample_id string, pos bigint")
    largest = []
    plain = manifest._divided

    def divided(marked, *args):
        out = plain(marked, *args)
        largest.append(out.groupBy("sample_id", "__block").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(manifest, "_divided", divided)
    got = sorted((r.global_idx, r.sample_id, r.pos) for r in manifest.dense_index(df, "sample_id", "pos", block=20).collect())
    assert [(s, p) for _, s, p in got] == sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert [i for i, _, _ in got] == list(range(len(rows)))
    assert largest[-1] <= manifest.CROWDED * 20 and len(largest) <= 12


def test_a_small_table_is_numbered_by_one_window(spark):
    plan = manifest.dense_index(spark.range(10).select(F.lit("s").alias("sample_id"), F.col("id").alias("pos")), "sample_id", "pos")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Join" not in plan


@pytest.fixture(scope="module")
def expression(spark):
    """Genes of which some are rare, one constant, and one named twice by a cell."""
    r = np.random.default_rng(6)
    rows = [(c, f"g{g:02d}", float(np.round(r.normal(1e4 if g == 3 else g, 1 + g / 5), 4))) for c in range(150) for g in range(23) if g < 8 or r.random() < 0.15]
    rows += [(c, "gconst", 2.5) for c in range(150)] + [(0, "g01", 7.0), (1, "gnull", None)]
    return rows, spark.createDataFrame(rows, "cell bigint, gene string, truth double").repartition(5)


@pytest.mark.parametrize("size", [4, 7, 1024])
def test_pair_sums_against_loops(spark, expression, size):
    rows, df = expression
    genes = sorted({g for _, g, _ in rows})
    at = {g: k for k, g in enumerate(genes)}
    entries = spark.createDataFrame([(c, at[g], v) for c, g, v in rows if v is not None], "cell bigint, gene int, v double")
    got = {(r.a, r.b): tuple(r)[2:] for r in metrics.pair_sums(entries, len(genes), size).collect()}
    by: dict = {}
    for c, g, v in rows:
        if v is not None:
            by.setdefault(c, []).append((at[g], v))
    expected: dict = {}
    for e in by.values():
        for a, x in e:
            for b, y in e:
                if a < b:
                    s = expected.setdefault((a, b), np.zeros(6))
                    s += (1, x, y, x * x, y * y, x * y)
    assert set(got) == set(expected) and all(np.allclose(got[k], expected[k]) for k in got)


def test_block_sums_by_pairs_and_by_matrices():
    """Both ways of a block give the same sums."""
    import pyarrow as pa

    r = np.random.default_rng(0)
    lists = [[{"gene": int(g), "v": float(r.normal())} for g in r.choice(40, r.integers(0, 5), replace=False)] for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"e": pa.array(lists, pa.list_(pa.struct([("gene", pa.int32()), ("v", pa.float64())])))})
    full = [[{"gene": g, "v": float(r.normal())} for g in range(40)] for _ in range(300)]
    dense = pa.RecordBatch.from_pydict({"e": pa.array(full, batch.column("e").type)})
    for b, i, j in ((batch, 0, 1), (batch, 0, 0), (dense, 0, 1), (dense.slice(7, 90), 1, 1)):
        got = metrics._block_sums(b, i, j, 20)
        own = np.zeros((6, 20, 20))
        for e in b.column("e").to_pylist():
            for p in e:
                for q in e:
                    if p["gene"] // 20 == i and q["gene"] // 20 == j:
                        x, y = p["v"], q["v"]
                        own[:, p["gene"] % 20, q["gene"] % 20] += (1, x, y, x * x, y * y, x * y)
        assert np.allclose(got, own)


def test_co_expression_of_large_and_constant_values(spark, expression):
    rows, df = expression
    genes = sorted({g for _, g, _ in rows})
    got = {(r.gene_a, r.gene_b): r.r for r in metrics.co_expression(df, genes).collect()}
    values: dict = {}
    for c, g, v in rows:
        if v is not None:
            values.setdefault(g, {}).setdefault(c, []).append(v)
    for (a, b), r in got.items():
        xy = [(x, y) for c in set(values[a]) & set(values[b]) for x in values[a][c] for y in values[b][c]]
        x, y = np.array(xy).T
        if len(xy) > 1 and np.ptp(x) > 0 and np.ptp(y) > 0:
            assert abs(r - np.corrcoef(x, y)[0, 1]) < 1e-6, (a, b)
        else:
            assert np.isnan(r)
