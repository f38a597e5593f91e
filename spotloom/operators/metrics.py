"""Metrics of predictions by gene, split and sample, over (cell, gene, truth, guess)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut, small


def pearson(pairs: DataFrame, by: str = "gene") -> DataFrame:
    return pairs.groupBy(by).agg(F.corr("truth", "guess").alias("pearson"))


def average_ranks(pairs: DataFrame, value: str, by: str, name: str, parts: int = 256) -> DataFrame:
    """(by, value, name): the mean rank of every distinct value.

    Equal values are counted first; a gene's range of values is cut into parts, whose counts are summed
    up, and only a part's distinct values are ranked together.
    """
    counts = pairs.groupBy(by, value).agg(F.count("*").alias("__n"))
    span = counts.groupBy(by).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    part = F.when(F.col("__high") > F.col("__low"), F.floor((F.col(value) - F.col("__low")) / (F.col("__high") - F.col("__low")) * (parts - 1))).otherwise(0).cast("int")
    marked = counts.join(span, by).withColumn("__part", part).drop("__low", "__high")
    sizes = marked.groupBy(by, "__part").agg(F.sum("__n").alias("__m"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__m").over(earlier(Window.partitionBy(by).orderBy("__part"))), F.lit(0))).drop("__m")
    within = F.coalesce(F.sum("__n").over(earlier(Window.partitionBy(by, "__part").orderBy(value))), F.lit(0))
    ranked = marked.withColumn("__within", within).join(offsets, [by, "__part"])
    return ranked.select(by, value, (F.col("__before") + F.col("__within") + (F.col("__n") + 1) / 2.0).alias(name))


def spearman(pairs: DataFrame, by: str = "gene") -> DataFrame:
    """Correlation of mean ranks; pairs with a null on either side don't count."""
    known = pairs.select(by, "truth", "guess").filter("truth IS NOT NULL AND guess IS NOT NULL")
    ranked = known.join(average_ranks(known, "truth", by, "rt"), [by, "truth"]).join(average_ranks(known, "guess", by, "rg"), [by, "guess"])
    return ranked.groupBy(by).agg(F.corr("rt", "rg").alias("spearman"))


def errors(pairs: DataFrame, *by: str) -> DataFrame:
    """mse, mae, mean residual and rows; ``by``: gene, sample, split or cell type, or nothing."""
    d = F.col("guess") - F.col("truth")
    return pairs.groupBy(*by).agg(F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"), F.avg(d).alias("bias"), F.count("*").alias("n"))


def variable_genes(pairs: DataFrame, k: int, value: str = "truth") -> DataFrame:
    """The k genes of the largest sample variance; ties go by name."""
    return pairs.groupBy("gene").agg(F.var_samp(value).alias("variance")).orderBy(F.desc("variance"), "gene").limit(k)


#: Genes of a block: six sums of two blocks' pairs take 48 MB.
GENES = 1024
#: Cells that are multiplied at once.
CELLS = 256
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _block_sums(rows: pa.RecordBatch, i: int, j: int, size: int) -> np.ndarray:
    """(6, size, size): over cells that have both, the sums of every gene of block i with every one of block j.

    ``rows``: lists of (gene, v) by cell. Cells of few genes are paired gene by gene, others multiplied as matrices;
    a gene that a cell names twice counts as two rows.
    """
    e = rows.column("e")
    flat, ends = e.flatten(), np.asarray(e.offsets)
    gene, v = np.asarray(flat.field("gene")).astype(np.int64), np.asarray(flat.field("v"), float)
    cell = np.repeat(np.arange(len(e)), np.diff(ends))
    out = np.zeros((6, size, size))
    left, right = (gene // size) == i, (gene // size) == j
    a, b = gene - i * size, gene - j * size
    n_left, n_right = np.bincount(cell[left], minlength=len(e)), np.bincount(cell[right], minlength=len(e))
    if (n_left * n_right).sum() * 20 < len(e) * size * size:
        # Each entry on the left beside all of the same cell on the right.
        order = np.flatnonzero(right)  # entries of a cell lie side by side
        first = np.concatenate(([0], np.cumsum(n_right)))[:-1]
        times = n_right[cell[left]]
        one = np.repeat(np.flatnonzero(left), times)
        step = np.arange(len(one)) - np.repeat(np.cumsum(times) - times, times)
        two = order[first[cell[one]] + step]
        x, y, at = v[one], v[two], a[one] * size + b[two]
        for k, w in enumerate((None, x, y, x * x, y * y, x * y)):
            out[k] = np.bincount(at, w, size * size).reshape(size, size)
        return out
    for z in range(0, len(e), CELLS):
        own = (cell >= z) & (cell < z + CELLS)
        dense = []
        for some, to in ((left & own, a), (right & own, b)):
            m = np.zeros((3, min(CELLS, len(e) - z), size))
            for k, w in enumerate((np.ones(int(some.sum())), v[some], v[some] ** 2)):
                np.add.at(m[k], (cell[some] - z, to[some]), w)
            dense.append(m)
        (m, x, xx), (w, y, yy) = dense
        for k, (p, q) in enumerate(((m, w), (x, w), (m, y), (xx, w), (m, yy), (x, y))):
            out[k] += p.T @ q
    return out


def pair_sums(entries: DataFrame, n_genes: int, size: int = GENES) -> DataFrame:
    """(a, b, n, sx, sy, sxx, syy, sxy) of every two genes a < b that some cell has both of; ``entries``: (cell, gene, v), genes numbered from 0.

    A cell's entries are gathered, and sent to each two blocks of genes; a task adds up the sums of its cells in
    matrices of one two blocks at a time, so that what it holds and hands on grows with the blocks, not with the cells.
    """
    size = min(size, max(1, n_genes))
    blocks = range((n_genes + size - 1) // size)
    # As a bounded number of tasks shares two blocks, each pair of genes has a bounded number of rows.
    cells = entries.groupBy("cell").agg(F.collect_list(F.struct(F.col("gene").cast("int").alias("gene"), F.col("v").cast("double").alias("v"))).alias("e"), F.pmod(F.xxhash64("cell"), F.lit(SHARES)).alias("share"))
    both = cells.select("share", "e", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in blocks for j in blocks if i <= j))).alias("x")).select("share", "x.i", "x.j", "e")
    of = lambda g, c: (g >= F.col(c) * size) & (g < (F.col(c) + 1) * size)
    own = both.withColumn("e", F.filter("e", lambda s: of(s["gene"], "i") | of(s["gene"], "j"))).filter(F.size("e") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None

        def told() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            a, b = np.nonzero(sums[0])
            ga, gb = a + at[0] * size, b + at[1] * size
            some = ga < gb
            for z in range(0, int(some.sum()), 1 << 16):
                cut_ = slice(z, z + (1 << 16))
                p, q = a[some][cut_], b[some][cut_]
                yield pa.RecordBatch.from_pydict({"a": pa.array(ga[some][cut_].astype(np.int32)), "b": pa.array(gb[some][cut_].astype(np.int32)), **{n: pa.array(sums[k, p, q]) for k, n in enumerate(SUMS)}})

        for batch in batches:
            i, j = np.asarray(batch.column("i")), np.asarray(batch.column("j"))
            starts = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
            for first, last in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                here = (int(i[first]), int(j[first]))
                if here != at:
                    yield from told()
                    at, sums = here, np.zeros((6, size, size))
                sums += _block_sums(batch.slice(first, last - first), *here, size)
        yield from told()

    dealt = own.repartition("i", "j", "share").sortWithinPartitions("i", "j")
    schema = "a int, b int, " + ", ".join(f"{n} double" for n in SUMS)
    return dealt.mapInArrow(run, schema).groupBy("a", "b").agg(*(F.sum(n).alias(n) for n in SUMS))


#: Tasks, at most, that share two blocks of genes.
SHARES = 64


def _listed(pairs: DataFrame, genes: list) -> DataFrame:
    """(gene, at): the listed genes, numbered in their order."""
    names = sorted(set(genes))
    return small(pairs.sparkSession.createDataFrame(list(zip(names, range(len(names)), strict=True)), f"gene {pairs.schema['gene'].dataType.simpleString()}, at int"), max(len(names), 1))


def co_expression(pairs: DataFrame, genes: list[str], value: str = "truth") -> DataFrame:
    """(gene_a, gene_b, r) over cells, for a list of genes: the variable ones, or a whole panel."""
    listed = _listed(pairs, genes)
    some = pairs.select("cell", "gene", F.col(value).cast("double").alias("v")).filter("v IS NOT NULL").join(listed, "gene")
    # Values less their gene's mean: sums of large numbers would lose what the correlation is made of.
    mean = some.groupBy(F.col("at").alias("gene")).agg(F.avg("v").alias("m"))
    entries = some.select("cell", F.col("at").alias("gene"), "v").join(small(mean), "gene").select("cell", "gene", (F.col("v") - F.col("m")).alias("v"))
    sums = pair_sums(entries, len(set(genes)))
    spread = lambda s, ss: F.col("n") * F.col(ss) - F.col(s) * F.col(s)
    deep = F.sqrt(spread("sx", "sxx")) * F.sqrt(spread("sy", "syy"))
    # What rounding leaves of a gene that is the same in all cells of a pair is no spread.
    varies = lambda s, ss: spread(s, ss) > 1e-12 * F.col("n") * F.col(ss)
    r = F.when(varies("sx", "sxx") & varies("sy", "syy"), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / deep).otherwise(float("nan"))
    name = lambda c: listed.select(F.col("at").alias(c), F.col("gene").alias(f"gene_{c}"))
    return sums.join(name("a"), "a").join(name("b"), "b").select("gene_a", "gene_b", r.alias("r"))


def pathway_scores(pairs: DataFrame, pathways: DataFrame) -> DataFrame:
    """(pathway, pearson) of mean expression by cell; ``pathways``: (pathway, gene)."""
    scores = pairs.join(small(pathways), "gene").groupBy("cell", "pathway").agg(F.avg("truth").alias("truth"), F.avg("guess").alias("guess"))
    return pearson(scores, "pathway")


def mutual_exclusivity(pairs: DataFrame, genes: list[str], value: str = "truth") -> DataFrame:
    """(gene_a, gene_b, n_both, n_either): cells that express both, and either, of any two of the listed genes."""
    listed = _listed(pairs, genes)
    some = pairs.filter(F.col(value) > 0).select("cell", "gene").join(listed, "gene").select("cell", F.col("at").alias("gene")).distinct()
    both = pair_sums(some.withColumn("v", F.lit(0.0)), len(set(genes))).select("a", "b", F.col("n").cast("bigint").alias("n_both"))
    n = small(some.groupBy("gene").agg(F.count("*").alias("n")))
    # Every pair of the list: two genes that no cell expresses together are the most exclusive of all.
    one = lambda c: listed.join(n, F.col("at") == n["gene"], "left").select(F.col("at").alias(c), listed["gene"].alias(f"gene_{c}"), F.coalesce("n", F.lit(0)).alias(f"n_{c}"))
    above = F.explode(F.sequence(F.col("a") + 1, F.lit(len(set(genes)) - 1)))
    every = one("a").filter(F.col("a") < len(set(genes)) - 1).withColumn("b", above).join(one("b"), "b").join(both, ["a", "b"], "left").fillna(0, ["n_both"])
    return every.select("gene_a", "gene_b", "n_both", (F.col("n_a") + F.col("n_b") - F.col("n_both")).alias("n_either"))


def label_map(rows: DataFrame, column: str) -> DataFrame:
    """(label, label_id, n) in the order of labels."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count("*").alias("n"))
    return counts.select("label", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("bigint").alias("label_id"), "n")


def neighbours(points: DataFrame, radius: float) -> DataFrame:
    """(id, n_neighbours) within a radius, by a grid of that width.

    Points of one place are one with their number, so that a crowd in one spot costs no pairs.
    """
    at = lambda c: F.floor(F.col(c) / radius).cast("bigint")
    near = lambda c: F.explode(F.sequence(at(c) - 1, at(c) + 1))
    close = F.pow(F.col("x") - F.col("jx"), 2) + F.pow(F.col("y") - F.col("jy"), 2) <= radius * radius

    def within(places: DataFrame, *on: str) -> DataFrame:
        """(on, x, y, n, m): every place with its number n and the number m of points around it, its own among them."""
        a = places.select(*on, "x", "y", "n", near("x").alias("gx")).select("*", near("y").alias("gy"))
        b = places.select(*on, F.col("x").alias("jx"), F.col("y").alias("jy"), F.col("n").alias("jn"), at("x").alias("gx"), at("y").alias("gy"))
        return a.join(b, [*on, "gx", "gy"]).filter(close).groupBy(*on, "x", "y", "n").agg(F.sum("jn").alias("m"))

    known = points.select("id", "x", "y").filter("id IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    around = within(cut(known.groupBy("x", "y").agg(F.count("*").alias("n"))))
    found = known.join(around.select("x", "y", "m"), ["x", "y"]).groupBy("id").agg(F.sum("m").alias("m"), F.count("*").alias("rows"))
    # Rows of the point's own id are no neighbours: itself alone, but where an id has several rows.
    several = known.join(found.filter("rows > 1").select("id"), "id", "left_semi").groupBy("id", "x", "y").agg(F.count("*").alias("n"))
    own = within(several, "id").groupBy("id").agg(F.sum(F.col("n") * F.col("m")).alias("own"))
    counts = found.join(own, "id", "left").select("id", (F.col("m") - F.coalesce("own", F.lit(1))).alias("n"))
    return points.select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_neighbours"))


def content_hash(rows: DataFrame, *columns: str) -> DataFrame:
    """One order-independent hash of a table: the sum of row digests, with the number of rows.

    A row's digest is the head of its SHA-256 as a number, so that the sum needs no global sort.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.sum(head).cast("string").alias("digest_sum"), F.count("*").alias("n_rows"))


def table_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """(digest, n_rows): what a frozen release is told by, whatever the order of its rows.

    All of a row's SHA-256 is summed up, in six pieces that lose no bit, and the digest is the SHA-256 of
    the sums; lengths before the values tell them apart, and null from text.
    """
    value = lambda c: F.col(c).cast("string")
    text = F.concat(*(F.coalesce(F.concat(F.length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns))
    row = F.sha2(text, 256)
    parts = [F.coalesce(F.sum(F.conv(F.substring(row, 11 * k + 1, 11), 16, 10).cast("decimal(38,0)")).cast("string"), F.lit("0")) for k in range(6)]
    return rows.agg(F.sha2(F.concat_ws(",", *parts), 256).alias("digest"), F.count("*").alias("n_rows"))
