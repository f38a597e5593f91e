"""Job: counts of many samples on the genes that all of them have, as sparse rows by sample.

Reads a long table of counts, in which a cell may name a gene more than once, sums these up, finds the
genes that every sample has, numbers them by name, and writes a sparse row for each cell, partitioned by
sample, with the panel and a report of what the panel left out. A rerun replaces the partitions of the
samples that it computes, and no others, with equal rows.

Defined cases: rows without a sample, cell, gene or value are counted and dropped; sums of zero are no entries; cells with
fewer than ``least_genes`` genes on the panel are dropped and counted; no gene in common is an error, before
anything is written; other columns are ignored.

    python -m jobs.panel_expression --counts /data/lineitem.parquet --output /out --config jobs/panel_expression.json
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions import sparse
from spotloom.operators import genes
from spotloom.session import cut, small

from . import command

log = logging.getLogger("jobs.panel_expression")
DEFAULTS = {"sample": "sample_id", "cell": "cell_id", "gene": "gene", "value": "value", "prefix": "", "least_genes": 1, "samples": None}


def entries(counts: DataFrame, conf: dict) -> DataFrame:
    """(cell: struct(sample_id, cell_id), gene, value, n): summed entries, and the rows that they are of."""
    gene = F.concat(F.lit(conf["prefix"]), F.col(conf["gene"]).cast("string"))
    rows = counts.select(F.col(conf["sample"]).cast("string").alias("sample_id"), F.col(conf["cell"]).cast("string").alias("cell_id"), gene.alias("gene"), F.col(conf["value"]).cast("double").alias("value"))
    if conf["samples"] is not None:
        rows = rows.filter(F.col("sample_id").isin(conf["samples"]))
    return rows.groupBy("sample_id", "cell_id", "gene").agg(F.sum("value").alias("value"), F.count("*").alias("n"))


def run(spark: SparkSession, counts: str, output: str, config: dict | None = None) -> dict:
    """Write the expression of all samples on their common genes under the output folder."""
    conf = command.settings(DEFAULTS, config)
    summed = cut(entries(spark.read.parquet(counts), conf))
    complete = "sample_id IS NOT NULL AND cell_id IS NOT NULL AND gene IS NOT NULL AND value IS NOT NULL"
    some = summed.filter(complete).filter("value <> 0")
    panel = cut(genes.sorted_panel(some.select(F.col("sample_id").alias("sample"), "gene").distinct()))
    if panel.isEmpty():
        raise ValueError("the samples have no gene in common")
    cell = F.struct("sample_id", "cell_id").alias("cell")
    sliced = genes.slice_genes(some.select(cell, "gene", "value"), small(panel.select("gene", F.col("gene_idx").cast("int").alias("gene_idx"))))
    packed = sparse.from_coordinates(sliced.withColumn("value", F.col("value").cast("float")), "cell").select("cell.*", "indices", "values", sparse.nnz(F.col("indices")).alias("n_nonzero"))
    rows = packed.filter(F.col("n_nonzero") >= conf["least_genes"])
    put = lambda d, name: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sample_id").parquet(f"{output}/{name}")
    panel.write.mode("overwrite").parquet(f"{output}/panel")
    put(rows, "expression")
    put(report(some, read(spark, output, conf["samples"])), "report")
    lost = summed.filter(f"NOT ({complete})").agg(F.sum("n")).first()[0] or 0
    told = {"genes": panel.count(), "read": summed.agg(F.sum("n")).first()[0] or 0, "incomplete": lost, "written": read(spark, output, conf["samples"]).count()}
    log.info("read %s counts of %s, wrote %s cells on %s genes to %s", told["read"], counts, told["written"], told["genes"], output)
    return told


def report(some: DataFrame, rows: DataFrame) -> DataFrame:
    """(sample_id, n_cells_in, n_cells, n_entries_in, n_entries)."""
    given = some.groupBy("sample_id", "cell_id").agg(F.count("*").alias("n")).groupBy("sample_id").agg(F.count("*").alias("n_cells_in"), F.sum("n").alias("n_entries_in"))
    got = rows.groupBy("sample_id").agg(F.count("*").alias("n_cells"), F.sum("n_nonzero").alias("n_entries"))
    return given.join(got, "sample_id", "left").fillna(0, ["n_cells", "n_entries"])


def read(spark: SparkSession, output: str, samples: list[str] | None = None) -> DataFrame:
    """The expression as it stands, of some samples or all."""
    rows = spark.read.schema("cell_id string, indices array<int>, values array<float>, n_nonzero bigint, sample_id string").parquet(f"{output}/expression")
    return rows if samples is None else rows.filter(F.col("sample_id").isin(samples))


if __name__ == "__main__":
    command.main("panel_expression", run, "counts", "output")
