"""Gene panels: the genes that all samples have, in a fixed order."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import store


def common(genes: DataFrame) -> DataFrame:
    """(gene) present in every sample of (sample, gene, pos)."""
    n = genes.select("sample").distinct().agg(F.count("*").alias("n_samples"))
    each = genes.groupBy("gene").agg(F.countDistinct("sample").alias("k"))
    return each.crossJoin(F.broadcast(n)).filter("k = n_samples").select("gene")  # one row broadcast


def _numbered(genes: DataFrame, *order) -> DataFrame:
    """A panel is as long as a genome's list of genes; it is numbered in one window."""
    return genes.select("gene", (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("gene_idx"))


def sorted_panel(genes: DataFrame) -> DataFrame:
    """Common genes in code point order."""
    return _numbered(common(genes), F.col("gene"))


def first_sample_panel(genes: DataFrame, first) -> DataFrame:
    """Common genes in the order of the first sample; equal positions go by name."""
    order = genes.filter(F.col("sample") == F.lit(first)).groupBy("gene").agg(F.min("pos").alias("pos"))
    return _numbered(common(genes).join(order, "gene"), F.col("pos"), F.col("gene"))


def explicit_panel(genes: DataFrame, panel: list[str]) -> list[str]:
    """A given panel, if every sample has all of it."""
    if not panel:
        raise ValueError("an explicit gene panel is needed and must not be empty")
    spark = genes.sparkSession
    given = spark.createDataFrame([(g,) for g in sorted(set(panel))], "gene string")
    missing = given.join(common(genes), "gene", "left_anti").orderBy("gene").limit(5)
    if rows := [r[0] for r in missing.collect()]:
        raise ValueError(f"genes of the explicit panel are not in all samples: {rows}")
    return list(panel)


def resolve_panel(genes: DataFrame, policy: str = "first_sample", first=None, explicit: list[str] | None = None) -> list[str]:
    """The panel as a list on the driver: it is as long as a list of genes, whatever the number of cells."""
    if policy == "explicit":
        return explicit_panel(genes, explicit or [])
    if policy == "sorted":
        panel = sorted_panel(genes)
    elif policy == "first_sample":
        panel = first_sample_panel(genes, genes.agg(F.min("sample")).first()[0] if first is None else first)
    else:
        raise ValueError(f"unknown gene order {policy!r}")
    names = [r["gene"] for r in panel.orderBy("gene_idx").collect()]
    if not names:
        raise ValueError("the samples have no gene in common")
    return names


def validate_panel(found: list[str], panel: list[str]) -> None:
    """Equal genes in equal order."""
    if list(found) != list(panel):
        at = next((i for i, (a, b) in enumerate(zip(found, panel, strict=False)) if a != b), min(len(found), len(panel)))
        raise ValueError(f"gene panels differ from place {at} on ({len(found)} and {len(panel)} genes)")


def panel_sha256(panel: list[str]) -> str:
    """SHA-256 of the compact JSON list, which is not that of the file."""
    return hashlib.sha256(json.dumps(list(panel), separators=(",", ":")).encode()).hexdigest()


def write_panel(folder: str | Path, panel: list[str]) -> None:
    """gene_panel.json and gene_panel.sha256."""
    store.write_text(f"{folder}/gene_panel.json", json.dumps(list(panel)))
    store.write_text(f"{folder}/gene_panel.sha256", panel_sha256(panel))


def read_panel(path: str | Path) -> list[str]:
    return store.read_json(path)


def slice_genes(entries: DataFrame, panel: DataFrame) -> DataFrame:
    """Entries (cell, gene, value) on a panel (gene, gene_idx): a join, and only the columns it needs."""
    return entries.join(panel, "gene").select("cell", "gene_idx", "value")
