"""Files with split assignments, manifests, and configuration."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Columns that are strings whatever a file says.
TEXT_KEYS = ("sample_key", "global_key", "sample_id", "cell_id")


def file_position() -> Column:
    """Where a row stands in its file: file, part of the file, and row."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))


def read_split_file(spark: SparkSession, path: str) -> DataFrame:
    """.parquet, .csv or .tsv with a column ``split``; ids keep their written form, and ``file_position`` orders the rows."""
    suffix = Path(path).suffix.lower()
    if suffix == ".parquet":
        out = spark.read.parquet(path)
        out = out.withColumn("file_position", file_position())
    elif suffix in (".csv", ".tsv"):
        out = spark.read.csv(path, header=True, sep="," if suffix == ".csv" else "\t").withColumn("file_position", file_position())
        if "global_idx" in out.columns:
            out = out.withColumn("global_idx", F.col("global_idx").cast("bigint"))
    else:
        raise ValueError(f"unknown split file suffix {suffix!r}; known: .parquet, .csv, .tsv")
    if "split" not in out.columns:
        raise ValueError(f"{path} has no column 'split'")
    return out


def read_manifest(spark: SparkSession, path: str, samples: list[str] | None = None) -> DataFrame:
    """A manifest with its keys as strings; the sample filter reaches the scan."""
    rows = spark.read.parquet(path)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in TEXT_KEYS if c in rows.columns})
    return rows if samples is None else rows.filter(F.col("sample_id").isin(samples))


def write_dataset(manifest: DataFrame, expression: DataFrame, folder: str) -> None:
    """The compiled dataset, by sample: readers prune the partitions they don't ask for."""
    manifest.write.mode("overwrite").partitionBy("sample_id").parquet(f"{folder}/manifest.parquet")
    expression.write.mode("overwrite").parquet(f"{folder}/expression.parquet")


def _yaml(value, indent: int = 0) -> str:
    """Nested dicts of scalars as YAML."""
    out = []
    for k, v in value.items():
        if isinstance(v, dict):
            out.append(f"{' ' * indent}{k}:\n{_yaml(v, indent + 2)}")
        else:
            out.append(f"{' ' * indent}{k}: {json.dumps(v)}\n")
    return "".join(out)


def write_loader_config(path: str | Path, *, task: str, status: str, manifest_path: str, shard_glob: str, gene_panel_path: str, gene_panel_sha256: str, split_path: str | None = None, level: str = "missing", shard_column: str = "shard_path", key_column: str = "global_key", patch_size: int = 224, mpp: float | None = None, normalization: str = "raw_counts") -> Path:
    """How a loader finds a packaged dataset. Keys and nesting are a fixed format."""
    config = {
        "task": task,
        "training_ready_status": status,
        "storage": {"format": "webdataset", "manifest_path": manifest_path, "shard_glob": shard_glob, "shard_path_column": shard_column, "sample_key_column": key_column},
        "gene_panel_path": gene_panel_path,
        "gene_panel_sha256": gene_panel_sha256,
        "split": {"required": True, "status": "available" if split_path else "missing", "split_membership_path": split_path, "split_column": "split", "index_column": "global_idx", "generated_at_level": level},
        "target": {"type": "expression", "format": "sparse_npz", "normalization": normalization},
        "image": {"format": "jpg", "patch_size": patch_size, "mpp": mpp},
        "runtime": {"split_argument_required": True},
    }
    store.write_text(path, _yaml(config))
    return Path(path)


def write_task_config(path: str | Path, *, task: str, n_genes: int, gene_panel_path: str, gene_panel_sha256: str, input_modality: str = "he_image", target_modality: str = "gene_expression", patch_size: int = 224, mpp: float | None = None, normalization: str = "raw_counts") -> Path:
    """What a model of the task reads and predicts. Keys and nesting are a fixed format."""
    config = {
        "task": task,
        "input_modality": input_modality,
        "target_modality": target_modality,
        "n_genes": n_genes,
        "gene_panel_path": gene_panel_path,
        "gene_panel_sha256": gene_panel_sha256,
        "image": {"patch_size": patch_size, "mpp": mpp},
        "target": {"normalization": normalization},
    }
    store.write_text(path, _yaml(config))
    return Path(path)


def read_config(path: str | Path) -> dict:
    """A configuration as ``_yaml`` writes it: nested keys with JSON values."""
    root: dict = {}
    inside = [(-1, root)]
    for line in store.read_text(path).splitlines():
        if not line.strip():
            continue
        depth = len(line) - len(line.lstrip())
        key, _, value = line.strip().partition(":")
        while inside[-1][0] >= depth:
            inside.pop()
        if value.strip():
            inside[-1][1][key] = json.loads(value)
        else:
            inside[-1][1][key] = {}
            inside.append((depth, inside[-1][1][key]))
    return root
