"""Reports: one-row aggregates written as JSON by the driver."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame

from ..sources import store
from . import filters


# What the reports hold: a fixed format, by which other tools read them.
FILTER_REPORT = (
    "sample_id", "zarr_path", "output_dir", "image_key", "extract_mode", "source_table_key", "source_shape_key", "patch_policy_requested",
    "patch_policy_applied", "n_cells_source", "n_after_shape_alignment", "n_after_positive_centroid", "n_after_patch_policy", "n_out",
    "drop_counts_by_reason", "patch_size", "target_mpp", "slide_mpp", "base_size", "image_width_px", "image_height_px", "seed", "warnings",
)


@dataclass
class StageReport:
    """What a filter stage did; ``zarr_path`` is the sample's root, and the shape keys are those of the cells and of what they are held against."""

    stage: str
    zarr_path: str
    input_table_key: str
    output_table_key: str
    n_in: int
    n_out: int
    drop_counts_by_reason: dict[str, int] = field(default_factory=dict)
    parameters: dict = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    elapsed_s: float = 0.0
    report_path: str | None = None
    input_shape_key: str = ""
    output_shape_key: str = ""


# What a stage's report holds: a fixed format, by which other tools read it, with our names where they differ.
STAGE_REPORT = {
    "stage": "stage", "zarr_path": "zarr_path", "input_table_key": "input_table_key", "output_table_key": "output_table_key", "input_shape_key": "input_shape_key",
    "output_shape_key": "output_shape_key", "n_cells_in": "n_in", "n_cells_out": "n_out", "drop_counts_by_reason": "drop_counts_by_reason", "warnings": "warnings",
}


def write_stage_report(report: StageReport, folder: str | Path) -> Path:
    """{stage}_{input table}.json; the path itself, parameters and seconds are not part of it."""
    path = Path(folder) / f"{report.stage}_{report.input_table_key}.json"
    report.report_path = f"{folder}/{path.name}"
    store.write_json(report.report_path, {k: getattr(report, v) for k, v in STAGE_REPORT.items()})
    return path


def filter_reports(counts: DataFrame, **given) -> list[dict]:
    """The full report of every sample, from one row of counts for each and what was asked for.

    ``counts``: what ``filters.filter_report`` gives by sample, with the sample's slide; ``given``: the other keys.
    """
    out = []
    for row in counts.orderBy("sample_id").collect():  # one row for each sample
        r = row.asDict()
        known = {
            "sample_id": r["sample_id"], "n_cells_source": r["n_source"], "n_after_shape_alignment": r["n_aligned"], "n_after_positive_centroid": r["n_positive"],
            "n_after_patch_policy": r["n_valid"], "n_out": r["n_out"], "drop_counts_by_reason": filters.drop_reasons(r), "slide_mpp": r.get("slide_mpp"),
            "base_size": int(r["base"]), "image_width_px": int(r["width"]), "image_height_px": int(r["height"]), "warnings": [],
        }
        report = known | given | {"output_dir": f"{given['output_dir']}/{r['sample_id']}", "zarr_path": f"{given['zarr_path']}/{r['sample_id']}"}
        if missing := [k for k in FILTER_REPORT if k not in report]:
            raise ValueError(f"the filter report lacks {missing}")
        out.append({k: report[k] for k in FILTER_REPORT})
    return out


def write_filter_report(report: dict, folder: str | Path, name: str = "filter_report.json") -> Path:
    store.write_json(f"{folder}/meta/{name}", report)
    return Path(folder) / "meta" / name


def inspect_report(listing: DataFrame, root: str, sample: str) -> dict:
    """What a sample holds, by kind; an image that can't be read has a key alone."""
    rows = [r.asDict() for r in listing.orderBy("kind", "key").collect()]
    names = {"tables": {"n_obs": "n_rows", "n_vars": "n_cols"}, "shapes": {"n_rows": "n_rows"}, "images": {"height": "height", "width": "width", "n_levels": "n_levels"}}
    return {"zarr_path": f"{root}/{sample}", "sample_id": sample} | {
        kind: [{"key": r["key"]} | {k: r[c] for k, c in cols.items() if r[c] is not None} for r in rows if r["kind"] == kind] for kind, cols in names.items()
    }


def write_inspect_report(report: dict, path: str | Path) -> Path:
    store.write_json(path, report)
    return Path(path)


def overlap_reasons(row: dict) -> dict[str, int]:
    """The overlap stage reports a reason only where it dropped something."""
    return {k: v for k, v in (("no_xenium_nucleus", row["no_nucleus"]), ("low_he_overlap", row["low_overlap"])) if v > 0}


def compile_report(*, policy: str, samples: list[str], n_cells: int, panel: list[str], sha: str, output: str, elapsed_s: float, **more) -> dict:
    """The fixed keys; ``more``: number and bytes of shards, where there are any."""
    return {"gene_order_policy": policy, "n_samples": len(samples), "sample_ids": samples, "n_cells": n_cells, "n_genes": len(panel), "gene_panel_sha256": sha, "output_dir": output, "elapsed_s": elapsed_s, **more}


def write_compile_report(report: dict, folder: str | Path) -> Path:
    store.write_json(f"{folder}/compile_report.json", report)
    return Path(folder) / "compile_report.json"
