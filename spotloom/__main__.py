"""Commands: inspect, filter, extract, compile, make-split and plan, over samples of parquet elements."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators import pipelines, reports, splits
from .plans import planner
from .session import local_session
from .sources import catalog, files, store


def session() -> SparkSession:
    """The session that a submitted program has, or a local one."""
    return SparkSession.getActiveSession() or local_session()


def _samples(spark: SparkSession, root: str, asked: list[str] | None) -> list[str]:
    found = [catalog.sample_name(p) for p in catalog.find_samples(spark, f"{root}/*")]
    if missing := [s for s in asked or [] if s not in found]:
        raise SystemExit(f"samples not found: {missing}")
    return asked or [s for s in found if s != "compiled"]


def inspect(argv: list[str]) -> list[dict]:
    """What each sample holds."""
    p = argparse.ArgumentParser(prog="spotloom inspect")
    p.add_argument("--root", required=True)
    p.add_argument("--samples", nargs="*")
    p.add_argument("--report-dir")
    a = p.parse_args(argv)
    spark, out = session(), []
    for s in _samples(spark, a.root, a.samples):
        out.append(reports.inspect_report(catalog.inspect(spark, a.root, s), a.root, s))
        if a.report_dir:
            reports.write_inspect_report(out[-1], f"{a.report_dir}/{s}/inspect_report.json")
    return out


def filter_(argv: list[str]) -> list[dict]:
    """One stage for each sample: read a table, keep, write it under another key, report."""
    p = argparse.ArgumentParser(prog="spotloom filter")
    p.add_argument("stage", choices=pipelines.STAGES)
    p.add_argument("--root", required=True)
    p.add_argument("--samples", nargs="*")
    p.add_argument("--in", dest="in_key", default="table")
    p.add_argument("--out", dest="out_key")
    p.add_argument("--threshold", type=float, default=0.5)
    p.add_argument("--report-dir")
    for name in ("shapes", "tissue", "nuclei", "he"):
        p.add_argument(f"--{name}-key")
    a = p.parse_args(argv)
    spark = session()
    keys = {k: v for k in ("shapes", "tissue", "nuclei", "he") if (v := getattr(a, f"{k}_key"))}
    made = [pipelines.run_stage(spark, a.root, s, a.stage, a.in_key, a.out_key, keys=keys, threshold=a.threshold, report_dir=a.report_dir and f"{a.report_dir}/{s}") for s in _samples(spark, a.root, a.samples)]
    return [{"zarr_path": r.zarr_path, "stage": r.stage, "n_in": r.n_in, "n_out": r.n_out, "output_table_key": r.output_table_key} for r in made]


def extract(argv: list[str]) -> dict:
    """All samples that aren't done, in one job; what the figures of each would show is noted beside its report."""
    a = planner.parse_args(argv)
    spark = session()
    names = _samples(spark, a.root, a.samples)
    layers = {s: _layers(spark, a, s) for s in names}
    out = pipelines.extract_all(spark, a.root, a.output, names, table=a.table_key, shapes=a.shapes_key, image=a.image_key, cell_id=a.cell_id_column, patch=a.patch_size, mpp=a.mpp, policy=a.patch_policy_requested, mode=a.extract_mode, shard_size=a.shard_size, n_sample=a.n_sample, seed=a.seed, report_name=a.filter_report_name)
    for s in out["done"]:
        store.write_json(f"{a.output}/{s}/meta/overlay_keys.json", layers[s])
    return out


def _layers(spark: SparkSession, a: argparse.Namespace, sample: str) -> dict[str, str | None]:
    """The shapes that figures of a sample show, by the options; one that is named must be there."""
    known = [k.removesuffix(".parquet") for k in catalog.list_dir(spark, f"{a.root}/{sample}/shapes")]
    out = {}
    for layer, hint, candidates in (("tissue", a.tissue_key, catalog.TISSUE_KEYS), ("cell", a.cell_key, catalog.CELL_KEYS), ("nucleus", a.nucleus_key, catalog.NUCLEUS_KEYS)):
        out[layer] = catalog.resolve_key(known, candidates, hint)
        if out[layer] is None and hint not in ("auto", "none"):
            raise SystemExit(f"--{layer}-key {hint!r} is not among the shapes of {sample}: {known}")
    return out


def compile_(argv: list[str]) -> dict:
    """The dataset of all extracted samples."""
    p = argparse.ArgumentParser(prog="spotloom compile")
    p.add_argument("--root", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--samples", nargs="*")
    p.add_argument("--gene-order", choices=("first_sample", "sorted", "explicit"), default="first_sample")
    p.add_argument("--gene-panel")
    p.add_argument("--bundle", action="store_true")
    a = p.parse_args(argv)
    spark = session()
    from .sources import shards

    source = shards.read_shards(spark, a.root) if a.bundle else None
    return pipelines.compile_folder(spark, a.root, a.output, samples=a.samples, policy=a.gene_order, explicit=store.read_json(a.gene_panel) if a.gene_panel else None, source=source)


def make_split(argv: list[str]) -> dict:
    """A split of a package: metadata alone."""
    p = argparse.ArgumentParser(prog="spotloom make-split")
    p.add_argument("--package", required=True)
    p.add_argument("--policy", required=True, choices=[*splits.POLICIES, "random_cell", "defer_split"])
    for name in ("train", "val", "test"):
        p.add_argument(f"--{name}", nargs="*", default=[])
    p.add_argument("--group")
    p.add_argument("--ratios", nargs=3, type=float)
    p.add_argument("--n-folds", type=int)
    p.add_argument("--fold", type=int)
    p.add_argument("--seed", type=int)
    p.add_argument("--split-file")
    a = p.parse_args(argv)
    spark = session()
    args: dict = {}
    if a.policy == "sample_holdout":
        args = {"train": a.train, "val": a.val, "test": a.test}
    elif a.policy == "existing_file":
        args = {"external": files.read_split_file(spark, a.split_file)}
    else:
        args = {k: v for k, v in {"group": a.group, "ratios": a.ratios and tuple(a.ratios), "n_folds": a.n_folds, "fold": a.fold, "seed": a.seed}.items() if v is not None}
    rows = spark.read.parquet(f"{a.package}/manifest.parquet")
    return pipelines.make_split(rows, a.package, task=store.read_json(f"{a.package}/dataset_card.json")["task"], policy=a.policy, **args)


def plan(argv: list[str]) -> list[str]:
    """A request in words as commands."""
    p = argparse.ArgumentParser(prog="spotloom plan")
    p.add_argument("request")
    p.add_argument("--root", required=True)
    p.add_argument("--output", default="out")
    p.add_argument("--samples", nargs="*", default=[])
    a = p.parse_args(argv)
    return planner.render(planner.parse(a.request), a.samples, a.root, a.output)


COMMANDS = {"inspect": inspect, "filter": filter_, "extract": extract, "compile": compile_, "make-split": make_split, "plan": plan}


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in COMMANDS:
        raise SystemExit(f"usage: python -m spotloom {{{','.join(COMMANDS)}}} ...")
    print(json.dumps(COMMANDS[argv[0]](argv[1:]), indent=2, default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
