"""From a request in words to a plan of stages."""

from __future__ import annotations

import argparse
import re
import shlex
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import validate_policy

# Stages in the order in which they run, with the suffix of their tables and the phrases that
# ask for them: fixed values.
STAGES = {
    "tissue_inside": ("tissue", ("inside tissue", "out of tissue", "outside tissue", "tissue filter", "tissue region", "filter.*tissue")),
    "nucleus_presence": ("nucleus", ("with nucleus boundaries", "has nucleus", "only cells with nucleus", "nucleus boundar", "nucleus presence")),
    "xenium_he_nucleus_overlap": ("he", ("xenium nucleus.*he nucleus", "he nucleus", "nucleus overlap", r"overlap\s*>")),
}
# The words and patterns of arguments, the states and the task types: fixed values, too.
LEVEL_WORDS = ("optim_ops_level", "ops_level", "optimized ops level", "full_ops_level")
BUNDLE_WORDS = ("bundle", "webdataset", "bundled wds", "--bundle-wds")
NUMBERS = {
    "n_sample": (int, (r"sampled?\s+(\d+)\s*cell", r"(\d+)\s*cell[s]?\s+(?:per|from each)\s+sample")),
    "mpp": (float, (r"mpp[=\s]+(\d+(?:\.\d+)?|\.\d+)",)),
    "patch_size": (int, (r"patch\s+size[=\s]+(\d+)",)),
}
SAMPLES = r"[Pp]rocess\s+(\w+(?:,\w+)+)"
TASK_TYPES = {
    "he2st": ("he2st", "he → gene expression", "spatial transcriptomics prediction"),
    "celltype": ("cell type", "celltype classification"),
    "contrastive": ("contrastive", "self-supervised"),
    "multimodal_pretraining": ("multimodal pretraining", "foundation model"),
    "spatial_neighbor": ("spatial neighbor", "neighborhood graph"),
}
STATUSES = ("training_ready", "split_pending", "compile_only", "patch_compiled_only", "validation_failed")


@dataclass(frozen=True)
class Stage:
    name: str
    input_key: str
    output_key: str


@dataclass
class Plan:
    stages: list[Stage] = field(default_factory=list)
    extract: dict = field(default_factory=dict)
    compile: dict = field(default_factory=dict)
    final_key: str = "table"
    tissue_key: str = "tissue"
    filtered_key: str = "filtered_table"

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.stages]


def stages_in(text: str) -> list[str]:
    return [name for name, (_, phrases) in STAGES.items() if re.search("|".join(phrases), text.lower())]


def parse(text: str, table_key: str = "table", shapes_key: str = "cell_circles", tissue_key: str = "tissue", filtered_key: str = "filtered_table") -> Plan:
    """The plan of a request; every stage reads what the one before wrote."""
    low, plan, key = text.lower(), Plan(tissue_key=tissue_key, filtered_key=filtered_key), table_key
    for name in stages_in(text):
        plan.stages.append(Stage(name, key, f"{key}_{STAGES[name][0]}"))
        key = plan.stages[-1].output_key
    if any(w in low for w in LEVEL_WORDS):
        plan.extract["extract_mode"] = "full_ops_level"
    for name, (kind, patterns) in NUMBERS.items():
        if m := next(filter(None, (re.search(p, low) for p in patterns)), None):
            plan.extract[name] = kind(m[1])
    if any(w in low for w in BUNDLE_WORDS):
        plan.compile["bundle"] = True
    if m := re.search(SAMPLES, text):
        plan.compile["samples"] = m[1].split(",")
    plan.final_key = plan.extract["table_key"] = key
    plan.extract["shapes_key"] = shapes_key
    return plan


def task_type(text: str) -> str | None:
    """The task that a request names, None if it names none."""
    low = text.lower()
    return next((t for t, phrases in TASK_TYPES.items() if any(p in low for p in phrases)), None)


def task_type_column(text: Column) -> Column:
    """The same over a column of requests."""
    low, out = F.lower(text), F.lit(None).cast("string")
    for name, phrases in reversed(TASK_TYPES.items()):
        out = F.when(reduce(Column.__or__, [low.contains(p) for p in phrases]), name).otherwise(out)
    return out


def render(plan: Plan, samples: list[str], root: str, output: str = "out") -> list[str]:
    """The steps of a plan as what follows ``python -m spotloom``, one to a line; all samples are one job."""
    at = f"--root {shlex.quote(root)} --samples {' '.join(map(shlex.quote, samples))}"
    steps = [f"inspect {at}"]
    for s in plan.stages:
        extra = f" --tissue-key {shlex.quote(plan.tissue_key)}" if s.name == "tissue_inside" else ""
        steps.append(f"filter {s.name} {at} --in {s.input_key} --out {s.output_key}{extra}")
    flags = "".join(f" --{k.replace('_', '-')} {v}" for k, v in plan.extract.items() if k != "shapes_key")
    out = shlex.quote(output)
    steps.append(f"extract {at} --output {out}{flags}")
    some = f" --samples {' '.join(plan.compile['samples'])}" if "samples" in plan.compile else ""
    steps.append(f"compile --root {out} --output {shlex.quote(output + '/compiled')}{some}" + " --bundle" * bool(plan.compile.get("bundle")))
    return steps


def stage_columns(text: Column) -> dict[str, Column]:
    """A flag for each stage, over a column of requests."""
    return {name: F.lower(text).rlike("|".join(phrases)) for name, (_, phrases) in STAGES.items()}


def argument_columns(text: Column) -> dict[str, Column]:
    """The arguments of a column of requests, null where a request doesn't name one."""
    low, out = F.lower(text), {}
    for name, (kind, patterns) in NUMBERS.items():
        found = [F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for p in patterns]
        out[name] = F.coalesce(*found).cast("bigint" if kind is int else "double")
    out["ops_level"] = F.lit(False)
    for w in LEVEL_WORDS:
        out["ops_level"] = out["ops_level"] | low.contains(w)
    out["bundle"] = F.lit(False)
    for w in BUNDLE_WORDS:
        out["bundle"] = out["bundle"] | low.contains(w)
    out["samples"] = F.nullif(F.regexp_extract(text, SAMPLES, 1), F.lit(""))
    return out


def plan_requests(requests: DataFrame, text: str = "request") -> DataFrame:
    """Many requests at once: stage flags, arguments and the final table key."""
    flags, args = stage_columns(F.col(text)), argument_columns(F.col(text))
    key = F.concat(F.lit("table"), *(F.when(F.col(n), f"_{STAGES[n][0]}").otherwise("") for n in STAGES))
    return requests.withColumns({**flags, **args}).withColumn("final_table_key", key)


def ready_status(compiled: bool, valid: bool = True, has_split: bool = False, deferred: bool = False, extracted: bool = False) -> str:
    """Whether a dataset can be trained on."""
    if not valid:
        return "validation_failed"
    if not compiled:
        return "patch_compiled_only" if extracted else "not_compiled"
    return "training_ready" if has_split else "split_pending" if deferred else "compile_only"


def build_parser() -> argparse.ArgumentParser:
    """The extract command's options and their defaults."""
    p = argparse.ArgumentParser(prog="spotloom extract")
    p.add_argument("--root", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--samples", nargs="*")
    for name, default in (("image-key", "he_image"), ("shapes-key", "cell_circles"), ("table-key", "table"), ("tissue-key", "auto"), ("cell-key", "auto"), ("nucleus-key", "auto"), ("cell-id-column", "cell_id"), ("filter-report-name", "filter_report.json")):
        p.add_argument(f"--{name}", default=default)
    p.add_argument("--patch-size", type=int, default=224)
    p.add_argument("--mpp", type=float, default=0.5)
    p.add_argument("--shard-size", type=int, default=500)
    p.add_argument("--n-sample", type=int, default=0)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--extract-mode", default="tile_images", choices=("tile_images", "full_scale0", "full_ops_level"))
    p.add_argument("--patch-policy", default="auto")
    return p


def parse_args(argv: list[str]) -> argparse.Namespace:
    """Parsed options; a policy that a mode doesn't allow ends the program before any job.

    ``patch_policy`` is the one that is applied, ``patch_policy_requested`` what was asked for.
    """
    args = build_parser().parse_args(argv)
    args.patch_policy_requested = args.patch_policy
    try:
        args.patch_policy = validate_policy(args.patch_policy, args.extract_mode)
    except (ValueError, NotImplementedError) as e:
        raise SystemExit(str(e)) from e
    return args
