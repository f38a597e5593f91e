"""Split membership as metadata: policies, validation, reports."""

from __future__ import annotations

import json
import warnings
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import store
from .manifest import check_manifest, dense_index, hashed_ranks

BASE = ("global_idx", "sample_id", "cell_id")
POLICIES = ("sample_holdout", "ratio_by_group", "group_kfold", "existing_file", "spatial_block", "leave_one_group_out")


def _stamp(rows: DataFrame, task: str, policy: str, level: str, **extra: Column) -> DataFrame:
    return rows.withColumns({"task": F.lit(task), "split_policy": F.lit(policy), "generated_at_level": F.lit(level), **extra})


def sample_holdout(manifest: DataFrame, task: str, train: list[str], val: list[str] | None = (), test: list[str] | None = ()) -> DataFrame:
    """Whole samples by list. A list may be empty, not None; a sample may be named once; all must be named and exist."""
    lists = {"train": train, "val": val, "test": test}
    if missing := [k for k, v in lists.items() if v is None]:
        raise ValueError(f"sample lists are missing: {missing}")
    seen: dict[str, str] = {}
    for split, samples in lists.items():
        for s in samples:
            if s in seen:
                raise ValueError(f"leakage detected: sample {s!r} is in {seen[s]!r} and {split!r}")
            seen[s] = split
    spark = manifest.sparkSession
    named = spark.createDataFrame(list(seen.items()), "__s string, split string")
    present = manifest.select(F.col("sample_id").alias("__s")).distinct()
    if phantom := [r[0] for r in named.join(present, "__s", "left_anti").orderBy("__s").collect()]:
        raise ValueError(f"samples not in the manifest: {phantom}")
    if left := [r[0] for r in present.join(named, "__s", "left_anti").orderBy("__s").limit(5).collect()]:
        raise ValueError(f"samples without a split: {left}")
    out = manifest.select(*BASE).join(named, F.col("sample_id") == F.col("__s")).drop("__s")
    return _stamp(out, task, "sample_holdout", "sample")


def shuffled_groups(manifest: DataFrame, group: str, seed: int, ordering: str = "md5") -> DataFrame:
    """(group_id, rank, n): a seeded order of the distinct groups.

    ``md5`` orders by a keyed hash, as SQL can; ``numpy`` permutes the sorted groups with
    numpy's default generator on the driver, for which it collects the distinct groups.
    """
    groups = manifest.select(F.col(group).alias("group_id")).distinct()
    if ordering == "numpy":
        names = sorted(r[0] for r in groups.collect())
        order = np.array(names, dtype=object)
        np.random.default_rng(seed).shuffle(order)
        return manifest.sparkSession.createDataFrame([(g, i, len(order)) for i, g in enumerate(order.tolist())], f"group_id {manifest.schema[group].dataType.simpleString()}, rank int, n int")
    if ordering != "md5":
        raise ValueError(f"unknown ordering {ordering!r}")
    return hashed_ranks(groups, F.md5(F.concat(F.lit(f"{seed}:"), F.col("group_id").cast("string"))), "group_id")


def ratio_counts(n: int, ratios: tuple[float, float, float]) -> tuple[int, int]:
    """Groups of train and val; the rest is test. Train has one at least, val gives way to test."""
    train, val = max(1, round(n * ratios[0])), max(0, round(n * ratios[1]))
    if train + val >= n:
        fixed = max(0, n - train - 1)
        if fixed != val:
            warnings.warn(f"{n} groups leave {fixed} for val so that test can have one", stacklevel=2)
        val = fixed
    return train, val


def ratio_by_group(manifest: DataFrame, task: str, group: str, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, ordering: str = "md5") -> DataFrame:
    """Whole groups by ranks of a seeded order."""
    if len(ratios) != 3 or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios are three numbers that sum to 1")
    if group not in manifest.columns:
        raise ValueError(f"group column {group!r} not in the manifest")
    order = shuffled_groups(manifest, group, seed, ordering)
    train, val = ratio_counts(manifest.select(group).distinct().count(), ratios)
    placed = order.withColumn("split", F.when(F.col("rank") < train, "train").when(F.col("rank") < train + val, "val").otherwise("test"))
    out = manifest.select(*BASE, F.col(group).alias("__g")).join(placed.select("group_id", "split"), F.col("__g").eqNullSafe(F.col("group_id"))).drop("__g")
    return _stamp(out, task, "ratio_by_group", "group", seed=F.lit(seed))


def hash_split(group: Column, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> Column:
    """train, val or test by a keyed hash of a group alone, whatever other groups there are or come later."""
    at = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), group.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.when(at < int(ratios[0] * 2**32), "train").when(at < int((ratios[0] + ratios[1]) * 2**32), "val").otherwise("test")


def hash_by_group(rows: DataFrame, task: str, group: str, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """The rows with a split that never changes as groups are added; ratios are met on average, not counted."""
    if len(ratios) != 3 or abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios are three numbers that sum to 1")
    if group not in rows.columns:
        raise ValueError(f"group column {group!r} not in the manifest")
    return _stamp(rows.withColumn("split", hash_split(F.col(group), ratios, seed)), task, "hash_by_group", "group", seed=F.lit(seed))


def group_kfold(manifest: DataFrame, task: str, group: str, n_folds: int = 5, fold: int | None = None, seed: int = 42, ordering: str = "md5") -> DataFrame:
    """Folds dealt in turn over a seeded order of groups; one fold may be held as val."""
    if n_folds < 2:
        raise ValueError("two folds are needed at least")
    if fold is not None and not 0 <= fold < n_folds:
        raise ValueError(f"fold {fold} is not within 0..{n_folds - 1}")
    placed = shuffled_groups(manifest, group, seed, ordering).select("group_id", (F.col("rank") % n_folds).cast("int").alias("fold"))
    out = manifest.select(*BASE, F.col(group).alias("__g")).join(placed, F.col("__g").eqNullSafe(F.col("group_id"))).drop("__g")
    label = F.concat(F.lit("fold_"), F.col("fold").cast("string")) if fold is None else F.when(F.col("fold") == fold, "val").otherwise("train")
    return _stamp(out.withColumn("split", label), task, "group_kfold", "group", seed=F.lit(seed))


def _first_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in an explicit order, as one aggregate."""
    return rows.groupBy(key).agg(F.min_by("split", F.struct(*order, "split")).alias("split"))


def existing(manifest: DataFrame, task: str, external: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A given assignment by sample (if it has ``sample_id``) or else by cell; the first row of a key counts.

    Rows are in the order of the columns ``order``, or else of ``file_position`` if the assignment was read
    from a file; of cells that occur more than once, a warning tells the number.
    """
    if "split" not in external.columns:
        raise ValueError("the split file has no column 'split'")
    by_sample = "sample_id" in external.columns
    key = "sample_id" if by_sample else "global_idx"
    if key not in external.columns:
        raise ValueError("the split file has neither 'sample_id' nor 'global_idx'")
    if not by_sample and (n := external.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").agg(F.sum("n")).first()[0]):
        warnings.warn(f"{n} rows of the split file repeat a global_idx; the first of each counts", stacklevel=2)
    given = _first_of(external, key, order or (["file_position"] if "file_position" in external.columns else [key])).withColumnRenamed(key, "__key")
    out = manifest.select(*BASE).join(given, F.col(key) == F.col("__key"), "left").drop("__key")
    warn = {} if by_sample else {"leakage_warning": F.lit("split given by cell: cells of one sample may be on both sides")}
    return _stamp(out, task, "existing_file", "sample" if by_sample else "cell", **warn)


def require_assigned(membership: DataFrame) -> DataFrame:
    if n := membership.filter("split IS NULL").count():
        raise ValueError(f"{n} cells have no split")
    return membership


def spatial_block(manifest: DataFrame, task: str, x: str, y: str, size: float, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """Square blocks of a sample as groups."""
    block = F.concat_ws(":", F.col("sample_id").cast("string"), F.floor(F.col(x) / size).cast("string"), F.floor(F.col(y) / size).cast("string"))
    out = ratio_by_group(manifest.withColumn("block_id", block), task, "block_id", ratios, seed)
    return out.withColumns({"split_policy": F.lit("spatial_block"), "generated_at_level": F.lit("block")})


def leave_one_group_out(manifest: DataFrame, task: str, group: str) -> DataFrame:
    """Each group is a fold, numbered in order."""
    folds = manifest.select(F.col(group).alias("group_id")).distinct().select("group_id", (F.row_number().over(Window.orderBy("group_id")) - 1).cast("int").alias("fold"))
    out = manifest.select(*BASE, F.col(group).alias("__g")).join(folds, F.col("__g").eqNullSafe(F.col("group_id"))).drop("__g")
    return _stamp(out.withColumn("split", F.concat(F.lit("fold_"), F.col("fold").cast("string"))), task, "leave_one_group_out", "group")


def split_membership(manifest: DataFrame, policy: str, task: str, **args) -> DataFrame:
    """The membership of a policy. Random cells are refused: cells of a sample would be on both sides."""
    check_manifest(manifest)
    if policy in ("random_cell", "random"):
        raise ValueError("random splits of cells leak; split by sample or group")
    if policy == "defer_split":
        raise ValueError("a deferred split has no membership")
    if policy not in POLICIES:
        raise ValueError(f"unknown split policy {policy!r}")
    if policy == "existing_file":
        return require_assigned(existing(manifest, task, **args))
    return globals()[policy](manifest, task, **args)


# Validation: every check is a relation of violations.


def leaking_samples(membership: DataFrame) -> DataFrame:
    """(sample_id, n_splits) of samples in several splits."""
    return membership.groupBy("sample_id").agg(F.countDistinct("split").alias("n_splits")).filter("n_splits > 1")


def leaking_groups(membership: DataFrame) -> DataFrame:
    """(group_id, n_folds) of groups in several folds."""
    return membership.groupBy("group_id").agg(F.countDistinct("fold").alias("n_folds")).filter("n_folds > 1")


def duplicates(membership: DataFrame, key: str = "global_idx") -> DataFrame:
    return membership.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def uncovered(membership: DataFrame, manifest: DataFrame) -> DataFrame:
    """Cells of the manifest without a membership."""
    return manifest.select("global_idx").join(membership.select("global_idx"), "global_idx", "left_anti")


def phantoms(membership: DataFrame, manifest: DataFrame) -> DataFrame:
    """Members that the manifest lacks."""
    return membership.select("global_idx").join(manifest.select("global_idx"), "global_idx", "left_anti")


def validate(membership: DataFrame, manifest: DataFrame) -> list[str]:
    """Warnings; violations are errors. Samples are checked for holdout and ratio, groups for folds."""
    if (n := phantoms(membership, manifest).count()) or (m := uncovered(membership, manifest).count()):
        raise ValueError(f"membership and manifest differ: {n} cells not in the manifest" if n else f"membership lacks {m} cells of the manifest")
    if not duplicates(membership).isEmpty():
        raise ValueError("cells occur more than once in the membership")
    policy = membership.select("split_policy").first()
    if policy and policy[0] in ("sample_holdout", "ratio_by_group"):
        if bad := [r[0] for r in leaking_samples(membership).orderBy("sample_id").limit(5).collect()]:
            raise ValueError(f"leakage detected: samples in several splits: {bad}")
    if "fold" in membership.columns and "group_id" in membership.columns:
        if bad := [r[0] for r in leaking_groups(membership).orderBy("group_id").limit(5).collect()]:
            raise ValueError(f"leakage detected: groups in several folds: {bad}")
    if "leakage_warning" in membership.columns:
        return sorted(r[0] for r in membership.select("leakage_warning").filter("leakage_warning IS NOT NULL").distinct().collect())
    return []


def split_counts(membership: DataFrame) -> DataFrame:
    return membership.groupBy("split").agg(F.count("*").alias("n_cells"))


def sample_split_counts(membership: DataFrame) -> DataFrame:
    return membership.groupBy("sample_id", "split").agg(F.count("*").alias("n_cells"))


def split_rows(rows: DataFrame, membership: DataFrame, split: str, key: str = "global_idx") -> DataFrame:
    """Rows of one split, at load time: a semi-join."""
    return rows.join(membership.filter(F.col("split") == split).select(key), key, "left_semi")


def summarize(membership: DataFrame, task: str) -> dict:
    """The split report: first-row metadata and counts."""
    names = [c for c in ("split_policy", "generated_at_level", "seed") if c in membership.columns]
    first = membership.orderBy("global_idx").select(*names).first()
    per_sample = [r.asDict() for r in sample_split_counts(membership).orderBy("sample_id", "split").collect()]
    by_split: dict[str, int] = {}
    for r in per_sample:
        by_split[r["split"]] = by_split.get(r["split"], 0) + r["n_cells"]
    report = {
        "task": task,
        **{c: first[c] if first and c in names else None for c in ("split_policy", "generated_at_level", "seed")},
        "n_cells_total": sum(by_split.values()),
        "counts_by_split": by_split,
        "per_sample_counts": per_sample,
        "created_at": datetime.now(tz=timezone.utc).isoformat(),
    }
    if "leakage_warning" in membership.columns and (row := membership.filter("leakage_warning IS NOT NULL").select("leakage_warning").first()):
        report["leakage_warning"] = row[0]
    return report


def leakage_report(membership: DataFrame, manifest: DataFrame, policy: str) -> dict:
    """What the checks found, whether or not it is an error."""
    head = lambda d, c: [r[0] for r in d.orderBy(c).limit(5).collect()]
    report = {"split_policy": policy, "samples_in_several_splits": head(leaking_samples(membership), "sample_id"), "n_uncovered": uncovered(membership, manifest).count(), "n_phantom": phantoms(membership, manifest).count(), "n_repeated": duplicates(membership).count()}
    if {"fold", "group_id"} <= set(membership.columns):
        report["groups_in_several_folds"] = head(leaking_groups(membership), "group_id")
    report["leaks"] = bool(report["samples_in_several_splits"] or report.get("groups_in_several_folds"))
    return report


def write_split(membership: DataFrame, folder: str, task: str, prefix: str = "") -> dict[str, str]:
    """membership parquet, one directory of indices for each split, and the report.

    The lists are written by the executors, as sorted JSON lines: a split may be larger than
    the driver. The membership is computed once and read again from what was written.
    """
    head = f"{folder}/{prefix + '_' if prefix else ''}"
    paths = {"membership": f"{head}split_membership.parquet"}
    membership.write.mode("overwrite").parquet(paths["membership"])
    written = membership.sparkSession.read.parquet(paths["membership"])
    for split in ("train", "val", "test"):
        paths[split] = f"{head}{split}.json"
        written.filter(F.col("split") == split).select("global_idx").sort("global_idx").write.mode("overwrite").json(paths[split])
    paths["report"] = f"{head}split_report.json"
    store.write_json(paths["report"], summarize(written, task))
    return paths


def read_split_list(spark: SparkSession, path: str) -> DataFrame:
    """(global_idx) of a split's list, whether it was written as JSON lines or as one JSON list."""
    text = spark.read.text(path).filter("trim(value) <> ''")
    one = F.from_json("value", "array<bigint>")
    single = text.filter("value LIKE '[%'").select(F.explode(one).alias("global_idx"))
    return single.union(text.filter("value LIKE '{%'").select(F.get_json_object("value", "$.global_idx").cast("bigint").alias("global_idx")))


def write_split_list(membership: DataFrame, split: str, path: str) -> str:
    """One JSON list of a split's indices, for readers that need a single file: a split that the driver can hold."""
    rows = membership.filter(F.col("split") == split).select("global_idx").sort("global_idx").toLocalIterator()
    return store.write_text(path, json.dumps([r[0] for r in rows]))


def split_positions(membership: DataFrame) -> DataFrame:
    """(split, position, global_idx): the lists of all splits as rows, in the order of the index; none is collected."""
    rows = dense_index(membership.select("split", "global_idx"), "split", "global_idx", "__at")
    first = rows.groupBy("split").agg(F.min("__at").alias("__first"))
    return rows.join(first, "split").select("split", (F.col("__at") - F.col("__first")).alias("position"), "global_idx")
