"""Composite entry points: extract, compile, load and package, each a DataFrame pipeline over all samples."""

from __future__ import annotations

import time
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import sparse
from ..session import cut, small
from ..sources import catalog, files, shards, store, tiles
from . import align, filters, genes, manifest, metrics, reports, spatial, splits


def _slides(slides: DataFrame | None, width: float | None, height: float | None, base: float | None, samples: DataFrame) -> DataFrame:
    """(sample_id, width, height, base, ...): given by sample, or one size for all."""
    if slides is not None:
        return slides
    return samples.select("sample_id").distinct().select("sample_id", *(F.lit(float(v)).alias(n) for n, v in (("width", width), ("height", height), ("base", base))))


def extract(cells: DataFrame, shapes: DataFrame, *, slides: DataFrame | None = None, width: float | None = None, height: float | None = None, base: float | None = None, policy: str = "auto", mode: str = filters.TILES, shard_size: int = manifest.SHARD, n_sample: int = 0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(manifest, report with a row for each sample) of aligned, filtered, sampled and spatially ordered cells of all samples.

    ``cells``: (sample_id, cell_id, pos); ``shapes``: (sample_id, shape_id, pos, x_px, y_px), where the
    sample may be left out if there is one; ``slides``: (sample_id, width, height, base), or the three
    numbers for all. Ids and positions are those of a sample: equal ones of other samples never meet.
    """
    filters.validate_policy(policy, mode)
    if "sample_id" not in shapes.columns:
        names = [r[0] for r in cells.select("sample_id").distinct().limit(2).collect()]
        if len(names) > 1:
            raise ValueError("shapes of several samples need a column 'sample_id'")
        shapes = shapes.withColumn("sample_id", F.lit(names[0] if names else None).cast("string"))
    _, aligned = align.align_samples(cells, shapes)
    places = shapes.select("sample_id", F.col("pos").cast("bigint").alias("shape_pos"), "x_px", "y_px")
    sized = small(_slides(slides, width, height, base, cells))  # one row for each sample
    placed = aligned.join(places, ["sample_id", "shape_pos"]).join(sized, "sample_id")
    masked = filters.with_masks(placed, F.col("width"), F.col("height"), F.col("base"))
    # Aligned once: counts, samples, ranks and the report read what is cut here.
    masked = cut(masked)
    kept = filters.sample_each(filters.survivors(masked, policy, mode), n_sample, seed, "cell_id")
    source = cells.groupBy("sample_id").agg(F.count("*").alias("n_cells"))
    counts = filters.filter_report(masked, 0, policy, mode, "sample_id").join(source, "sample_id")
    counts = counts.withColumn("n_source", F.col("n_cells")).drop("n_cells")
    if not n_sample:
        report = counts.withColumn("n_valid", F.col("n_out"))
    else:
        report = counts.withColumnRenamed("n_out", "n_valid").withColumn("n_out", F.lit(n_sample).cast("bigint"))
    report = report.join(sized, "sample_id")
    ordered = manifest.spatial_order(kept.withColumn("tile_key", S.tile_key(F.col("sx0"), F.col("sy0"))), "tile_key", "row_pos", "sample_id")
    out = manifest.with_shards(ordered, size=shard_size).withColumn("sample_key", S.padded(F.col("sample_index"), 7))
    return out.select("sample_index", "sample_key", "sample_id", "cell_id", F.col("x_px").alias("center_x_pixel"), F.col("y_px").alias("center_y_pixel"), F.col("sx0").alias("bbox_x0"), F.col("sy0").alias("bbox_y0"), F.col("table_pos").alias("gene_row_index"), "shard_no", "local_index", "shard_path", F.col("sample_index").alias("expr_row")), report


def slides_of(spark: SparkSession, root: str, samples: list[str], patch: int = 224, mpp: float = 0.5, image: str = "slide") -> DataFrame:
    """(sample_id, width, height, base, slide_mpp) from the slides' table (width, height, a00, a01, a10, a11, s00, s11)."""
    rows = catalog.elements(spark, root, samples, "images", image)
    own = S.slide_mpp(*(F.col(c) for c in ("a00", "a01", "a10", "a11", "s00", "s11")))
    return rows.select("sample_id", "width", "height", S.base_size(F.lit(float(patch)), F.lit(float(mpp)), own).cast("double").alias("base"), own.alias("slide_mpp"))


def done_samples(root: str, samples: list[str], report_name: str = "filter_report.json", **asked) -> list[str]:
    """Samples whose manifest and expression were both written whole; those that were asked for otherwise then are warned of."""
    done = [s for s in samples if all(store.exists(f"{root}/{s}/{name}/_SUCCESS") for name in ("manifest.parquet", "expression.parquet"))]
    for s in done if asked else []:
        path = f"{root}/{s}/meta/{report_name}"
        then = store.read_json(path) if store.exists(path) else {}
        if other := {k: then[k] for k, v in asked.items() if k in then and then[k] != v}:
            warnings.warn(f"{s} is done with {other}, which now would be {({k: asked[k] for k in other})}; remove its folder to extract it anew", stacklevel=3)
    return done


def _sound(spark: SparkSession, root: str, samples: list[str], **elements: tuple[str, str]) -> tuple[list[str], dict[str, str]]:
    """(samples whose elements can be opened and whose ids meet, the reason of each other)."""
    failed = {}
    for s in samples:
        try:
            for kind, key in elements.values():
                catalog.element(spark, root, s, kind, key)
        except Exception as e:  # noqa: BLE001  whatever is wrong with a sample, the others go on
            failed[s] = f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"
    return [s for s in samples if s not in failed], failed


def extract_all(spark: SparkSession, root: str, output: str, samples: list[str], *, table: str = "table", shapes: str = "cell_circles", image: str = "slide", cell_id: str = "cell_id", patch: int = 224, mpp: float = 0.5, policy: str = "auto", mode: str = filters.TILES, shard_size: int = manifest.SHARD, n_sample: int = 0, seed: int = 42, report_name: str = "filter_report.json", read: Callable | None = None) -> dict[str, list[str]]:
    """Extract all samples that aren't done in one job, and write each its own folder; names by what became of them.

    Elements of a sample: tables/{table} (cell_id, pos, indices, values), shapes/{shapes} (shape_id, pos, x_px, y_px),
    images/{image} and, for compiling, genes/{table} (gene, pos). Reports are written before any shard. Shards are built
    if there are tiles: from ``read``, a reader of them, or else from images/{image}_patches (cell_id, image) where every sample has it.

    All samples are written in one pass, partitioned by sample, and each one's partition is then moved to its folder.
    A sample that can't be opened or has no ids in common with its shapes is left out, under ``failed`` with the reason
    in {output}/extract_status.json, and doesn't keep the others from being done; if all fail, that is an error.
    """
    policy_applied = filters.validate_policy(policy, mode)
    asked = dict(image_key=image, extract_mode=mode, source_table_key=table, source_shape_key=shapes, patch_policy_applied=policy_applied, patch_size=patch, target_mpp=mpp, seed=seed)
    skipped = done_samples(output, samples, report_name, **asked)
    todo, failed = _sound(spark, root, [s for s in samples if s not in skipped], cells=("tables", table), shapes=("shapes", shapes), image=("images", image))
    out = {"done": [], "skipped": skipped}
    if todo:
        cells = catalog.elements(spark, root, todo, "tables", table)
        if cell_id not in cells.columns:
            raise KeyError(f"the tables have no column {cell_id!r}; available: {cells.columns}")
        cells = cells if cell_id == "cell_id" else cells.drop("cell_id").withColumnRenamed(cell_id, "cell_id")
        placed = catalog.elements(spark, root, todo, "shapes", shapes)
        failed |= {s: "ValueError: table and shapes have no id in common" for s in align.unmatched(cells, placed)}
        todo = [s for s in todo if s not in failed]
    if not todo and failed:
        raise ValueError(f"no sample could be extracted: {failed}")
    if todo:
        sound = lambda d: d.filter(F.col("sample_id").isin(todo))
        cells, placed = sound(cells), sound(placed)
        rows, report = extract(cells, placed, slides=slides_of(spark, root, todo, patch, mpp, image), policy=policy, mode=mode, shard_size=shard_size, n_sample=n_sample, seed=seed)
        rows = cut(rows)
        for r in reports.filter_reports(report, zarr_path=root, output_dir=output, patch_policy_requested=policy, **asked):
            reports.write_filter_report(r, f"{output}/{r['sample_id']}", report_name)
        tiled = tiles.read_tiles(rows, read) if read is not None else tiles.stored_tiles(spark, root, todo, image, rows)
        if tiled is not None:
            built = cut(shards.build_shards(tiled))
            shards.write_shards(built, output)
            rows = attach_offsets(rows, built)
        expression = expression_in_order(rows, cells.withColumnRenamed("pos", "row"))
        _write_by_sample({"expression.parquet": expression, "manifest.parquet": rows}, output, todo)
        for s in todo:
            if (names := catalog.genes_of(spark, root, s, table)) is not None:
                store.write_json(f"{output}/{s}/genes.json", names)
        out["done"] = todo
    if failed:
        out["failed"] = sorted(failed)
    state = {s: {"state": k} for k, names in out.items() for s in names} | {s: {"state": "failed", "reason": why} for s, why in failed.items()}
    store.write_json(f"{output}/extract_status.json", state)
    return out


def _write_by_sample(tables: dict[str, DataFrame], output: str, samples: list[str]) -> None:
    """Write tables in one pass each, and move every sample's partition to {output}/{sample}/{name}; one without rows is an empty table."""
    staging = f"{output}/_staging-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.withColumn("__of", F.col("sample_id")).write.partitionBy("__of").parquet(f"{staging}/{name}")
    for s in samples:
        for name, rows in tables.items():
            part = f"{staging}/{name}/{catalog.partition_name('__of', s)}"
            if not store.exists(part):
                rows.limit(0).write.mode("overwrite").parquet(f"{output}/{s}/{name}")
                continue
            store.write_text(f"{part}/_SUCCESS", "")
            store.rename(part, f"{output}/{s}/{name}")
    store.remove(staging)


#: Filter stages, in the order in which they run.
STAGES = ("tissue_inside", "nucleus_presence", "xenium_he_nucleus_overlap")


def filter_stage(stage: str, cells: DataFrame, layers: dict[str, DataFrame], *, threshold: float = 0.5, transform: tuple[float, ...] | None = None) -> tuple[DataFrame, dict[str, int], int, int]:
    """(cells that stay, drops by reason, cells in, cells out) of one stage; no cell that stays is an error.

    ``layers``: shapes (shape_id, x, y) and tissue (rings); nuclei (shape_id); or nuclei and he (boxes or rings).
    """
    if stage == "tissue_inside":
        args = (cells, layers["shapes"], layers["tissue"])
        kept, row = spatial.tissue_filter(*args, transform=transform), spatial.tissue_counts(*args, transform=transform).first()
        drops = {"outside_tissue": row["outside_tissue"]}
    elif stage == "nucleus_presence":
        kept, row = align.presence(cells, layers["nuclei"]), align.presence_counts(cells, layers["nuclei"]).first()
        drops = {"missing_nucleus_boundary": row["no_nucleus"]} if row["no_nucleus"] else {}
    elif stage == "xenium_he_nucleus_overlap":
        nuclei = layers["nuclei"].withColumnRenamed("shape_id", "cell_id")
        kept, row = spatial.overlap_filter(cells, nuclei, layers["he"], threshold), spatial.overlap_counts(cells, nuclei, layers["he"], threshold).first()
        drops = reports.overlap_reasons(row.asDict())
    else:
        raise ValueError(f"unknown stage {stage!r}; known: {', '.join(STAGES)}")
    if not row["n_kept"]:
        raise ValueError(f"{stage}: no cells overlap")
    return kept, drops, row["n_in"], row["n_kept"]


def run_stage(spark: SparkSession, root: str, sample: str, stage: str, in_key: str = "table", out_key: str | None = None, *, keys: dict[str, str] | None = None, threshold: float = 0.5, report_dir: str | None = None) -> reports.StageReport:
    """Read a table, keep what the stage keeps, write it under another key, and report."""
    began = time.perf_counter()
    suffix = {"tissue_inside": "tissue", "nucleus_presence": "nucleus", "xenium_he_nucleus_overlap": "he"}
    if stage not in suffix:
        raise ValueError(f"unknown stage {stage!r}; known: {', '.join(STAGES)}")
    out_key = out_key or f"{in_key}_{suffix[stage]}"
    wanted = {"tissue_inside": {"shapes": "cell_circles", "tissue": "tissue"}, "nucleus_presence": {"nuclei": "nucleus_boundaries"}, "xenium_he_nucleus_overlap": {"nuclei": "nucleus_boundaries", "he": "he_nuclei"}}[stage]
    names = {k: (keys or {}).get(k, v) for k, v in wanted.items()}
    layers = {k: catalog.element(spark, root, sample, "shapes", v) for k, v in names.items()}
    if "shapes" in layers and "x" not in layers["shapes"].columns:
        layers["shapes"] = layers["shapes"].withColumnsRenamed({"x_px": "x", "y_px": "y"})
    found = catalog.transform_of(spark, root, sample, "shapes", names["tissue"]) if stage == "tissue_inside" else None
    kept, drops, n_in, n_out = filter_stage(stage, catalog.element(spark, root, sample, "tables", in_key), layers, threshold=threshold, transform=found)
    catalog.write_element(kept.drop("sample_id"), root, sample, "tables", out_key)
    held = {"tissue_inside": ("shapes", "tissue"), "nucleus_presence": ("nuclei", "nuclei"), "xenium_he_nucleus_overlap": ("nuclei", "he")}[stage]
    report = reports.StageReport(stage, f"{root}/{sample}", in_key, out_key, n_in, n_out, drops, {"threshold": threshold, **names}, elapsed_s=round(time.perf_counter() - began, 3), input_shape_key=names[held[0]], output_shape_key=names[held[1]])
    if report_dir:
        reports.write_stage_report(report, report_dir)
    return report


def attach_offsets(rows: DataFrame, written: DataFrame) -> DataFrame:
    """A manifest with where the shard writer put each cell."""
    return rows.join(shards.offsets(written), ["sample_id", "shard_path", "sample_index"])


def expression_in_order(rows: DataFrame, expression: DataFrame) -> DataFrame:
    """(sample_id, expr_row, cell_id, indices, values) of the cells of a manifest."""
    e = expression.select("sample_id", F.col("row").alias("gene_row_index"), "indices", "values")
    return rows.join(e, ["sample_id", "gene_row_index"]).select("sample_id", "expr_row", "cell_id", "indices", "values")


def compile_dataset(manifests: list[DataFrame], entries: DataFrame, gene_lists: DataFrame, *, policy: str = "first_sample", explicit: list[str] | None = None, order: str = "sample_index") -> tuple[DataFrame, DataFrame, list[str]]:
    """(global manifest, expression by global_idx, panel); the panel is resolved before anything is written.

    ``entries``: (sample_id, expr_row, gene, value); ``gene_lists``: (sample, gene, pos).
    """
    panel = genes.resolve_panel(gene_lists, policy, explicit=explicit)
    rows = manifest.dense_index(manifest.union_samples(manifests), "sample_id", order)
    spark = rows.sparkSession
    table = spark.createDataFrame(list(zip(panel, range(len(panel)), strict=True)), "gene string, gene_idx int")
    placed = entries.join(rows.select("sample_id", "expr_row", F.col("global_idx").alias("cell")), ["sample_id", "expr_row"])
    on_panel = genes.slice_genes(placed, table)
    packed = sparse.from_coordinates(on_panel.withColumnRenamed("cell", "global_idx"), "global_idx")
    empty = F.array().cast("array<int>"), F.array().cast("array<float>")
    full = rows.select("global_idx").join(packed, "global_idx", "left").select("global_idx", F.coalesce("indices", empty[0]).alias("indices"), F.coalesce("values", empty[1]).alias("values"))
    return rows, full, panel


def named_entries(expression: DataFrame, lists: DataFrame) -> DataFrame:
    """(sample_id, expr_row, gene, value) of all samples' sparse rows, each over its own list of genes.

    ``expression``: (sample_id, expr_row, indices, values); ``lists``: (sample_id, idx, gene).
    """
    each = expression.select("sample_id", "expr_row", F.explode(F.arrays_zip("indices", "values")).alias("e"))
    each = each.select("sample_id", "expr_row", F.col("e.indices").cast("bigint").alias("idx"), F.col("e.values").alias("value"))
    return each.join(lists, ["sample_id", "idx"]).select("sample_id", "expr_row", "gene", "value")


def bundle(rows: DataFrame, expression: DataFrame, source: DataFrame, panel: list[str], size: int = manifest.SHARD) -> tuple[DataFrame, DataFrame]:
    """(bundled manifest in the order of the index, shards): image, expression and metadata of each cell in one shard.

    ``rows``: the global manifest with the shard and key of its source; ``source``: the shards that hold the
    images. A cell without its image is an error. Shards are numbered by sample, in the order of the index.
    """
    sha = genes.panel_sha256(panel)
    images = shards.payloads(rows.select("global_idx", "sample_id", "cell_id", "sample_key", "shard_path"), source).withColumnRenamed("payload", "image").drop("shard_path")
    first = rows.groupBy("sample_id").agg(F.min("global_idx").alias("__first"))
    placed = manifest.with_shards(images.join(first, "sample_id").withColumn("__at", F.col("global_idx") - F.col("__first")), "__at", size)
    full = placed.join(expression, "global_idx").withColumns({"global_key": S.padded(F.col("global_idx"), 9), "n_genes": F.lit(len(panel)), "n_nonzero": F.size("indices"), "gene_panel_sha256": F.lit(sha)})
    meta = ("global_idx", "sample_id", "cell_id", "sample_key", "n_genes", "n_nonzero", "gene_panel_sha256")
    built = shards.build_shards(full, key="global_key", index="global_idx", meta=meta)
    listed = full.select("global_idx", "sample_id", "cell_id", "sample_key", "global_key", F.concat_ws("/", "sample_id", "shard_path").alias("shard_path"))
    return listed.orderBy("global_idx"), built


def write_bundled(rows: DataFrame, expression: DataFrame, source: DataFrame, panel: list[str], folder: str, size: int = manifest.SHARD) -> dict:
    """Write a bundled dataset's shards and manifest; the number of shards and their bytes."""
    listed, built = bundle(rows, expression, source, panel, size)
    written = shards.write_shards(built, folder)
    listed.write.mode("overwrite").parquet(f"{folder}/bundled_manifest.parquet")
    tars = written.filter("path LIKE '%.tar'").agg(F.count("*").alias("n"), F.sum("bytes").alias("b")).first()
    return {"n_shards": tars["n"], "bytes": tars["b"] or 0}


def write_compiled(rows: DataFrame, expression: DataFrame, panel: list[str], folder: str, *, policy: str, began: float | None = None, source: DataFrame | None = None, shard_size: int = manifest.SHARD) -> dict:
    """Manifest, expression, panel with hash, bundled shards where ``source`` has the images, and the report.

    ``began``: ``time.perf_counter()`` when the work began, from which the report tells the seconds.
    """
    began = time.perf_counter() if began is None else began
    files.write_dataset(rows, expression, folder)
    genes.write_panel(folder, panel)
    more = write_bundled(rows, expression, source, panel, folder, shard_size) if source is not None else {}
    spark = rows.sparkSession
    written = files.read_manifest(spark, f"{folder}/manifest.parquet")
    samples = [r[0] for r in written.select("sample_id").distinct().orderBy("sample_id").collect()]
    report = reports.compile_report(policy=policy, samples=samples, n_cells=written.count(), panel=panel, sha=genes.panel_sha256(panel), output=folder, elapsed_s=round(time.perf_counter() - began, 3), **more)
    reports.write_compile_report(report, folder)
    return report


def compile_folder(spark: SparkSession, folder: str, output: str, *, samples: list[str] | None = None, policy: str = "first_sample", explicit: list[str] | None = None, panels: dict[str, list[str]] | None = None, source: DataFrame | None = None) -> dict:
    """Compile what ``extract_all`` wrote: all samples under a folder, or some of them.

    ``panels``: the genes of each sample, if not in its genes.json.
    """
    began = time.perf_counter()
    names = filters.pick_samples(catalog.discover_samples(spark, folder, skip=("compiled",)), samples)
    lists = {s: (panels or {}).get(s) or store.read_json(f"{folder}/{s}/genes.json") for s in names}
    # One scan of all samples' files: a union of as many plans would cost more than the rows.
    scan = lambda name: spark.read.option("mergeSchema", "true").parquet(*(f"{folder}/{s}/{name}.parquet" for s in names))
    manifests = [scan("manifest")]
    listed = spark.createDataFrame([(s, k, g, i) for k, s in enumerate(names) for i, g in enumerate(lists[s])], "sample_id string, sample int, gene string, pos bigint")
    entries = named_entries(scan("expression"), listed.select("sample_id", F.col("pos").alias("idx"), "gene"))
    rows, expression, panel = compile_dataset(manifests, entries, listed, policy=policy, explicit=explicit)
    return write_compiled(cut(rows), expression, panel, output, policy=policy, began=began, source=source)


def load_dataset(spark: SparkSession, folder: str, samples: list[str] | None = None, n_genes: int | None = None, dense: bool = True) -> DataFrame:
    """Manifest rows with their expression, dense or sparse; the sample filter prunes partitions before anything is joined."""
    rows = files.read_manifest(spark, f"{folder}/manifest.parquet", samples)
    out = manifest.with_expression(rows, spark.read.parquet(f"{folder}/expression.parquet"))
    n = len(genes.read_panel(f"{folder}/gene_panel.json")) if n_genes is None else n_genes
    if dense:
        return out.withColumn("expression", sparse.decode(F.col("indices"), F.col("values"), n)).drop("indices", "values")
    return out.withColumn("n_genes", F.lit(n))


def copy_shards(names: DataFrame, source: DataFrame | str, folder: str) -> int:
    """Copy shards under their new names to folder/shards; how many. One that the source lacks is an error, before any is copied.

    ``names``: (__key, new_path); ``source``: the folder of the samples' shards, whose files the tasks copy, or
    shards as rows (sample_id, shard_path, content, cidx).
    """
    spark = names.sparkSession
    if isinstance(source, str):
        # The listing alone is read: no content.
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", "true").load(source)
        there = found.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("__key"), F.col("path").alias("source"))
    else:
        there = source.withColumn("__key", shards.shard_key()).drop("sample_id", "shard_path")
    if lost := [r[0] for r in names.join(there.select("__key"), "__key", "left_anti").orderBy("__key").limit(3).collect()]:
        raise KeyError(f"the source lacks shards, such as {lost}")
    flat = there.join(small(names), "__key").select("*", F.col("new_path").alias("shard_path"), F.lit("shards").alias("sample_id")).drop("__key", "new_path")
    return shards.write_shards(flat, folder).filter("path LIKE '%.tar'").count()


def package(rows: DataFrame, panel: list[str], folder: str, *, task: str, membership: DataFrame | None = None, defer_split: bool = False, source: DataFrame | str | None = None, reuse: str | None = None) -> dict:
    """A task-ready dataset: remapped shards, split files, configurations, card and validation.

    ``source``: the shards, as rows or as the folder that holds them, which are copied under their new flat
    names; ``reuse``: a compiled folder whose shards and paths are pointed to instead.
    """
    if membership is None and not defer_split:
        raise ValueError("a package needs a split, or a deferred one")
    data = f"{reuse}/*/shard-*.tar" if reuse else f"{folder}/shards/*.tar"
    n_shards = rows.select(shards.shard_key()).distinct().count()
    if source is not None and not reuse:
        names = manifest.remap_shards(rows.select("sample_id", "shard_path").distinct()).select(shards.shard_key().alias("__key"), "new_path").distinct()
        copied = copy_shards(names, source, folder)
        if copied != n_shards:
            raise RuntimeError(f"{copied} of {n_shards} shards were copied")
    remapped = rows if reuse else manifest.remap_shards(rows).withColumnsRenamed({"shard_path": "source_shard_path", "new_path": "shard_path"})
    remapped.write.mode("overwrite").parquet(f"{folder}/manifest.parquet")
    genes.write_panel(folder, panel)
    status, split_path, level, warned, problem = "split_pending", None, "missing", [], None
    if membership is not None:
        try:
            warned = splits.validate(membership, rows)
            split_path = splits.write_split(membership, folder, task)["membership"]
            level, status = membership.select("generated_at_level").first()[0], "training_ready"
        except ValueError as e:  # the package says what is wrong, and can't be loaded
            status, problem = "validation_failed", str(e)
    sha = genes.panel_sha256(panel)
    _write_configs(folder, task, status, data, sha, len(panel), split_path, level)
    card = {"task": task, "training_ready_status": status, "n_cells": rows.count(), "n_genes": len(panel), "gene_panel_sha256": sha, "n_shards": n_shards, "shard_glob": data}
    store.write_json(f"{folder}/dataset_card.json", card)
    store.write_json(f"{folder}/validation_report.json", {"status": status, "warnings": warned, "problem": problem})
    return card


def _write_configs(folder: str, task: str, status: str, data: str, sha: str, n_genes: int, split_path: str | None, level: str) -> None:
    panel = f"{folder}/gene_panel.json"
    files.write_loader_config(f"{folder}/loader_config.yaml", task=task, status=status, manifest_path=f"{folder}/manifest.parquet", shard_glob=data, gene_panel_path=panel, gene_panel_sha256=sha, split_path=split_path, level=level)
    files.write_task_config(f"{folder}/task_config.yaml", task=task, n_genes=n_genes, gene_panel_path=panel, gene_panel_sha256=sha)


def make_split(rows: DataFrame, folder: str, *, task: str, policy: str, **args) -> dict:
    """A split for a packaged dataset: metadata alone, and the configuration and card follow."""
    card = store.read_json(f"{folder}/dataset_card.json")
    membership = splits.split_membership(rows, policy, task, **args)
    splits.validate(membership, rows)
    paths = splits.write_split(membership, folder, task)
    card["training_ready_status"] = "training_ready"
    level = membership.select("generated_at_level").first()[0]
    _write_configs(folder, task, "training_ready", card["shard_glob"], card["gene_panel_sha256"], card["n_genes"], paths["membership"], level)
    store.write_json(f"{folder}/dataset_card.json", card)
    return card


def load_split(spark: SparkSession, folder: str, split: str) -> DataFrame:
    """The rows of one split of a package, as its loader configuration says; another state than ready is an error."""
    config = files.read_config(f"{folder}/loader_config.yaml")
    if config["training_ready_status"] != "training_ready" or config["split"]["status"] != "available":
        raise RuntimeError(f"the dataset is {config['training_ready_status']}, its split {config['split']['status']}")
    rows, members = spark.read.parquet(config["storage"]["manifest_path"]), spark.read.parquet(config["split"]["split_membership_path"])
    return splits.split_rows(rows, members, split, config["split"]["index_column"])


def row_at(dataset: DataFrame, index: int, key: str = "global_idx") -> dict:
    """One cell of a dataset by its index, as a loader's item; the filter reaches the scan."""
    got = dataset.filter(F.col(key) == index).take(1)
    if not got:
        raise IndexError(f"no cell has {key} {index}")
    return got[0].asDict()


def freeze(folder: str, spark: SparkSession) -> dict:
    """What a frozen release is told by: hashes of manifest, membership and panel, none of which depends on the order of rows."""
    table = lambda name: spark.read.parquet(f"{folder}/{name}")
    rows, members = table("manifest.parquet"), table("split_membership.parquet")
    digest = lambda d: metrics.table_digest(d, *sorted(d.columns)).first()["digest"]
    out = {"manifest_sha256": digest(rows), "split_sha256": digest(members), "gene_panel_sha256": genes.panel_sha256(genes.read_panel(f"{folder}/gene_panel.json")), "n_cells": rows.count()}
    store.write_json(f"{folder}/freeze.json", out)
    return out


def profile(built: DataFrame, repeat: int = 1) -> dict:
    """How fast shards are read: cells and bytes a second, over the members of all of them."""
    best = None
    for _ in range(repeat):
        began = time.perf_counter()
        row = shards.members(built).agg(F.countDistinct("sample_id", "shard_path", "key").alias("cells"), F.sum(F.length("payload")).alias("bytes")).first()
        took = time.perf_counter() - began
        best = took if best is None else min(best, took)
    n = built.count()
    return {"cells": row["cells"], "bytes": row["bytes"], "shards": n, "seconds": best, "cells_per_s": row["cells"] / best, "shards_per_s": n / best}


def export_split(rows: DataFrame, membership: DataFrame, folder: str) -> None:
    """A physical copy by split, for consumers that can't filter; only on request."""
    rows.join(membership.select("global_idx", "split"), "global_idx").write.mode("overwrite").partitionBy("split").parquet(folder)
