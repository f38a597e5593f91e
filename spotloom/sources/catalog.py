"""Samples as namespaces of parquet elements: {root}/{sample}/{tables|shapes|images}/{key}.parquet.

Listing goes through Hadoop's file system API, so that any store works that Spark reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

KINDS = ("tables", "shapes", "images")
CATALOG = "kind string, key string, n_rows bigint, n_cols bigint, height bigint, width bigint, n_levels bigint"


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a directory; none if it doesn't exist."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def discover_samples(spark: SparkSession, root: str, needs: tuple[str, ...] = ("manifest.parquet", "expression.parquet"), skip: tuple[str, ...] = ()) -> list[str]:
    """Sorted sub-directories that have all the needed entries; none is an error."""
    found = [s for s in list_dir(spark, root) if s not in skip and set(needs) <= set(list_dir(spark, f"{root}/{s}"))]
    if not found:
        raise ValueError(f"no samples with {', '.join(needs)} under {root}")
    return found


def find_samples(spark: SparkSession, pattern: str, allowed: list[str] | None = None) -> list[str]:
    """Sorted paths of samples that match a pattern, perhaps of some names only; none is an error."""
    found = [p for p in store.glob(pattern) if allowed is None or sample_name(p) in allowed]
    if not found:
        raise ValueError(f"no samples match {pattern!r}" + (f" and {allowed}" if allowed else ""))
    return found


def sample_name(path: str) -> str:
    """The last part of a path without its suffix."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return last.rsplit(".", 1)[0] if "." in last[1:] else last


def partition_name(column: str, value: str) -> str:
    """The folder of a partition, as Spark names it."""
    spark = SparkSession.getActiveSession()
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def elements(spark: SparkSession, root: str, samples: list[str], kind: str, key: str) -> DataFrame:
    """One element of many samples, with their ``sample_id``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [element(spark, root, s, kind, key) for s in samples])


def element(spark: SparkSession, root: str, sample: str, kind: str, key: str) -> DataFrame:
    """One element of a sample; an unknown key is an error that lists the known ones."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    known = [k.removesuffix(".parquet") for k in list_dir(spark, f"{root}/{sample}/{kind}")]
    if key not in known:
        raise KeyError(f"{kind} key {key!r} not found in {sample}; available: {known}")
    return spark.read.parquet(f"{root}/{sample}/{kind}/{key}.parquet").withColumn("sample_id", F.lit(sample))


def write_element(df: DataFrame, root: str, sample: str, kind: str, key: str) -> str:
    """Write an element under a key, over what was there; every stage overwrites alike."""
    path = f"{root}/{sample}/{kind}/{key}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def genes_of(spark: SparkSession, root: str, sample: str, key: str) -> list[str] | None:
    """The genes of a table, in order, from {root}/{sample}/genes/{key}.parquet (gene, pos); None without such a list.

    A table that a filter stage wrote has the genes of the one that it was made of, by whose name its own begins.
    """
    known = [k.removesuffix(".parquet") for k in list_dir(spark, f"{root}/{sample}/genes")]
    of = max((k for k in known if key == k or key.startswith(k + "_")), key=len, default=None)
    if of is None:
        return None
    return [r["gene"] for r in spark.read.parquet(f"{root}/{sample}/genes/{of}.parquet").orderBy("pos").select("gene").collect()]


def transform_of(spark: SparkSession, root: str, sample: str, kind: str, key: str) -> tuple[float, ...] | None:
    """The six numbers of an element's affine, None without one (the identity is then taken)."""
    if "transforms.parquet" not in list_dir(spark, f"{root}/{sample}"):
        return None
    rows = spark.read.parquet(f"{root}/{sample}/transforms.parquet").filter((F.col("kind") == kind) & (F.col("key") == key)).take(1)
    return tuple(rows[0][c] for c in ("a", "b", "d", "e", "xoff", "yoff")) if rows else None


def describe(elements: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(kind, key, n_rows, n_cols) of elements, counted in one job."""
    parts = [d.agg(F.count("*").alias("n_rows")).select(F.lit(kind).alias("kind"), F.lit(key).alias("key"), "n_rows", F.lit(len(d.columns)).cast("bigint").alias("n_cols")) for (kind, key), d in elements.items()]
    return reduce(DataFrame.unionByName, parts)


def describe_image(image: DataFrame, key: str) -> DataFrame:
    """(kind, key, n_rows, n_cols, height, width, n_levels) of an image's table of levels (level, height, width, ...)."""
    full = F.min_by(F.struct("height", "width"), "level")
    got = image.agg(F.count("*").alias("n_rows"), full.alias("full"), F.countDistinct("level").alias("n_levels"))
    return got.select(F.lit("images").alias("kind"), F.lit(key).alias("key"), "n_rows", F.lit(len(image.columns)).cast("bigint").alias("n_cols"), F.col("full.height").cast("bigint").alias("height"), F.col("full.width").cast("bigint").alias("width"), "n_levels")


def inspect(spark: SparkSession, root: str, sample: str) -> DataFrame:
    """What a sample holds; an element that can't be read has a key alone."""
    parts = []
    for kind in KINDS:
        for name in list_dir(spark, f"{root}/{sample}/{kind}"):
            key = name.removesuffix(".parquet")
            try:
                rows = spark.read.parquet(f"{root}/{sample}/{kind}/{name}")
                sized = kind == "images" and {"level", "height", "width"} <= set(rows.columns)
                parts.append(describe_image(rows, key) if sized else describe({(kind, key): rows}))
            except Exception:  # noqa: BLE001  the listing goes on
                parts.append(spark.createDataFrame([(kind, key) + (None,) * 5], CATALOG))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.createDataFrame([], CATALOG), *parts]) if parts else spark.createDataFrame([], CATALOG)


# Candidate keys for overlays, in the order in which they are tried: fixed values.
TISSUE_KEYS = ("tissue", "tissue_boundaries", "tissue_boundary", "tissue_regions", "tissue_region", "filtered_tissue", "region_of_interest")
CELL_KEYS = ("filtered_cell_boundaries", "cell_boundaries", "filtered_cell_circles", "cell_circles")
NUCLEUS_KEYS = ("filtered_nucleus_boundaries", "nucleus_boundaries")


def resolve_key(known: list[str], candidates: tuple[str, ...], hint: str = "auto") -> str | None:
    """``none`` gives nothing, ``auto`` the first known candidate, a name itself if it is known."""
    wanted = candidates if hint == "auto" else () if hint == "none" else (hint,)
    return next((k for k in wanted if k in known), None)


def new_keys(before: list[str], after: list[str], preferred: str | None = None, required: bool = False) -> str | None:
    """The key that a segmentation added: the preferred one, else the first in order."""
    added = sorted(set(after) - set(before))
    if not added:
        if required:
            raise RuntimeError("the segmentation added no shapes")
        return None
    return preferred if preferred in added else added[0]
