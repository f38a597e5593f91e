"""Session defaults and the few session-level helpers every module shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that only matter when this library starts the session itself.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # what cut() wrote goes when nothing refers to it
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "6g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("spotloom")
    for k, v in {**DEFAULTS, "spark.driver.memory": memory, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; the path may be in any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows up to which a table of counts is held by the driver and broadcast: some megabytes.
SMALL = 100_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """A table to be joined to a large one: if it has few rows, a copy of them that is broadcast; else itself."""
    got = df.limit(rows + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(got, df.schema)) if len(got) <= rows else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the
    master is local (tests), a temporary folder is used; a cluster without it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), "spotloom-checkpoints"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; later reads survive lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt anew if it has fewer partitions than there are cores: for few rows with much work each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
