"""An extension: per-sample manifests as a stream, counted by sample as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def manifest_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """New manifest files under a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(folder)


def cells_by_sample(stream: DataFrame) -> DataFrame:
    """Running counts of cells and shards."""
    return stream.groupBy("sample_id").agg(F.count("*").alias("n_cells"), F.approx_count_distinct("shard_path").alias("n_shards"))


def deduplicated(stream: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Each cell once, with state kept for as long as late files may come."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["sample_id", "cell_id"])


def windowed_counts(stream: DataFrame, event_time: str, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Cells landed by window and sample."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), "sample_id").agg(F.count("*").alias("n_cells"))


def append_to(stream: DataFrame, folder: str, checkpoint: str):
    """Land what has arrived and stop; restarts go on where the checkpoint says."""
    return stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
