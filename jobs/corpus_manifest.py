"""Job: the global manifest and split of a growing corpus of documents, taken file by file as they land.

A source is a sample and a document a cell. Every run takes the files that earlier runs haven't
seen, which the stream's checkpoint knows, drops what can't be used, and adds the rest to the
manifest: dense indices go on where the manifest ends, so that no index that was given out
ever changes, and the split follows from the text alone, so that copies share a split
whenever they come. Partitions are (split, batch_id), beside a report for each batch and sample.

A batch that failed is run again with the same files and replaces its own partitions, so the result of
a rerun is the same. Nothing of the corpus passes through the driver but counts.

Defined cases: a null source is the sample of the empty name; documents without an id or with fewer words than
``least_words`` are dropped; of rows of one source and id the one whose text has the least digest stays; a
document that the manifest has already is dropped, even if its text is another; other columns are ignored.

    python -m jobs.corpus_manifest --documents /data/documents.parquet --output /out --checkpoint /out/checkpoint --config jobs/corpus_manifest.json
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.functions import scalars as S
from spotloom.operators import manifest, splits
from spotloom.session import cut, small
from spotloom.sources import store
from spotloom.streaming import ingest

from . import command

log = logging.getLogger("jobs.corpus_manifest")
DEFAULTS = {"task": "corpus", "ratios": [0.8, 0.1, 0.1], "seed": 42, "least_words": 1, "shard_size": manifest.SHARD, "files_per_batch": 1000}
WORD = r"[^\x20\x09-\x0D]+"
COLUMNS = ("global_idx", "global_key", "sample_id", "cell_id", "sample_index", "sample_key", "shard_path", "group_id", "n_words", "task", "split_policy", "seed")


def cells(documents: DataFrame) -> DataFrame:
    """(sample_id, pos, group_id, n_words) of the documents: narrow rows, the text is a digest from here on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("sample_id"), F.col("doc_id").cast("bigint").alias("pos"), F.sha2(text, 256).alias("group_id"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"))


def written(spark: SparkSession, output: str, batch_id: int) -> DataFrame | None:
    """The manifest of the batches before this one, if there is any."""
    folder = f"{output}/manifest"
    return spark.read.parquet(folder).filter(F.col("batch_id") < batch_id) if batch_id > 0 and store.exists(folder) else None


def judged(rows: DataFrame, known: DataFrame | None, least_words: int) -> DataFrame:
    """The rows with the reason why they are dropped, null for those that stay."""
    unusable = F.when(F.col("pos").isNull(), "without_id").when(F.col("n_words") < least_words, "too_short")
    told = rows.withColumn("reason", unusable)
    whole = F.col("reason").isNull()
    # Rows of a source and id are one: those beside the one that stays are counted, not carried on.
    firsts = told.filter(whole).groupBy("sample_id", "pos").agg(F.min(F.struct("group_id", "n_words")).alias("x"), F.count("*").alias("n"))
    firsts = firsts.select("sample_id", "pos", "x.group_id", "x.n_words", "n")
    if known is not None:
        had = known.select(F.col("sample_id"), F.col("cell_id").cast("bigint").alias("pos"), F.lit(True).alias("had"))
        firsts = firsts.join(had, ["sample_id", "pos"], "left").withColumn("reason", F.when(F.col("had"), "known")).drop("had")
    else:
        firsts = firsts.withColumn("reason", F.lit(None).cast("string"))
    others = told.filter(~whole).groupBy("sample_id", "reason").agg(F.count("*").alias("n")).select("sample_id", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("group_id"), F.lit(None).cast("bigint").alias("n_words"), "n", "reason")
    return firsts.unionByName(others)


def numbered(new: DataFrame, before: DataFrame | None, size: int) -> DataFrame:
    """Indices of the whole manifest and of each sample, shards and keys; they go on after what is there."""
    total = before.count() if before is not None else 0
    rows = manifest.dense_index(new, "sample_id", "pos", "at")
    starts = rows.groupBy("sample_id").agg(F.min("at").alias("first"))  # a row for each sample
    if before is not None:
        starts = starts.join(before.groupBy("sample_id").agg(F.count("*").alias("had")), "sample_id", "left")
    else:
        starts = starts.withColumn("had", F.lit(0))
    rows = rows.join(small(starts), "sample_id")
    rows = rows.withColumns({"global_idx": F.col("at") + total, "sample_index": F.col("at") - F.col("first") + F.coalesce("had", F.lit(0)), "cell_id": F.col("pos").cast("string")})
    rows = manifest.with_keys(manifest.with_shards(rows, size=size))
    return rows.withColumn("shard_path", F.concat_ws("/", "sample_id", "shard_path"))


def report(told: DataFrame) -> DataFrame:
    """(sample_id, n_in, n_kept, too_short, without_id, repeated, known) of a batch."""
    some = lambda reason: F.sum(F.when(F.col("reason") == reason, F.col("n")).otherwise(0)).cast("bigint").alias(reason)
    stays = F.col("reason").isNull()
    repeated = F.sum(F.when(stays, F.col("n") - 1).otherwise(0)).cast("bigint").alias("repeated")
    return told.groupBy("sample_id").agg(F.sum("n").cast("bigint").alias("n_in"), F.count_if(stays).alias("n_kept"), some("too_short"), some("without_id"), repeated, some("known"))


def take(batch: DataFrame, batch_id: int, output: str, conf: dict) -> dict:
    """Add one batch of documents to the manifest; counts of what was read and written."""
    spark = batch.sparkSession
    before = written(spark, output, batch_id)
    told = cut(judged(cells(batch), before, conf["least_words"]))
    new = told.filter("reason IS NULL").select("sample_id", "pos", "group_id", "n_words")
    rows = numbered(new, before, conf["shard_size"])
    member = splits.hash_by_group(rows, conf["task"], "group_id", tuple(conf["ratios"]), conf["seed"])
    put = lambda d, name, *by: d.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id").parquet(f"{output}/{name}")
    put(member.select(*COLUMNS, "split"), "manifest", "split")
    put(report(told), "report")
    sums = spark.read.parquet(f"{output}/report").filter(F.col("batch_id") == batch_id).agg(F.sum("n_in"), F.sum("n_kept"), F.count("*")).first()
    counts = {"batch": batch_id, "read": sums[0] or 0, "written": sums[1] or 0, "samples": sums[2]}
    log.info("batch %(batch)s: read %(read)s documents of %(samples)s sources, wrote %(written)s", counts)
    return counts


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, config: dict | None = None) -> dict:
    """Take all files of documents that are new since the last run into the manifest under the output folder."""
    conf = command.settings(DEFAULTS, config)
    done: list[dict] = []
    stream = ingest.manifest_stream(spark, documents, spark.read.parquet(documents).schema, conf["files_per_batch"])
    query = stream.writeStream.foreachBatch(lambda batch, k: done.append(take(batch, int(k), output, conf))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    told = {"batches": len(done), "read": sum(d["read"] for d in done), "written": sum(d["written"] for d in done)}
    log.info("read %s documents of %s, wrote %s to %s", told["read"], documents, told["written"], output)
    return told


def read(spark: SparkSession, output: str) -> DataFrame:
    """The manifest as it stands."""
    return spark.read.parquet(f"{output}/manifest").withColumn("sample_id", F.col("sample_id").cast("string"))


if __name__ == "__main__":
    command.main("corpus_manifest", run, "documents", "output", "checkpoint")
