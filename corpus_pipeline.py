"""The corpus pipeline: quality, line dedup, near dedup, mixing and tokens, in this order.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of the documents. A caller may write each stage's result and read it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.llm import bpe, lines, mixing, quality, simhash
from spotloom.llm.common import held_out
from spotloom.session import cut, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null text is scored as the empty text; null ids and repeated rows are scored like others; without
    labels all score 0.5 and stay; other columns are kept; an empty table stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    forest = quality.fit(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    return quality.filter_quality(docs, forest)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; ``n_chars``, if there is one, follows the text.

    Null texts stay null and keep their ``n_chars``; a document that loses all lines stays, empty; rows
    that repeat id and text lose nothing to each other; other columns are kept; an empty table stays empty.
    """
    out = lines.dedup_lines(docs, counts=())
    if "n_chars" not in docs.columns:
        return out
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), size).otherwise(F.col("n_chars")))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8.

    The smallest id of a group stays; null, empty and blank texts are copies of each other; rows that repeat
    the id that stays all stay; rows without an id stay only in groups without any id; an empty table stays empty.
    """
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the balanced sample takes it, which may be never or twice.

    A null source is a source of its own; texts without words take no words; rows that repeat id, source and
    text share one decision; other columns are kept; an empty table stays empty.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of the mix.

    A null text is the empty text; null ids and repeated rows give a row each; other columns are ignored.
    """
    return bpe.digests(bpe.transcode(docs, *bpe.bundled()))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokens),
]

#: The trees, the cube method and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))  # a stage reads its input several times
    return STAGES[-1][1](spark, docs, sf_dir)
