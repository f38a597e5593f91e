"""The jobs as queries: each is run twice into a new folder, and what stands there then is the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotloom.session import checkpoint_dir

from . import corpus_manifest, panel_expression

MANIFEST = """
    WITH d AS (SELECT coalesce(source, '') AS sample_id, doc_id AS pos, sha256(coalesce(text, '')) AS group_id,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_words FROM documents WHERE doc_id IS NOT NULL),
         f AS (SELECT *, row_number() OVER (PARTITION BY sample_id, pos ORDER BY group_id) AS k FROM d WHERE n_words >= 1),
         n AS (SELECT *, row_number() OVER (ORDER BY sample_id, pos) - 1 AS global_idx, row_number() OVER (PARTITION BY sample_id ORDER BY pos) - 1 AS sample_index,
                      CAST('0x' || substr(md5('42:' || group_id), 1, 8) AS BIGINT) AS h FROM f WHERE k = 1)
    SELECT global_idx, printf('%09d', global_idx) AS global_key, sample_id, CAST(pos AS VARCHAR) AS cell_id, sample_index, printf('%07d', sample_index) AS sample_key,
           sample_id || '/shard-' || printf('%06d', sample_index // 500) || '.tar' AS shard_path, group_id, n_words, 'corpus' AS task, 'hash_by_group' AS split_policy, CAST(42 AS INTEGER) AS seed,
           CASE WHEN h < 3435973836 THEN 'train' WHEN h < 3865470566 THEN 'val' ELSE 'test' END AS split, CAST(0 AS INTEGER) AS batch_id
    FROM n
"""
EXPRESSION = """
    WITH e AS (SELECT l_returnflag AS sample_id, CAST(l_orderkey AS VARCHAR) AS cell_id, 'G' || CAST(l_partkey AS VARCHAR) AS gene, sum(CAST(l_quantity AS DOUBLE)) AS value FROM lineitem GROUP BY 1, 2, 3),
         c AS (SELECT gene FROM e GROUP BY gene HAVING count(DISTINCT sample_id) = (SELECT count(DISTINCT sample_id) FROM e)),
         p AS (SELECT gene, row_number() OVER (ORDER BY gene) - 1 AS i FROM c)
    SELECT sample_id, cell_id, count(*) AS n_nonzero, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS indices, string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS values
    FROM e JOIN p USING (gene) GROUP BY 1, 2
"""


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/jobs/{name}-{uuid.uuid4().hex}"


def job1_corpus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run finds no new file."""
    out = folder(spark, "corpus_manifest")
    for _ in range(2):
        corpus_manifest.run(spark, f"{sf_dir}/documents.parquet", out, f"{out}/checkpoint")
    return corpus_manifest.read(spark, out)


def job2_panel_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run replaces every partition."""
    out = folder(spark, "panel_expression")
    given = {"sample": "l_returnflag", "cell": "l_orderkey", "gene": "l_partkey", "value": "l_quantity", "prefix": "G"}
    for _ in range(2):
        panel_expression.run(spark, f"{sf_dir}/lineitem.parquet", out, given)
    listed = lambda c, kind: F.array_join(F.col(c).cast(f"array<{kind}>").cast("array<string>"), ",").alias(c)
    return panel_expression.read(spark, out).select("sample_id", "cell_id", "n_nonzero", listed("indices", "int"), listed("values", "bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_corpus_manifest, job2_panel_expression)}
ORACLES: dict[str, str] = {"job1_corpus_manifest": MANIFEST, "job2_panel_expression": EXPRESSION}
