"""The domain's tables as views over the driver's tables: one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import read_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "cells_v": "SELECT CAST(p_partkey AS STRING) AS cell_id, p_partkey AS pos, CAST((p_size - 3) * 22 AS DOUBLE) AS x_px, (p_retailprice - 905) * 11 AS y_px FROM part",
    "nucleus_ids_v": "SELECT DISTINCT CAST(l_partkey AS STRING) AS shape_id FROM lineitem WHERE l_suppkey % 8 = 0 AND l_returnflag = 'R'",
    "tissue_v": "SELECT s_suppkey AS poly_id, CAST((s_suppkey % 4) * 300 AS DOUBLE) AS x0, CAST((s_suppkey % 3) * 400 AS DOUBLE) AS y0, CAST((s_suppkey % 4) * 300 + 200 AS DOUBLE) AS x1, CAST((s_suppkey % 3) * 400 + 250 AS DOUBLE) AS y1 FROM supplier WHERE s_suppkey <= 5",
    "xen_v": "SELECT CAST(p_partkey AS STRING) AS cell_id, CAST(p_size * 20 AS DOUBLE) AS x0, CAST((p_partkey % 50) * 20 AS DOUBLE) AS y0, CAST(p_size * 20 + 10 AS DOUBLE) AS x1, CAST((p_partkey % 50) * 20 + 10 AS DOUBLE) AS y1 FROM part",
    "he_v": "SELECT c_custkey AS he_id, CAST((c_custkey % 50 + 1) * 20 + c_custkey % 7 AS DOUBLE) AS x0, CAST((c_custkey % 47) * 20 + c_custkey % 3 AS DOUBLE) AS y0, CAST((c_custkey % 50 + 1) * 20 + c_custkey % 7 + 10 AS DOUBLE) AS x1, CAST((c_custkey % 47) * 20 + c_custkey % 3 + 10 AS DOUBLE) AS y1 FROM customer",
    "manifest_v": "SELECT CAST(row_number() OVER (ORDER BY source, doc_id) AS BIGINT) - 1 AS global_idx, source AS sample_id, CAST(doc_id AS STRING) AS cell_id, lang AS grp FROM documents",
    "genes_v": "SELECT CAST(l_suppkey % 8 AS INT) AS sample, CONCAT('G', CAST(l_partkey AS STRING)) AS gene, MIN(l_orderkey) AS first_pos FROM lineitem GROUP BY 1, 2",
    "embedded_v": "SELECT vec_id AS global_idx, embedding, label FROM embeddings",
}
#: The shapes of all suppliers: many in one place.
VIEWS["tissues_v"] = VIEWS["tissue_v"].removesuffix(" WHERE s_suppkey <= 5")
#: Boxes that touch along seams and at corners; some are wider and overlap the next, some have a hole.
VIEWS["seams_v"] = "SELECT s_suppkey AS poly_id, CAST((s_suppkey % 13) * 100 AS DOUBLE) AS x0, CAST((s_suppkey * 5 % 11) * 60 AS DOUBLE) AS y0, CAST((s_suppkey % 13) * 100 + CASE WHEN s_suppkey % 5 = 0 THEN 140 ELSE 100 END AS DOUBLE) AS x1, CAST((s_suppkey * 5 % 11) * 60 + 60 AS DOUBLE) AS y1, s_suppkey % 4 = 0 AS hole FROM supplier"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    text = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\bFROM {t}\b", text)]
    for t in used:
        text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
    return spark.sql(text, **{t: read_table(spark, sf_dir, t) for t in used})


def oracle(body: str, *names: str) -> str:
    """A DuckDB query over views."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + ("\n" if names else "") + body if names else body
