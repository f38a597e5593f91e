"""Queries of the corpus operators and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, spread
from .audit import audit
from .bpe import bundled, digests, transcode
from .exact_dedup import exact_dedup
from .image_roots import roots
from .images import classes_by, textures
from .lines import dedup_lines
from .mixing import mixture
from .pii import replace as replace_pii
from .quality import quality_scores
from .rules import quality_rules
from .secret_scan import dictionary, scan, train
from .simhash import hexed, simhash_components
from .toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with SQL where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query("op1_source_mixing")
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read_table(spark, sf_dir, "documents"))


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexed().alias("fingerprint"), "component_id")


@query(
    "op3_line_dedup",
    r"""
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
         o AS (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS ln FROM l),
         c AS (SELECT doc_id, ln, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > 50 AS long FROM o),
         u AS (SELECT doc_id, ln, long, CASE WHEN long THEN regexp_extract_all(line, '(?s).*?[.!?] |.+') ELSE [line] END AS a FROM c),
         v AS (SELECT doc_id, ln, long, unnest(a) AS piece, unnest(range(len(a))) AS k FROM u),
         p AS (SELECT doc_id, ln, piece, CASE WHEN long THEN rtrim(piece, ' ') ELSE piece END AS line,
                      row_number() OVER (PARTITION BY doc_id ORDER BY ln, k) - 1 AS pos, count(*) OVER (PARTITION BY doc_id) AS n FROM v),
         w AS (SELECT doc_id, pos, n, line AS x, lead(line) OVER o AS y, lead(line, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
         f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, pos) AS k FROM w WHERE pos + 3 <= n AND trim(x || y || z, ' ') <> ''),
         g AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM f WHERE k > 1),
         k AS (SELECT p.*, g.pos IS NOT NULL AS gone FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.pos = g.pos),
         s AS (SELECT doc_id, pos, CASE WHEN lag(ln) OVER (PARTITION BY doc_id ORDER BY pos) <> ln THEN chr(10) ELSE '' END || piece AS x FROM k WHERE NOT gone),
         r AS (SELECT n.doc_id, n_lines, n_removed, coalesce(text, '') AS text
               FROM (SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_removed FROM k GROUP BY doc_id) n
               LEFT JOIN (SELECT doc_id, string_agg(x, '' ORDER BY pos) AS text FROM s GROUP BY doc_id) t USING (doc_id))
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(r.text) AS text_sha256
    FROM documents d LEFT JOIN r USING (doc_id)
    """,
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.sha2("text", 256).alias("text_sha256"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(transcode(read_table(spark, sf_dir, "documents"), *bundled()))


@query("op5_image_copies")
def op5_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No table holds images: every vector of ``embeddings`` is drawn as one; no link within the radius is left out."""
    drawn = textures(spread(read_table(spark, sf_dir, "embeddings")), "vec_id", "embedding")
    out = classes_by(drawn, "id", "media", roots)
    return out.select(F.col("id").alias("vec_id"), F.col("content").alias("media_sha256"), "class_id")


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    known = dictionary(docs)
    return scan(docs, train(known=known), known=known)


#: A key for the tests' tables; a job passes its own secret.
PII_KEY = "public-test-key"


@query("op8_pii_surrogates")
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_pii(read_table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", F.col("__entities").alias("n_entities"), F.col("__kinds").alias("kinds"), "text")


@query(
    "op9_exact_dedup",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
         g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN g USING (x)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query(
    "op11_quality_rules",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
         w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                      [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
         p AS (SELECT doc_id, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
         y AS (SELECT doc_id, i, x AS a, lead(x) OVER o AS b, lead(x, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
         z AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM y WHERE c IS NOT NULL),
         r AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM z WHERE k > 1) GROUP BY doc_id),
         s AS (SELECT doc_id, t, ws, ls, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                      len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
         b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND 100 * n_symbols <= 10 * n_words AND 100 * n_dup_lines <= 40 * len(ls)
           AND 100 * len([x FOR x IN ls IF regexp_matches(x, '^[ \t]*[-*•‣●]')]) <= 90 * len(ls)
           AND 100 * len([x FOR x IN ls IF regexp_matches(x, '(?:\.\.\.|…)[ \t\r]*\z')]) <= 30 * len(ls)
           AND 100 * len(regexp_replace(t, '[^!]+', '', 'g')) <= 50 * n_words AND 100 * len(regexp_replace(t, '[^0-9]+', '', 'g')) <= 30 * word_chars
           AND 100 * len(regexp_replace(t, '\P{Lu}+', '', 'g')) <= 30 * word_chars
           AND 100 * len([x FOR x IN ws IF NOT regexp_matches(x, '\p{L}')]) <= 25 * n_words AS kept
    FROM b
    """,
)
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


@query(
    "op12_filter_audit",
    r"""
    WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x FROM labels GROUP BY doc_id),
         d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
         o AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
         m AS (SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
                      (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                      + 4 * (100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * len(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
                      + 16 * coalesce(d.doc_id > least, false)::INT AS f
               FROM d JOIN o USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
         c AS (SELECT part, q, x, f, count(*) AS n FROM m GROUP BY ALL),
         k AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
         p AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
               FROM k a, k b, k c, k d, k e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
         s AS (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM p),
         e AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS done FROM s),
         g AS (SELECT part, filter_order, step, own, CAST(sum(CASE WHEN f & own = 0 AND f & done = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
                      CAST(sum(CASE WHEN f & own <> 0 AND f & done = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
                      CAST(sum(CASE WHEN f & own <> 0 AND f & done <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
                      CAST(sum(CASE WHEN f = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                      CAST(sum(CASE WHEN f & own <> 0 AND f & done = 0 AND q = 1 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
                      CAST(sum(CASE WHEN f & own <> 0 AND f & done = 0 AND x = 1 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
               FROM c, e GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM g
    """,
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
