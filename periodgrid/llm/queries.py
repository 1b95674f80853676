"""The registered queries of the operators, each over its whole table, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table
from .decontaminate import contamination
from .divergence import DIVERGENCE_SQL, op12_source_divergence
from .licences import scan_licences
from .lm_difference import score_documents
from .packing import packed_documents
from .polarisation import op11_embedding_whitening
from .quotes import link_quotes
from .sanitise import find_personal_data
from .secrets import find_secrets
from .subspace import near_duplicates
from .suffixes import op13_suffix_dedup
from .toxicity import PREDICT_AT, fold, score_toxicity
from .vertical_join import jaccard_components

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold() == 1).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"), "threshold", "rejected")


@query
def op3_loss_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


@query
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("detections")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


query(op11_embedding_whitening)
query(op12_source_divergence)
query(op13_suffix_dedup)


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SHINGLES_SQL = f"""
worded AS (
  SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * i >= 80 * (p.n + q.n - i)
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT e.t, r.root FROM reach r JOIN (SELECT a AS s, b AS t FROM links UNION ALL SELECT b, a FROM links) e ON e.s = r.doc_id
), groups AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)"""

SQL["op10_ngram_jaccard"] = f"""
WITH RECURSIVE {SHINGLES_SQL}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN groups c USING (doc_id)
"""

SQL["op8_subspace_join"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS s, b.vec_id AS t FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT l.t, r.root FROM reach r JOIN links l ON l.s = r.vec_id
), groups AS (
  SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id
), degrees AS (
  SELECT s AS vec_id, count(*) AS n_links FROM links GROUP BY s
)
SELECT e.vec_id, coalesce(d.n_links, 0) AS n_links, g.component_id, e.vec_id = g.component_id AS kept
FROM embeddings e LEFT JOIN degrees d USING (vec_id) JOIN groups g USING (vec_id)
"""

SQL["op12_source_divergence"] = DIVERGENCE_SQL
