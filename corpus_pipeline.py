"""The corpus pipeline: stages over documents, each calling one operator of periodgrid.llm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from periodgrid.llm.common import counted_side, free_name, stored, table
from periodgrid.llm.decontaminate import decontaminated
from periodgrid.llm.packing import packed_documents
from periodgrid.llm.secrets import without_secrets
from periodgrid.llm.toxicity import score_toxicity
from periodgrid.llm.vertical_join import jaccard_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose toxicity reaches the threshold of their language go."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("not rejected").select(*COLUMNS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each near-duplicate group stays, the one with the smallest doc_id.

    Rows are told by doc_id and text, so a repeated doc_id drops nothing else, rows without one (last
    in their group) are copies like any other, and of equal rows one stays. Texts without words are
    no copies of each other.
    """
    key, k = F.xxhash64(F.coalesce("text", F.lit(""))), free_name(docs, "_key")
    groups = stored(jaccard_components(docs.select(key.alias("doc_id"), "text")).where("n_shingles > 0").select(
        F.col("doc_id").alias(k), "component_id").distinct())
    rows = stored(docs.select("doc_id", key.alias(k)).groupBy("doc_id", k).count().join(groups, k))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", k)
    first = rows.groupBy("component_id").agg(F.min(place).alias("first"))
    placed = stored(rows.join(first, "component_id").select("doc_id", k, "count", (place == F.col("first")).alias("stays")))
    identity = free_name(docs, "_id")
    named = placed.withColumnRenamed("doc_id", identity)

    def listed(condition: str) -> tuple[DataFrame, Column]:
        side = counted_side(named.where(condition).select(identity, F.col(k).alias(f"{k}_of")))
        return side, F.col("doc_id").eqNullSafe(F.col(identity)) & (key == F.col(f"{k}_of"))

    kept = docs.join(*listed("not stays"), "left_anti")
    twice = "stays and count > 1"
    if not placed.where(twice).isEmpty():
        once = kept.join(*listed(twice), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(*listed(twice), "left_anti").unionByName(once)
    return kept.select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a region of a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: secrets are replaced in the text; n_chars follows the text. No document goes."""
    return without_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: what is left as token pieces in sequences."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", civil),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", masked_secrets),
    ("packing", packed),
]
#: A trained classifier, an edit distance and a tokenizer are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
