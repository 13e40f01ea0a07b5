"""A training-data pipeline over ``documents``: each stage works on what the one before it kept.

Language identification drops documents in no known language; near-duplicate detection keeps one document
of each group; decontamination drops documents that hold a benchmark item; the secret scan replaces secrets
in the text; packing lays the rest out in sequences. Stages are written as Parquet and read again.

Rows are dropped by their id: rows that share one (or have none) go together, if none of them may stay;
of equal rows that stay, near-duplicate detection keeps one. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import langid, minhash, packing, secrets, tiling
from emberlake.llm.common import drop_ids, materialize, read_table, small_batches


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    small_batches(spark)  # holds for the stages behind this one too
    return drop_ids(docs, langid.identify(docs), "accepted")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near duplicates."""
    found = materialize(minhash.near_duplicates(docs).select("doc_id", "kept"))
    kept = drop_ids(docs, found, "kept")
    repeated = materialize(found.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(False).alias("single")))
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated.select(F.col("doc_id").alias("_again")), F.col("doc_id").eqNullSafe(F.col("_again")), "left_semi")
    return drop_ids(kept, repeated, "single").unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    found = tiling.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return drop_ids(docs, found.select("doc_id", (~F.col("contaminated")).alias("clean")), "clean")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    masked = secrets.redact(docs, secrets.scan(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences."""
    return packing.pack(materialize(packing.tokenize_pieces(docs, with_ids=False)))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL cannot express the models of the stages; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
