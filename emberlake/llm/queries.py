"""The registered queries of the corpus operators: thin calls over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm import (
    alignment,
    bytebpe,
    htmltext,
    langid,
    minhash,
    packing,
    ppm,
    quality,
    secrets,
    spotsigs,
    tiling,
    urlrules,
    whitening,
)
from emberlake.llm.common import crc_mod, materialize, read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = materialize(packing.tokenize_pieces(read_table(spark, sf_dir, "documents"), with_ids=False))
    return packing.pack(pieces)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate's places, judged; the value by its digest."""
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.explode("starts").alias("start"),
        F.length("value").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        "probability",
        "secret",
    )


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_neighbours(read_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"), where=~held_out)
    return quality.score(docs, weights).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.train(pages), keep=["page_id", "url"])


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "mined")


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))
    scored = ppm.score(docs, docs.filter(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every text, with links rated by the whole table's counts; group texts by their digest."""
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
    aligned = alignment.align(read_table(spark, sf_dir, "documents")).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        *counts,
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
        "pairs",
    )
    aligned = materialize(aligned)  # which fixes the row numbers
    rated = alignment.rate(aligned, "row")
    return aligned.join(rated, "row", "left").select(
        F.col("doc_id").cast("long"),
        *counts,
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")),
        "groups_sha256",
    )


def op13_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(bytebpe.encode(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_secrets": op2_secrets,
    "op3_spotsigs": op3_spotsigs,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_html": op7_html,
    "op8_url_rules": op8_url_rules,
    "op9_ppm": op9_ppm,
    "op10_minhash": op10_minhash,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_bytebpe": op13_bytebpe,
}

_MINHASH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(w), 2)), lambda i: CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END)) AS s
    FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT a, b FROM edges
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
), least AS (
  SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(l.other, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

#: DuckDB SQL of the queries that SQL can express: the links of all pairs, without sketches or bands.
ORACLES: dict[str, str] = {"op10_minhash": _MINHASH_SQL}
