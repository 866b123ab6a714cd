"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import centroids, contamination, fingerprints, hard_negatives, language, lines, mixing, neardup, neighbours, pages, quality, recompression, suffixes


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Documents name a language and a source; the source stands for the host."""
    out = language.identify(table(spark, folder, "documents"), declared=F.col("lang"), host=F.col("source"))
    return out.select("doc_id", "language", F.round("probability", 6).alias("probability"), "text_language", "accepted")


def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages declare a language in their markup and have an address."""
    rows = table(spark, folder, "pages").withColumn("host", F.lower(F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1)))
    out = language.identify(
        rows.withColumn("text", F.regexp_replace("html", "(?is)<(script|style)[^>]*>.*?</\\1>|<[^>]*>|&[a-z]+;", " ")), id_col="page_id",
        declared=F.regexp_extract("html", "(?i)<html[^>]*\\slang=[\"']?([A-Za-z-]+)", 1), host=F.col("host"),
        domain=F.regexp_extract("host", "([^.]+\\.[^.]+)$", 1), suffix=F.regexp_extract("host", "([^.]+)$", 1),
    )
    return out.select("page_id", "language", F.round("probability", 6).alias("probability"), "text_language", "declared", "accepted")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.drop_repeated_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, folder, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "n_links")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents")).withColumn("weight", F.round("weight", 9))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.remove_repeated_bytes(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    out = pages.extract(table(spark, folder, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))[0]


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = recompression.remove_repeated_words(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    out = fingerprints.edited_fingerprints(table(tune(spark), folder, "documents"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.printed(F.col("places"), F.col("hashes")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_places"), F.col("edited_hashes")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_line_dedup, op3_minhash, op4_mixing, op5_suffix_dedup, op6_html, op7_ann, op8_quality, op9_substring_dedup,
    op10_decontamination, op11_hard_negatives, op12_centroids, op13_fingerprints, page_languages,
)}
