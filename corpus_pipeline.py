"""From raw documents to a training mixture: five stages, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from policylake.llm import contamination, language, lines, mixing, neardup
from policylake.session import stage

BROADCAST_KEYS = 1_000_000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(apply: Stage) -> Stage:
    """Whole texts reach Python workers 200 rows at a time, unless the session says otherwise, so that workers stay small from stage to stage."""
    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not spark.sparkContext.getConf().contains(BATCH_ROWS):
            spark.conf.set(BATCH_ROWS, "200")
        return apply(spark, docs, sf_dir)

    return run


def few(keys: DataFrame) -> DataFrame:
    """Staged keys, for a broadcast while they are known to be few, else for a shuffled join."""
    keys = stage(keys.distinct(), "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def one_of_each_id(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the rows (taken from ``docs``) that are the first of their id by text and the other columns; rows with a null id all stay."""
    twice = few(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"))
    nth = free_name(docs, "nth")
    first = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    one = rows.join(twice, "doc_id", "left_semi").withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1).drop(nth)
    return rows.join(twice, "doc_id", "left_anti").unionByName(one).select(*docs.columns)


@in_small_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the others go. Rows are told apart by id and text."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = language.identify(keyed, id_col=key, declared=F.col("lang"), host=F.col("source"))
    return keyed.join(few(found.filter("not accepted").select(key)), key, "left_anti").select(*docs.columns)


@in_small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that one of smaller id holds."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = lines.drop_repeated_lines(docs, carry=rest)
    out = out.select("doc_id", F.col("kept").alias("text"), *[F.col("carried")[c].alias(c) for c in rest], F.char_length("kept").cast("long").alias("n_chars"))
    return out.select(*docs.columns)


@in_small_batches
def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of rows with one id, the first by text."""
    found = stage(neardup.near_duplicates(docs).select("doc_id", "component_id"), "near-copies")
    kept = docs.join(few(found.filter("doc_id <> component_id").select("doc_id")), "doc_id", "left_anti")
    return one_of_each_id(kept, docs)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark."""
    found = contamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(few(found.select("doc_id")), "doc_id", "left_anti").select(*docs.columns)


@in_small_batches
def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document's text once for each epoch that takes it, with its place in the order; of rows with one id, the first by text."""
    docs = one_of_each_id(docs, docs)
    taken = mixing.mixture(docs)
    return taken.join(docs.select("doc_id", "text", "lang"), "doc_id").withColumn("weight", F.round("weight", 9))


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("minhash_dedup", minhash_dedup), ("decontamination", decontamination),
    ("mixing", mixing_sources),
]

# MinHash components, trigram posteriors and alignments have no SQL form; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
