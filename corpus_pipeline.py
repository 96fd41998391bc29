"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run``
writes every stage's result to the shared folder and hands the next one what it reads there.
All stages but the last return the columns of the documents they get.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselake.llm import exact_dedup, language, mixing, pieces, simhash
from pulselake.llm.common import squeeze, table
from pulselake.session import stage

#: Calibrated probability that the most likely language must reach.
SURE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model tells with at least ``SURE``; ``und`` goes."""
    model = language.train(docs.select("doc_id", "text", "lang"))
    inner = docs.toDF(*[_inner(c) for c in docs.columns])
    renamed = inner.withColumnRenamed(_inner("text"), "text")
    judged = language.predict(renamed, model, renamed.columns)
    kept = judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= SURE))
    return kept.select(*[F.col("text" if c == "text" else _inner(c)).alias(c) for c in docs.columns])


def _inner(name: str) -> str:
    """A name that no operator gives a column of its own."""
    return f"in_{name}"


def _keep(docs: DataFrame, mark: Column, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, ``mark``) stands in ``keep`` (k_id, k_mark), one of each.

    Of rows that repeat both, the one with the least hash of all columns stays, so that reruns
    agree. ``keep`` has every pair once.
    """
    # A null id is a value here, not an unknown.
    ident = lambda c: F.coalesce(F.concat(F.lit("#"), c.cast("string")), F.lit(""))
    marked = docs.withColumn("in_id", ident(F.col("doc_id"))).withColumn("in_mark", mark)
    found = marked.join(
        keep.select(ident(F.col("k_id")).alias("in_id"), F.col("k_mark").alias("in_mark")), ["in_id", "in_mark"]
    )
    order = Window.partitionBy("in_id", "in_mark").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return found.withColumn("in_row", F.row_number().over(order)).filter("in_row = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    kept = exact_dedup.exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_mark"))
    return _keep(docs, F.sha2(squeeze(F.col("text")), 256), kept)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, that with the smallest doc_id."""
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("in_mark"))
    found = simhash.near_duplicates(marked, ["in_mark"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "in_mark")).alias("first")
    kept = found.groupBy("group").agg(first).select(F.col("first.doc_id").alias("k_id"), F.col("first.in_mark").alias("k_mark"))
    return _keep(docs, F.xxhash64("text"), kept)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes its words, to the nearest whole.

    The mix cuts at most one document of each source. Documents it doesn't take go. Rows that
    share id, source and size go by the least of theirs.
    """
    placed = stage(mixing.mix(docs.select("doc_id", "source", "text"), carry_source=True), "mixed")
    copies = F.expr("cast((2 * taken + size) div (2 * size) as int)")
    ident = lambda c: F.coalesce(F.concat(F.lit("#"), c.cast("string")), F.lit(""))
    taken = (
        placed.filter("size > 0")
        .groupBy(ident(F.col("doc_id")).alias("in_id"), ident(F.col("source")).alias("in_source"), F.col("size").alias("in_size"))
        .agg(F.min(copies).alias("in_copies"))
        .filter("in_copies > 0")
    )
    marked = (
        docs.withColumn("in_id", ident(F.col("doc_id")))
        .withColumn("in_source", ident(F.col("source")))
        .withColumn("in_size", mixing.word_count(F.col("text")))
    )
    found = marked.join(taken, ["in_id", "in_source", "in_size"])
    return found.withColumn("in_copy", F.explode(F.sequence(F.lit(1), F.col("in_copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, round_trip of every document left."""
    return pieces.encode_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("source_mix", mix_stage),
    ("sentencepiece", encode_stage),
]

#: SQL can't express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
