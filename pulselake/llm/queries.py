"""Registered queries of this package and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pulselake.llm import (
    chat_format,
    exact_dedup,
    fill_middle,
    html_text,
    language,
    line_dedup,
    maxscore,
    mixing,
    pieces,
    prefix_trie,
    sharding,
    simhash,
    toxicity,
)
from pulselake.llm.common import table
from pulselake.llm.oracle import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_sharding": _on("documents", sharding.shard),
    "op2_sentencepiece": _on("documents", pieces.encode_documents),
    "op3_exact_top_k": _on("embeddings", maxscore.top_k),
    "op4_exact_dedup": _on("documents", exact_dedup.exact_dedup),
    "op5_source_mix": _on("documents", mixing.mix),
    "op6_toxicity": lambda spark, sf_dir: toxicity.toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op7_html_extraction": _on("pages", html_text.extract),
    "op8_line_dedup": _on("documents", line_dedup.line_dedup),
    "op9_language_id": _on("documents", language.identify),
    "op10_simhash": _on("documents", simhash.near_duplicates),
    "op11_chat_format": _on("conversations", chat_format.chat_digests),
    "op12_prefix_trie": _on("conversations", prefix_trie.prefix_trie),
    "op13_fill_middle": _on("documents", fill_middle.fill_middle_digests),
    "pipeline": corpus_pipeline.run,
}
