"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import circulant_minhash, decontamination, exact_dedup, importance, line_dedup, lm_score, ngram_join, prefix_trie, quality, secrets, sentencepiece_bpe, sharding, substring_dedup
from tickloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": lambda spark, d: decontamination.query(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")),
    "op2_exact_dedup": exact_dedup.query,
    "op3_secret_scan": lambda spark, d: secrets.query(documents(spark, d)),
    "op4_substring_dedup": lambda spark, d: substring_dedup.query(documents(spark, d)),
    "op5_quality": lambda spark, d: quality.query(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
    "op6_sentencepiece": lambda spark, d: sentencepiece_bpe.query(documents(spark, d)),
    "op7_ngram_join": lambda spark, d: ngram_join.query(documents(spark, d)),
    "op8_sharding": lambda spark, d: sharding.query(documents(spark, d)),
    "op9_lm_score": lambda spark, d: lm_score.query(documents(spark, d)),
    "op10_line_dedup": lambda spark, d: line_dedup.query(documents(spark, d)),
    "op11_prefix_trie": lambda spark, d: prefix_trie.query(spark.read.parquet(f"{d}/conversations.parquet")),
    "op12_circulant_minhash": lambda spark, d: circulant_minhash.query(documents(spark, d)),
    "op13_importance": lambda spark, d: importance.query(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")),
}

SQL: dict[str, str] = {
    "op1_decontamination": decontamination.SQL,
    "op2_exact_dedup": exact_dedup.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_circulant_minhash": circulant_minhash.SQL,
    "op13_importance": importance.SQL,
}
