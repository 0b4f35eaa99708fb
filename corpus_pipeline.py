"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next.

quality (documents that the classifier rejects go), lines (frequent lines go), near_copies (one document of each group
stays), leaks (documents that hold a benchmark item go), tokens (token counts and digests of what is left).  The stages
before the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, line_dedup, ngram_join, quality, sentencepiece_bpe
from tickloom.llm.common import P, cut, discard, documents


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold (one half); a null identifier or text is scored like any other."""
    scored = quality.score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where(F.col(f"{P}score") >= 0.5).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without frequent lines outside the document that keeps them; a null text becomes empty."""
    done = line_dedup.dedup_lines(docs)
    new = {"text": F.col(f"{P}kept"), "n_chars": F.length(f"{P}kept").cast("long")}
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest identifier."""
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document: number of tokens and digests of ids and of the decoded text."""
    return sentencepiece_bpe.query(docs)


STAGES = [("quality", rate_quality), ("lines", drop_lines), ("near_copies", drop_near_copies), ("leaks", drop_leaks), ("tokens", tokenize)]

#: The quality score and the tokenizer have no SQL; a test holds every stage against a brute-force version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what a stage wrote is deleted when the next one has been written."""
    docs, before = documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
            if before is not None:
                discard(before)
            before = docs
    return docs
