"""Corpus pipeline: what a training run gets from ``documents``.

Toxic documents go, repeated lines go, one document of each near-duplicate group
stays, documents with benchmark passages go, and the rest is tokenized. Each
stage calls one operator of ``wavefold.llm``; what it returns is written as
Parquet and read again before the next stage, so a lost executor costs at most
one stage's tasks.

The line stage folds equal lines of any length but blank ones; within an edit it
compares lines of line_dedup.MIN_CHARS characters or more.

Rows are dropped only by a stage's own rule: clean documents pass through. The
line stage also drops documents whose text it has emptied altogether (copies
whose every line stands in earlier documents); texts that were empty before stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavefold.llm import byte_bpe, decontaminate, line_dedup, queries, simhash, toxicity
from wavefold.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = queries.fitted_toxicity(spark, docs, sf_dir)
    return toxicity.keep_civil(docs, chain, "toxic")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup(docs, fold_chars=1)
    emptied = (F.col("__n_kept") < F.col("__n_lines")) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return left.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, k=3, max_bits=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), n=queries.BENCHMARK_WINDOW, mode="documents")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers that have run four other stages keep some of their memory: the transducer gets less of it
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                               keep_ids=True, memory=0.3)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("byte_level_bpe", tokenize),
]

#: A fitted classifier decides the first stage, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
