"""Corpus pipeline: from raw documents to the token ids of the documents that stay.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.llm.byte_bpe import encode_documents
from sensorwarden.llm.common import HEAVY_ROWS, free_name, gathered, written
from sensorwarden.llm.decontaminate import decontaminated
from sensorwarden.llm.exact_dedup import distinct_rows
from sensorwarden.llm.jaccard_join import jaccard_components
from sensorwarden.llm.toxicity import fit_toxicity, score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.5 or more go."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free_name(docs, "toxicity")
    return score_toxicity(docs, model, score_col=score).filter(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space the longest stays, then the smallest id."""
    return distinct_rows(docs, rows=docs.count())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 over five-word shingles the one with the smallest id stays.

    Rows without an id stay; rows that share an id go together.
    """
    found = jaccard_components(docs, percent=80, words=5)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    return gathered(kept, docs.count(), HEAVY_ROWS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of the five-word shingles of a benchmark item go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80, words=5)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that stay, with the digests of ids and decoded text.

    Workers of the pipeline also hold what earlier stages left, so its tables are kept small.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True, table_bytes=160 << 20)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL can express neither the toxicity model nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
