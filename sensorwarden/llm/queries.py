"""One query per corpus operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat
from .byte_bpe import encode_documents
from .collocations import collocations
from .common import utf8_sha256
from .decontaminate import contained_items
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .line_dedup import line_dedup
from .middle import fill_in_middle
from .oracle import ORACLE as ORACLE
from .packing import pack_documents
from .quality import score_quality
from .substring_dedup import substring_dedup
from .toxicity import fit_toxicity, held_out, score_toxicity
from .warc import archived_index


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80, words=5)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back from the formatted string."""
    stored = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], stored.schema)
    turns = stored.unionByName(planted).select(
        "conv_id", "turn", "role", F.array(chat.text_part(F.coalesce("text", F.lit("")))).alias("parts")
    )
    done = chat.format_chat(turns)
    said_by = chat.parsed_turns(F.col("formatted"))
    read = F.array_join(F.transform(said_by, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = chat.masked_text(F.col("formatted"), F.col("loss"))
    return done.select(
        "conv_id",
        F.size(said_by).cast("bigint").alias("n_turns"),
        utf8_sha256(read).alias("turns_sha256"),
        F.length(masked).cast("bigint").alias("loss_chars"),
        utf8_sha256(masked).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    model = fit_toxicity(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_documents(spark, sf_dir), window=35).drop("spans")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return archived_index(pages, min_bytes=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir), min_docs=10, min_chars=1)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir), percent=85, words=4)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir), min_count=30, width=4, top=2000, percent=80)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(_documents(spark, sf_dir))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_chat_format": op5_chat_format,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_collocations": op11_collocations,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_fill_in_middle": op13_fill_in_middle,
}
