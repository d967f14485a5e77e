"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing by weight, packing.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns they were given. NULL texts count as empty everywhere.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import line_dedup, mixing, near_dup, packing, quality_rules
from tidelake.session import configure, materialise


def _whole(docs: DataFrame):
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood threshold, unchanged."""
    configure(spark)
    verdict = quality_rules.judge(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return docs.select(_whole(docs), verdict(docs["text"]).alias("v")).filter("v.kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that a smaller id holds; ``n_chars``, where there, follows the text."""
    configure(spark)
    new = {"text": F.col("lines.kept"), "n_chars": F.length("lines.kept").cast("bigint")}
    return line_dedup.dedup_lines(docs).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near copies, unchanged."""
    configure(spark)
    return near_dup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice; unchanged."""
    configure(spark)
    mixed = mixing.mix(docs).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    path = public_tokenizers.path
    return packing.pack(docs, packing.byte_bpe(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"),
                                               public_tokenizers.PATTERN))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
