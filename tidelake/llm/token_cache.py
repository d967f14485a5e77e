"""Token counts with a digest cache: only texts that no earlier run has counted are encoded.

The cache is a table of ``(tokenizer, digest, n_tokens)``: the SHA-256 of the tokenizer's file, the SHA-256 of the
content, the count. Content is normalised only where no count can change: NULL becomes the empty text.

1. One text per digest is kept, copies going map-side before the shuffle.
2. Digests the cache holds for this tokenizer version drop out; the rest is encoded and appended to the cache.
3. Documents, as ids and digests without their text, are joined to the counts.

An append is one write of new files, so a run that breaks off leaves a cache that is right; digests that two runs added
are counted once. NULL and empty texts have 0 bytes and the count of the empty text. NULL ids stay NULL, repeated rows
get a row each, other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from pathlib import Path
from typing import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import as_text_array
from tidelake.session import materialise

CACHE = "digest binary, n_tokens bigint, tokenizer string"
BATCH = 256


def file_version(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=4)
def _pieces(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def counter_of(path: str) -> Callable[[list[str]], list[int]]:
    """``texts -> counts`` for a sentencepiece model (``.model``) or a tokenizers file (``.json``); loaded once a worker."""
    if path.endswith(".model"):
        return lambda texts: [len(x) for x in _pieces(path).encode(texts, num_threads=1)]
    return lambda texts: [len(x.ids) for x in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def read_cache(spark, path: str, version: str) -> DataFrame:
    """Counts of this tokenizer version, one per digest; empty where there is no cache yet."""
    try:
        held = spark.read.schema(CACHE).parquet(path)
        held.isEmpty()
    except Exception as missing:  # noqa: BLE001 - the condition is told apart below
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        held = spark.createDataFrame([], CACHE)
    return held.filter(F.col("tokenizer") == version).select("digest", "n_tokens")


def count_tokens(docs: DataFrame, counter: Callable[[list[str]], list[int]], version: str, cache: str,
                 limit: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; the cache at ``cache`` has every digest afterwards."""
    spark = docs.sparkSession

    @F.arrow_udf("bigint")
    def count(column: pa.Array) -> pa.Array:
        texts, out = as_text_array(column), []
        for i in range(0, len(texts), BATCH):
            out += counter(texts.slice(i, BATCH).to_pylist())
        return pa.array(out, pa.int64())

    content = F.coalesce(F.col(text_column), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    one_each = docs.select(digest.alias("digest"), content.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = one_each.join(read_cache(spark, cache, version), "digest", "left_anti")
    (misses.select("digest", count("text").alias("n_tokens"), F.lit(version).alias("tokenizer"))
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    # As a table of its own, so that a digest which many rows share can be split in the join.
    counts = materialise(read_cache(spark, cache, version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "counts")
    ids = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(content).cast("bigint").alias("n_bytes"),
                      digest.alias("digest"))
    return ids.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
