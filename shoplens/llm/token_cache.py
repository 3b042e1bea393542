"""Token counts through a digest cache.

A document's count depends only on its content and on the tokenizer, so the
cache holds one row per (tokenizer digest, content digest). Counting joins the
documents' digests to the cache, encodes each distinct missing content once,
appends those counts to the cache, and reads the counts back by digest.

Defined cases: null text counts as the empty text (0 tokens); repeated rows
each get a result row but are encoded once; an empty table gives an empty
result; other columns of the input are ignored. The content is not normalised
further than null -> "", because any other change could change the count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import chunks, prepare, staged, table, whole_text
from shoplens.session import work_path

MODEL = "piece_bpe_32k.model"
CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
OVER = 4096


@lru_cache(maxsize=2)
def _load(model: str):
    path = public_tokenizers.path(model)
    if model.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_digest(model: str = MODEL) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = f"sentencepiece {sentencepiece.__version__}" if model.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    with open(public_tokenizers.path(model), "rb") as f:
        return hashlib.sha256(f.read() + library.encode()).hexdigest()


def token_lengths(model: str, texts: list[str]) -> list[int]:
    tool = _load(model)
    if model.endswith(".model"):
        return [len(x) for x in tool.encode(texts, num_threads=1)]
    return [len(tool.encode(t, add_special_tokens=False).ids) for t in texts]


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _stored(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    # a replayed append may have doubled rows: one count per digest
    cache = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    return cache.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache_path: str, model: str = MODEL, text_col: str = "text") -> None:
    """Encode each distinct content that the cache lacks; append the counts."""
    spark, version = docs.sparkSession, tokenizer_digest(model)
    texts = docs.select(whole_text(text_col).alias("text")).withColumn("digest", F.sha2("text", 256))
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(_stored(spark, cache_path, version), "digest", "left_anti")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for i, j in chunks(texts):
                yield pd.DataFrame({"tokenizer": version, "digest": b["digest"].iloc[i:j], "n_tokens": token_lengths(model, texts[i:j])})

    misses.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)


def count_tokens(docs: DataFrame, cache_path: str, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text", limit: int = OVER) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    fill_cache(docs, cache_path, model, text_col)
    rows = docs.select(F.col(id_col), whole_text(text_col).alias("text"))
    rows = rows.select(id_col, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest"))
    # a written table: both sides of the join are plain shuffles, which Spark
    # splits where one digest has very many rows
    stored = staged(_stored(spark, cache_path, tokenizer_digest(model)), "token_counts")
    counted = rows.join(stored, "digest", "left")
    return counted.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op4_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents; the cache of this call starts empty."""
    return count_tokens(table(spark, sf_dir, "documents"), work_path(spark, "llm", "token_cache"))
