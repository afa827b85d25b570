"""Token counts with a digest cache.

The cache is a table (content, tokenizer, n_tokens) keyed by the SHA-256 of a text and of the
tokenizer's version.  Counting joins the digests of all texts to it, encodes each distinct text
that it lacks once and appends the new counts, so that later runs encode new contents only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from termloom.llm.encoding import load_tokenizer
from termloom.llm.support import lookup, rows_map, texts_of
from termloom.session import Size, broadcast_if, settle

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    digest = hashlib.sha256(Path(path).read_bytes())
    digest.update(f"{library} {version(library)}".encode())
    return digest.hexdigest()


@lru_cache(maxsize=4)
def token_counter(path: str) -> Callable[[str], int]:
    """Counts a text's tokens without begin, end or added special tokens."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        encode = SentencePieceProcessor(model_file=path).encode
        return lambda text: len(encode(text))
    tokenizer = load_tokenizer(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def normalised(text: Column) -> Column:
    """The content a count belongs to: a null text counts as an empty one.

    Both libraries normalise by themselves, so any further change could alter a count.
    """
    return F.coalesce(text, F.lit(""))


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame | None:
    """Counts stored for a tokenizer, one row per content; None if there is no cache yet."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Runs at the same time may both have appended a content; its counts are equal.
    own = stored.filter(F.col("tokenizer") == tokenizer_version(tokenizer))
    return own.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Bytes and tokens of every text, by way of the cache in folder ``cache``.

    Digests meet the cache first; only texts that it lacks are fetched and encoded, each distinct
    one once, and their counts appended.  ``tokenizer`` is the path of a ``.json`` or ``.model``
    file.  Repeated rows are returned as often as they occur; an empty table gives no rows.

    Returns doc_id, n_bytes, n_tokens.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_column, text_column).select("doc_id", normalised(F.col("text")).alias("text"))
    texts = texts.withColumn("content", F.unhex(F.sha2("text", 256)))
    sizes = texts.select("doc_id", "content", F.octet_length("text").cast("bigint").alias("n_bytes"))
    sizes = settle(sizes, "digests")
    wanted = settle(sizes.select("content").distinct(), "contents")
    known = cached_counts(spark, cache, tokenizer)
    misses = wanted if known is None else settle(wanted.join(known, "content", "left_anti"), "misses")
    _append_counts(texts, misses, tokenizer, cache)
    counts = settle(cached_counts(spark, cache, tokenizer).join(wanted, "content", "left_semi"), "counts")
    return lookup(sizes, counts, ["content"]).select("doc_id", "n_bytes", "n_tokens")


def _append_counts(texts: DataFrame, misses: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode the texts of the missing contents and add their counts to the cache.

    Few misses are broadcast, so that known texts do not move.  Copies are reduced to one per
    task before any text moves.
    """
    few = broadcast_if(misses, Size(misses.count(), 0).times(4))  # a digest is 32 bytes
    if few is not misses:
        texts = texts.join(few, "content", "left_semi")
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    if few is misses:
        distinct = distinct.join(misses, "content", "left_semi")
    stamp = tokenizer_version(tokenizer)
    schema = pa.schema([("content", pa.binary()), ("tokenizer", pa.string()), ("n_tokens", pa.int64())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        count = token_counter(tokenizer)
        for content, text in rows:
            yield content, stamp, count(text)

    rows_map(distinct.select("content", "text"), schema, make).write.mode("append").parquet(cache)
