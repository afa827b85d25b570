"""A corpus pipeline: each stage works on all rows that the one before it kept.

Every stage gets (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of ``documents``.

- language_id: documents without a letter, or in an alphabet that no learned language uses, go;
  if no document has a label to learn from, all stay.
- simhash_near_dedup: of linked documents the one with the smallest id stays; of several rows
  with this id and linked texts the one with the smallest hash of its text.
- substring_dedup: words of passages that start in an earlier document too are cut out;
  documents that lose every word go.
- secret_scan: secrets that are no widely copied example are blanked out.
- best_fit_packing: the texts that are left are packed into sequences.

Rows without an id are kept by the near-duplicate stage, for they cannot be named; of repeated
rows with an id one stays, of rows of one id with unlike texts one of each.  Empty tables pass
through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from termloom.llm.language import keep_determined, learn_languages
from termloom.llm.packing import pack_documents
from termloom.llm.secret_scan import redact_secrets
from termloom.llm.simhash import keep_one
from termloom.llm.substrings import drop_repeats
from termloom.llm.support import ship_package
from termloom.session import settle

# SQL has no tokenizer, SimHash components or trained classifier.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_determined(docs, learn_languages(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), memo_chunks=MEMO_CHUNKS)


# Chunks of text that a packing task remembers: fewer than by default, which saves a worker some
# hundred megabytes where packing is one stage of several.
MEMO_CHUNKS = 120_000

STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs


def pipeline_queries() -> dict:
    return {"pipeline": run}


def pipeline_oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
