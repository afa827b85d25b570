"""Continuous ingestion: files dropped into a folder update a stored index."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.operators.indexing import SearchIndex
from termloom.operators.maintenance import ingest_report
from termloom.session import settle
from termloom.sources.corpus import read_named_files, stream_file_names
from termloom.sources.index_store import (
    SCHEMAS,
    add_batch,
    current_version,
    index_corpus,
    last_batch,
    load_index,
)


def ingest_stream(
    spark: SparkSession, inbox: str, root: str, progress: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Start a query that indexes the files under ``inbox`` and ends when all are processed.

    The first files make the base of an index that is not there yet, and each later micro-batch
    is a batch of it.  A report of its files, unreadable ones included, is a partition of the
    table ``reports``, written before the batch counts: a micro-batch that fails in between is
    done again and overwrites it, one that counts already is left alone.  Batches remember their
    stream, so other streams into the same root, one at a time, do not matter.  ``progress`` is
    the query's checkpoint folder.
    """
    names = stream_file_names(spark, inbox, files_per_batch)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = stream_identity(session, progress)
        if last_batch(session, root, stream) >= batch_id:
            return
        docs = settle(read_named_files(session, inbox, batch), "arrived")
        empty = current_version(session, root) is None
        write_report(_no_index(session) if empty else load_index(session, root), docs, root, stream, batch_id)
        if empty:
            index_corpus(docs, root, stream, batch_id)
        else:
            add_batch(session, root, docs, stream, batch_id)

    return (
        names.writeStream.foreachBatch(apply)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def write_report(index: SearchIndex, docs: DataFrame, root: str, stream: str, batch_id: int) -> None:
    """Overwrite the report of one micro-batch."""
    path = f"{root.rstrip('/')}/reports/stream={stream}/batch_id={batch_id}"
    ingest_report(index, docs).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _no_index(spark: SparkSession) -> SearchIndex:
    documents, terms, postings = (spark.createDataFrame([], SCHEMAS[t]) for t in ("documents", "terms", "postings"))
    return SearchIndex(documents, terms, postings)


def stream_identity(spark: SparkSession, progress: str) -> str:
    """The id that Spark gave the query with this checkpoint folder; a new folder has a new one."""
    stored = spark.read.text(f"{progress.rstrip('/')}/metadata").first()["value"]
    return json.loads(stored)["id"]
