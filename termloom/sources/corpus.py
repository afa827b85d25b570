"""Document sources: whole text files, or any table with an id and a text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.session import settle


def file_name(path: Column) -> Column:
    """Last component of a path."""
    return F.element_at(F.split(path, "/"), -1)


@lru_cache(maxsize=1)
def _bare_letters() -> dict[str, str]:
    """Letters with accents, and the letter without them; accents on their own are left out."""
    bare = {chr(code): "" for code in range(0x300, 0x370)}
    for code in range(0xC0, 0x2000):
        first, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and all(unicodedata.combining(mark) for mark in marks):
            bare[chr(code)] = first
    return bare


def document_key(filename: Column) -> Column:
    """Identity of a document: its file name, letter case and accents ignored."""
    bare = _bare_letters()
    kept = {char: base for char, base in bare.items() if base}
    gone = [char for char, base in bare.items() if not base]
    plain = F.translate(F.lower(filename), "".join([*kept, *gone]), "".join(kept.values()))
    return F.when(F.octet_length(filename) == F.char_length(filename), F.lower(filename)).otherwise(F.lower(plain))


def _file_columns(files: DataFrame, text: Column) -> DataFrame:
    return files.select(
        file_name(F.col("path")).alias("filename"),
        F.col("path").alias("filepath"),
        F.unix_micros("modificationTime").alias("seq"),
        text.alias("text"),
    )


def read_text_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read every file under ``path`` as one document, whatever its extension.

    Columns: filename, filepath, seq (the modification time, by which the last of several files
    of one name wins), text.  A file that cannot be read, or whose bytes are no UTF-8, has a
    null text, which ``ingest_report`` shows as failed; to find files that gave nothing, the names
    of all are compared with the names of those that did.
    """
    names = spark.read.format("binaryFile").load(path)
    return _with_failed(_readable(spark, path), _file_columns(names, F.lit(None).cast("string")))


def _readable(spark: SparkSession, path: str | list[str]) -> DataFrame:
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    files = reader.load(path).filter(F.col("content").isNotNull())
    return _file_columns(files, F.try_validate_utf8(F.col("content").cast("string")))


def _with_failed(texts: DataFrame, names: DataFrame) -> DataFrame:
    """All texts, and a null one for each name without a file that could be read."""
    return texts.unionByName(names.join(texts.select("filepath"), "filepath", "left_anti").select(*texts.columns))


def stream_file_names(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """Streaming list of the files that arrive under ``path``; their content is not read."""
    reader = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_per_batch)
    reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    return reader.load(path).select("path", "modificationTime")


def read_named_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """:func:`read_text_files` for some of the files of a folder, ``(path, modificationTime)``.

    Their number is bounded by the size of a stream's batch.  One listing of the folder tells
    which of them are still there.
    """
    names = settle(_file_columns(files, F.lit(None).cast("string")), "arrived-names")
    listed = spark.read.format("binaryFile").load(folder).select(F.col("path").alias("filepath"))
    there = [row[0] for row in listed.join(names, "filepath", "left_semi").collect()]
    if not there:
        return names
    # In a path to read, these characters would be wildcards.
    literal = [re.sub(r"([*?\[\]{}\\])", r"\\\1", path) for path in there]
    return _with_failed(_readable(spark, literal), names)


def table_documents(table: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Present a table of texts as documents named after their ids."""
    return table.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(doc_id).cast("string").alias("filename"),
        F.lit(None).cast("string").alias("filepath"),
        F.col(text).alias("text"),
    )


def assign_doc_ids(
    docs: DataFrame, after: int = -1, keep: Callable[[DataFrame], DataFrame] = settle
) -> DataFrame:
    """Give documents without an id a unique one above ``after``.

    The numbered table is written out first, by ``keep``, since the numbers depend on the partitioning.
    """
    if "doc_id" in docs.columns:
        return docs
    number = F.monotonically_increasing_id() + F.lit(after + 1)
    return keep(docs.select(number.alias("doc_id"), "*"))
