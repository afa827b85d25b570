"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from termloom.session import BROADCAST_BYTES, measured, settle

Columns = list

# A key is hot from this share of all rows on, so there are at most this many hot keys.
HOT_KEYS = 1000


def arrow_map(
    df: DataFrame, schema: pa.Schema, make: Callable[[Iterator[pa.RecordBatch]], Iterator[Columns]]
) -> DataFrame:
    """Map Arrow batches with ``make``, which yields lists of columns in the order of ``schema``.

    ``make`` is called once per task with the stream of its batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in make(batches):
            arrays = [
                column if isinstance(column, pa.Array) else pa.array(column, field.type)
                for column, field in zip(columns, schema, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, from_arrow_schema(schema))


def release_encoders() -> None:
    """Free the encoders that earlier tasks of this worker kept for themselves.

    They and their remembered chunks take some hundred megabytes, which a worker that turns to
    other work would hold for nothing.
    """
    encoding = sys.modules.get("termloom.llm.encoding")
    if encoding:
        encoding.word_encoder.cache_clear()
        encoding.byte_encoder.cache_clear()


class RowBuffer:
    """Gathers rows and hands them out as columns, some thousands or some megabytes at a time."""

    def __init__(self, width: int, rows: int = 4096, size: int = 8_000_000):
        self.columns: Columns = [[] for _ in range(width)]
        self.most_rows, self.most_size, self.size = rows, size, 0

    def add(self, row: tuple, size: int = 0) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.size += size

    @property
    def full(self) -> bool:
        return len(self.columns[0]) >= self.most_rows or self.size >= self.most_size

    def take(self) -> Columns:
        columns, self.columns, self.size = self.columns, [[] for _ in self.columns], 0
        return columns


def rows_map(
    df: DataFrame, schema: pa.Schema, make: Callable[[Iterator[tuple]], Iterator[tuple]]
) -> DataFrame:
    """Map rows with ``make``, which gets the stream of a task's rows and yields tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

        buffer = RowBuffer(len(schema))
        for row in make(rows()):
            buffer.add(row, sum(len(v) for v in row if isinstance(v, (bytes, str, list))))
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    return arrow_map(df, schema, run)


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``text`` of any table of texts; other columns are left behind."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has one row for each of their keys.

    Null keys are equal.  A table of proven size is broadcast.  Otherwise only the rows of hot
    keys meet a broadcast part of it, at most HOT_KEYS rows whatever the data, and all others a
    shuffled one, so that no task gets all rows of a hot key.
    """
    taken = [column for column in table.columns if column not in keys]

    def joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        names = {key: f"_k{place}" for place, key in enumerate(keys)}
        right = right.withColumnsRenamed(names)
        same = [left[key].eqNullSafe(right[name]) for key, name in names.items()]
        out = left.join(right, same, how)
        return out if how == "left_anti" else out.select(*(left[c] for c in left.columns), *taken)

    size = measured(table)
    if size.rows * 16 * (len(table.columns) + 1) + size.text_bytes <= BROADCAST_BYTES:
        return joined(rows, F.broadcast(table))
    counts = settle(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.filter(F.col("_n") * HOT_KEYS > total).select(*keys))
    few = settle(table.join(hot, [table[key].eqNullSafe(hot[key]) for key in keys], "left_semi"), "hot")
    return joined(rows, F.broadcast(few)).unionByName(joined(joined(rows, hot, "left_anti"), table))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    steps = np.full(n, base, dtype=np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library's own modules, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    handle, path = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for module in sorted(root.rglob("*.py")):
            archive.write(module, module.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)
