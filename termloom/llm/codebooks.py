"""Compression of vectors to codebook indexes, in integers only.

A vector is cut into equal parts, and every part is replaced by the index of the nearest entry of
its position's codebook.  Parts and entries are padded with zeros to a power of two and put
through the Walsh-Hadamard transform, which multiplies each squared distance by the padded
width.  Squared differences are added up in the order of sequency, slowest waves first, as these
carry most of a smooth part; an entry is out as soon as its partial sum passes the whole distance
of a good one, and what is left at the end is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from termloom.llm.support import arrow_map, lookup, unused
from termloom.session import settle

PARTS = 16
ENTRIES = 64
ROUNDS = 2
FACTOR = 256  # components are rounded down to a multiple of 1 / FACTOR
_BLOCK = 4096  # vectors compared together


# Transform -----------------------------------------------------------------------------


def walsh(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, padded with zeros, in the order of sequency."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    out = np.zeros((len(rows), width), dtype=rows.dtype)
    out[:, : rows.shape[1]] = rows
    half = 1
    while half < width:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        out = out.reshape(len(rows), width)
        half *= 2
    return out[:, _by_sequency(width)]


def _by_sequency(width: int) -> list[int]:
    """Numbers of the waves in natural order, by how often they change sign."""

    def changes(wave: int) -> int:
        signs = [(wave & place).bit_count() & 1 for place in range(width)]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    return sorted(range(width), key=changes)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry, the lowest of several, and the squared distance."""
    if _fits(parts, entries):
        x, y = walsh(parts), walsh(entries)
    else:  # numbers of any length
        x, y = walsh(parts.astype(object)), walsh(entries.astype(object))
    width = x.shape[1]
    sums = (x[:, :1] - y[:, 0]) ** 2
    for place in range(1, min(width, 2)):
        sums = sums + (x[:, place, None] - y[:, place]) ** 2
    # The whole distance of the entry that leads so far is a bound for all others.
    lead = y[np.argmin(sums, axis=1)]
    bound = ((x - lead) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    left = sums[row, entry]
    for place in range(2, width):
        left = left + (x[row, place] - y[entry, place]) ** 2
        in_ = left <= bound[row]
        row, entry, left = row[in_], entry[in_], left[in_]
    # Rows are in order, and the entries of a row too; the leading entry itself is left at least.
    start = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(left, start)
    hit = np.flatnonzero(left == np.repeat(least, np.diff(start, append=len(row))))
    first = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
    return entry[first], least // width


def _fits(*arrays: np.ndarray) -> bool:
    """Whether all sums of squared differences of transformed rows fit 64 bits."""
    most = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    width = 1 << max(0, arrays[0].shape[1] - 1).bit_length()
    return width * (2 * width * most) ** 2 < 1 << 54  # the parts of a vector are added up too


# Vectors -------------------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(vec_id, label, vector): usable vectors in whole numbers, written out."""
    source = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    kept = StructType([*source.schema.fields[:2], StructField("vector", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)  # nulls become NaN
            usable = np.isfinite(values)
            bad = np.concatenate([[0], np.cumsum(~usable)])
            good = (bad[ends[1:]] == bad[ends[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            whole = np.floor(np.where(usable, values, 0) * FACTOR)
            if whole.size and np.abs(whole).max() >= 2.0**63:
                raise OverflowError("a component is too large for a 64-bit integer")
            lists = pa.ListArray.from_arrays(lists.offsets, pa.array(whole.astype(np.int64)))
            out = pa.RecordBatch.from_arrays([*batch.columns[:2], lists], names=["vec_id", "label", "vector"])
            yield out.filter(pa.array(good))

    return settle(source.mapInArrow(run, kept), "whole-vectors")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    lists = pa.array(column) if not isinstance(column, pa.Array) else column
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every part and squared distance of all together; ``books`` is (part, entry, position)."""
    n_parts, _, width = books.shape
    code = np.zeros((len(vectors), n_parts), dtype=np.uint8)
    error = np.zeros(len(vectors), dtype=np.int64)
    for part in range(n_parts):
        own = vectors[:, part * width : (part + 1) * width]
        code[:, part], distance = nearest(own, books[part])
        error = error + distance
    return code, error


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            yield batch.slice(start, _BLOCK)


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: each entry becomes the floored mean of the parts it is nearest to.

    A task adds its parts up first; at most one row for each entry comes back from the sums.
    """
    n_parts, n_entries, width = books.shape
    schema = pa.schema([("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        n = np.zeros((n_parts, n_entries), dtype=np.int64)
        sums = np.zeros((n_parts, n_entries, width), dtype=object)
        for batch in _blocks(batches):
            rows = _matrix(batch.column(0), n_parts * width)
            code, _ = _assign(rows, books)
            # A block's sums fit 64 bits unless a component is enormous.
            rows = rows if rows.size and np.abs(rows).max() < 1 << 50 else rows.astype(object)
            for part in range(n_parts):
                own = np.zeros((n_entries, width), dtype=rows.dtype)
                np.add.at(own, code[:, part], rows[:, part * width : (part + 1) * width])
                sums[part] += own
                n[part] += np.bincount(code[:, part], minlength=n_entries)
        used = np.flatnonzero(n)
        flat = sums.reshape(n_parts * n_entries, width)
        yield [used, n.ravel()[used], [[str(v) for v in flat[entry]] for entry in used]]

    found = arrow_map(vectors.select("vector"), schema, make)
    total = [F.sum(F.get("sums", place).cast("decimal(38,0)")).alias(f"s{place}") for place in range(width)]
    books = books.copy().reshape(n_parts * n_entries, width)
    for row in found.groupBy("entry").agg(F.sum("n").alias("n"), *total).collect():
        books[row["entry"]] = [int(value) // row["n"] for value in row[2:]]
    return books.reshape(n_parts, n_entries, width)


def train_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    """Codebooks (part, entry, position) of whole vectors with a vec_id.

    They start as the parts of the vectors with the smallest ids, and go through ``rounds`` of
    assignment and averaging over all vectors.  Only codebooks pass the driver.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    widest = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-widest // parts))
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for place, row in enumerate(first):
        start[place, : len(row["vector"])] = row["vector"]
    books = start.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        books = _moved(vectors, books)
    return books


def encode_vectors(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of whole vectors: code in hex, two digits for each part."""
    n_parts, _, width = books.shape
    schema = StructType([*vectors.select("vec_id", "label").schema.fields])
    schema = schema.add(StructField("code", StringType())).add(StructField("error", LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            code, error = _assign(_matrix(batch.column(2), n_parts * width), books)
            columns = [
                *batch.columns[:2],
                pa.array([row.tobytes().hex() for row in code], pa.string()),
                pa.array(error.tolist(), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.select("vec_id", "label", "vector").mapInArrow(run, schema)


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Codes and errors of all usable vectors under codebooks trained on all of them.

    Components become floor(FACTOR * x).  Vectors that are null or hold null or non-finite
    components are left out.  Vectors that are shorter than the longest, or whose width the
    number of parts does not divide, are padded with zeros.  Rows of one id are ordered by their
    components; a null id comes last.  With fewer vectors than ``entries`` there are as many
    entries as vectors; an empty table gives no rows.  Up to 256 entries fit a code; components
    or errors beyond 64 bits raise an error.

    Returns vec_id, code, error, label_error (the errors of all rows of the label, nulls
    together) and codebooks_sha256.
    """
    whole = whole_vectors(vectors, id_column, vector_column, label_column)
    books = train_codebooks(whole, parts, entries, rounds)
    if not books.size:
        none = F.lit(None)
        return whole.limit(0).select(
            "vec_id", none.cast("string").alias("code"), none.cast("bigint").alias("error"),
            none.cast("bigint").alias("label_error"), none.cast("string").alias("codebooks_sha256"),
        )
    coded = settle(encode_vectors(whole, books), "codes")
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return lookup(coded, settle(errors, "label-errors"), ["label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
