"""Token ids in files of compressed bit or byte planes.

Ids are laid end to end in ascending ``doc_id`` order and cut into blocks of a fixed number of
ids.  Each block is transposed into planes (all lowest bytes, then all second bytes, ..., or the
same with single bits), and each plane is compressed with zstandard; planes above the largest id
are left out.  A folder holds Parquet files with one row per block::

    shard, chunk        the range of documents it belongs to, and its place there
    first, n_ids        its first id counted from the start of the shard, and how many follow
    plane_bits          8 for byte planes, 1 for bit planes
    plane_sizes, body   compressed length of each plane, and the planes one after the other
    entries             the documents in it: which, where, and how far into the document

All columns but ``body`` are the chunk index; reading them does not touch the planes.  Spark's
writer commits the files, so a lost executor leaves no partial shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.encoding import id_bytes, word_encoder
from termloom.llm.support import rows_map, texts_of

BLOCK_IDS = 65_536

_ENTRY = pa.struct(
    [("ordinal", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int32()), ("n", pa.int32())]
)
_CHUNKS = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
        ("plane_bits", pa.int32()), ("plane_sizes", pa.list_(pa.int32())), ("body", pa.binary()),
        ("entries", pa.list_(_ENTRY)),
    ]
)


def to_planes(ids: bytes, plane_bits: int = 8) -> list[bytes]:
    """Planes of little-endian unsigned 32-bit ids, lowest first, without the empty ones on top."""
    table = np.frombuffer(ids, dtype=np.uint8).reshape(-1, 4)
    if plane_bits == 1:
        table = np.unpackbits(table, axis=1, bitorder="little")
    used = max(np.flatnonzero(table.any(axis=0)), default=-1) + 1
    planes = np.ascontiguousarray(table[:, :used].T)
    return [(np.packbits(plane) if plane_bits == 1 else plane).tobytes() for plane in planes]


def from_planes(planes: list[bytes], n_ids: int, plane_bits: int = 8) -> bytes:
    """The ids of ``to_planes``."""
    table = np.zeros((n_ids, 32 // plane_bits), dtype=np.uint8)
    for place, plane in enumerate(planes):
        values = np.frombuffer(plane, dtype=np.uint8)
        table[:, place] = np.unpackbits(values, count=n_ids) if plane_bits == 1 else values
    return (np.packbits(table, axis=1, bitorder="little") if plane_bits == 1 else table).tobytes()


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    block_ids: int = BLOCK_IDS,
    plane_bits: int = 8,
    level: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text and write the ids under ``path``, a new folder.

    A null or empty text is its end id alone.  Rows are ordered by id, rows of one id by text,
    null ids first; repeated rows are written as often as they occur.  An empty table makes a
    folder without blocks.
    """
    texts = texts_of(docs, id_column, text_column)
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = id_bytes([end_id])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = word_encoder(tokenizer)
        compress = zstandard.ZstdCompressor(level=level).compress
        shard = TaskContext.get().partitionId()
        block, entries, chunk = bytearray(), [], 0

        def close() -> tuple:
            planes = [compress(plane) for plane in to_planes(bytes(block), plane_bits)]
            sizes = [len(plane) for plane in planes]
            first, n_ids = chunk * block_ids, len(block) // 4
            return shard, chunk, first, n_ids, plane_bits, sizes, b"".join(planes), entries

        for ordinal, (doc_id, text) in enumerate(rows):
            ids = encoder.encode(text or "") + end
            at = part = 0
            while at < len(ids):
                own = ids[at : at + 4 * block_ids - len(block)]
                place = {"at": len(block) // 4, "n": len(own) // 4}
                entries.append({"ordinal": ordinal, "doc_id": doc_id, "part": part} | place)
                block += own
                at, part = at + len(own), part + 1
                if len(block) == 4 * block_ids:
                    yield close()
                    block, entries, chunk = bytearray(), [], chunk + 1
        if block:
            yield close()

    rows_map(ordered, _CHUNKS, make).write.parquet(path)


def read_token_parts(
    spark: SparkSession,
    path: str,
    value: Callable[[bytes], object] = bytes,
    kind: pa.DataType | None = None,
) -> DataFrame:
    """What the files under ``path`` hold of each document, one row per block it lies in.

    Columns: shard and ordinal (which name the document), doc_id, part (from 0), start (ids of
    all documents before this part), n_ids, and value: the ids as little-endian unsigned 32-bit
    numbers, or what ``value`` makes of them, of type ``kind``.
    """
    chunks = spark.read.parquet(path)
    # One row per shard: few, however large the corpus.
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    schema = pa.schema(
        [
            ("shard", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
            ("part", pa.int32()), ("position", pa.int64()), ("n_ids", pa.int64()),
            ("value", kind or pa.binary()),
        ]
    )

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        decompress = zstandard.ZstdDecompressor().decompress
        for shard, _, first, n_ids, plane_bits, sizes, body, entries in rows:
            cuts = np.cumsum([0, *sizes]).tolist()
            planes = [decompress(body[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            ids = from_planes(planes, n_ids, plane_bits)
            for entry in entries:
                at, n = entry["at"], entry["n"]
                own = value(ids[4 * at : 4 * (at + n)])
                yield shard, entry["ordinal"], entry["doc_id"], entry["part"], first + at, n, own

    parts = rows_map(chunks.select(*_CHUNKS.names), schema, make)
    return parts.join(bases, "shard").select(
        "shard", "ordinal", "doc_id", "part", (F.col("base") + F.col("position")).alias("start"),
        "n_ids", "value",
    )


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Start, number of ids and CRC-32 of each document, from the files under ``path``."""
    parts = read_token_parts(spark, path, zlib.crc32, pa.int64())
    documents = parts.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.sum("n_ids").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("part", "n_ids", "value"))).alias("parts"),
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, start, n_tokens, parts in rows:
            checksum = parts[0]["value"]
            for part in parts[1:]:
                checksum = append_crc32(checksum, part["value"], 4 * part["n_ids"])
            yield doc_id, start, n_tokens, checksum

    return rows_map(documents.select("doc_id", "start", "n_tokens", "parts"), schema, make)


def append_crc32(head: int, tail: int, tail_bytes: int) -> int:
    """CRC-32 of two byte strings, one after the other, from the CRC-32 of each."""
    zeros = bytes(tail_bytes)
    return zlib.crc32(zeros, head) ^ zlib.crc32(zeros) ^ tail
