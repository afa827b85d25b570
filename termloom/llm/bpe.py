"""Byte-level BPE of whole texts, long ones by tree concatenation.

A long text is halved until its parts are short; the parts are encoded in parallel, and the ids
of neighbouring parts are joined level by level.  A join re-encodes a window of tokens around
the cut and widens it until its first token is the left part's token there and its last one the
right part's.  BPE ids are right exactly if each two neighbours are, and a part's pieces run on
alike once a piece ends at the same place, so the joined ids then equal those of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.encoding import ByteEncoder, byte_encoder
from termloom.llm.support import rows_map, texts_of
from termloom.session import settle

LEAF_CHARS = 32_768
# Tokens on each side of a cut that are encoded anew at first.
WINDOW = 32


def encode_documents(
    docs: DataFrame,
    tokenizer: str,
    leaf_chars: int = LEAF_CHARS,
    decoded: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Ids of every whole text as the library gives them without added special tokens.

    With ``decoded`` the ids are decoded again, by the same worker that made them.

    A null text is encoded as an empty one, which has no ids.  Repeated rows are returned as
    often as they occur; an empty table gives no rows.

    Returns doc_id, ids (little-endian unsigned 32-bit numbers) and, if asked for, decoded.
    """
    texts = texts_of(docs, id_column, text_column)
    texts = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.char_length("text") > leaf_chars
    columns = ["doc_id", "ids", "decoded"][: 3 if decoded else 2]
    kinds = [pa.int64(), pa.binary(), pa.string()]
    schema = pa.schema(list(zip(columns, kinds)))

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = byte_encoder(tokenizer)
        for doc_id, text in rows:
            ids = encoder.encode(text)
            yield (doc_id, ids, encoder.decode(ids)) if decoded else (doc_id, ids)

    short = rows_map(texts.filter(~is_long), schema, make)
    # A long text is known by its digest, so copies of it are encoded once.
    long = texts.filter(is_long).withColumn("content", F.sha2("text", 256))
    joined = _encode_long(long, tokenizer, leaf_chars)
    found = long.select("doc_id", "content").join(joined, "content").select("doc_id", "ids")
    return short.unionByName(decode_documents(found, tokenizer) if decoded else found)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Texts of (doc_id, ids) as the library decodes them, special tokens kept."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = byte_encoder(tokenizer)
        for doc_id, ids in rows:
            yield doc_id, ids, encoder.decode(ids)

    return rows_map(encoded.select("doc_id", "ids"), schema, make)


def _encode_long(long: DataFrame, tokenizer: str, leaf_chars: int) -> DataFrame:
    """(content, ids) of each distinct long text."""
    parts = pa.schema([("content", pa.string()), ("depth", pa.int32()), ("node", pa.int64()), ("text", pa.string())])
    nodes = pa.schema([("content", pa.string()), ("depth", pa.int32()), ("node", pa.int64()), ("ids", pa.binary())])

    def halve(rows: Iterator[tuple]) -> Iterator[tuple]:
        for content, text in rows:
            depth = 0
            while len(text) > leaf_chars << depth:
                depth += 1
            cuts = [len(text) * i >> depth for i in range((1 << depth) + 1)]
            for node, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                yield content, depth, node, text[a:b]

    def encode(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = byte_encoder(tokenizer)
        for content, depth, node, text in rows:
            yield content, depth, node, encoder.encode(text)

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = byte_encoder(tokenizer)
        for content, depth, node, left, right in rows:
            yield content, depth, node, join_ids(encoder, left, right)

    distinct = long.groupBy("content").agg(F.first("text").alias("text"))
    leaves = rows_map(distinct, parts, halve).repartition("content", "node")
    level = settle(rows_map(leaves, nodes, encode), "leaves")
    deepest = level.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest):  # a text of n leaves takes log2(n) rounds
        done = level.filter("depth = 0")
        open_nodes = level.filter("depth > 0").withColumn("parent", F.shiftright("node", 1))
        odd = F.col("node") % 2 == 1
        left = open_nodes.filter(~odd).select("content", "depth", "parent", F.col("ids").alias("left"))
        right = open_nodes.filter(odd).select("content", "parent", F.col("ids").alias("right"))
        pairs = left.join(right, ["content", "parent"]).select(
            "content", (F.col("depth") - 1).alias("depth"), "parent", "left", "right"
        )
        level = settle(done.unionByName(rows_map(pairs, nodes, join)), "level")
    return level.select("content", "ids")


def join_ids(encoder: ByteEncoder, left: bytes, right: bytes, window: int = WINDOW) -> bytes:
    """Ids of two texts one after the other, from the ids of each."""
    if not left or not right:
        return left + right
    window = max(window, encoder.special_chars)  # or a special token could go unseen in the cut
    a, b = memoryview(left).cast("I"), memoryview(right).cast("I")

    def splits_character(token: int) -> bool:
        return encoder.token_bytes[token][0] & 0xC0 == 0x80

    while True:
        i, j = max(0, len(a) - window), min(len(b), window)
        while i and splits_character(a[i]):
            i -= 1
        while j < len(b) and splits_character(b[j]):
            j += 1
        text = encoder.decode(left[4 * i :] + right[: 4 * j])
        # How a run of blanks is cut depends on what follows, so no window ends in one.
        if j == len(b) or not text[-1:].isspace():
            joint = encoder.encode_whole(text)
            tokens = memoryview(joint).cast("I")
            if (i == 0 or tokens[0] == a[i]) and (j == len(b) or tokens[-1] == b[j - 1]):
                return left[: 4 * i] + joint + right[4 * j :]
        window *= 2
