"""SimHash near-duplicates by Golay-code fuzzy hashing.

Two 64-bit fingerprints that differ in at most two bits agree in at least one of their three
segments, and differ in at most two bits in the next one.  A segment, taken as a word of the
binary Golay code of length 23, and every word one bit away decode to at most a few codewords;
of two segments at distance two the word half-way is next to both, so they share a codeword.
The exact segment together with each codeword index of the next is therefore a key that all
linked fingerprints have in common.

Fingerprints with equal keys are compared directly while they are few.  A key with more takes
another exact way: each of its fingerprints names the 65 words within one bit.  Those that name
the same word are at most 65 and all within two bits of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.support import arrow_map, lookup, release_encoders, rows_map, texts_of, unused
from termloom.session import settle

MAX_BITS = 2
SHINGLE_WORDS = 3
# Fingerprints of one key up to which they are compared pair by pair.
DIRECT = 16

_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def simhash(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a whole text; 0 if it has no word."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: A-Z, and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle_words, len(words)) - 1 :]
    spans = zip(starts[: len(last)].tolist(), last.tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, len(last))
    ones = np.zeros(64, dtype=np.int64)
    for part in np.split(hashes, range(1 << 16, len(hashes), 1 << 16)):
        table = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += table.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, version, fingerprint) of every text; a null text has no words.

    ``version`` is a hash of the text, which tells rows of one id apart.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("fingerprint", pa.int64())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        release_encoders()
        for doc_id, version, text in rows:
            value = simhash(text or "", shingle_words)
            yield doc_id, version, value - (1 << 64) if value >> 63 else value

    texts = texts_of(docs, id_column, text_column)
    return rows_map(texts.select("doc_id", F.xxhash64("text"), "text"), schema, make)


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The component of every document under links of at most ``max_bits`` differing bits.

    The component is named by its smallest id.  Repeated rows and copies share a fingerprint
    and so a component; rows without an id are linked like others but name no component unless
    it has no other row, when it is null.  An empty table gives no rows.

    Returns doc_id, version (a hash of the text), fingerprint (bigint), component_id and
    component (a fingerprint that names the component, as two of them may share a smallest id).
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("codewords are shared by words at most two bits apart")
    prints = settle(fingerprints(docs, shingle_words, id_column, text_column), "fingerprints")
    nodes = settle(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fingerprint"), max_bits))
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = members.join(nodes, F.col("node") == F.col("fingerprint")).select("node", "root", "first")
    smallest = named.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = named.select("node", "root").join(smallest, "root").select("node", "root", "smallest")
    component = nodes.join(linked, F.col("node") == F.col("fingerprint"), "left").select(
        "fingerprint",
        F.coalesce("smallest", "first").alias("component_id"),
        F.coalesce("root", "fingerprint").alias("component"),
    )
    return lookup(prints, settle(component, "component"), ["fingerprint"])


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` (doc_id, text and any others) with one row of every component of near duplicates.

    The row with the smallest id stays, of several with this id the one with the smallest hash
    of its text, then with the smallest other columns.  Rows of one id whose texts are unlike are
    in different components, so each of them has its say.  Rows without an id cannot be named
    and all stay.  An empty table stays empty.
    """
    found = settle(near_duplicates(docs, shingle_words, max_bits).filter("doc_id IS NOT NULL"), "components")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "version")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("_id"), F.col("first.version").alias("_version")).distinct()
    version = F.xxhash64(docs["text"])
    named = docs.join(first, (docs["doc_id"] == first["_id"]) & (version == first["_version"]), "left_semi")
    place = unused(docs, "_place")
    others = [F.col(name) for name, kind in docs.dtypes if name not in ("doc_id", "text") and "map<" not in kind]
    order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*(others or [F.lit(0)]))
    one = named.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)
    return one.unionByName(docs.filter(docs["doc_id"].isNull()))


def links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Enough links (a, b), a < b, between distinct fingerprints to join all that are linked.

    An empty table has none.
    """
    keys = _keys(nodes)
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settle(keys.join(sizes, "key"), "keys")
    few = shared.filter(F.col("n") <= DIRECT)
    left = few.select("key", F.col("fingerprint").alias("a"))
    right = few.select("key", F.col("fingerprint").alias("b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    direct = left.join(right, "key").filter((F.col("a") < F.col("b")) & (differing <= max_bits))
    direct = direct.select("a", "b")

    many = shared.filter(F.col("n") > DIRECT).select("fingerprint").distinct()
    bit = F.expr("shiftleft(1L, bit)")
    flipped = many.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    flipped = flipped.select(F.col("fingerprint").bitwiseXOR(bit).alias("point"), "fingerprint")
    points = flipped.unionByName(many.select(F.col("fingerprint").alias("point"), "fingerprint"))
    if max_bits == 2:
        around = points.groupBy("point").agg(F.collect_list("fingerprint").alias("near"))  # at most 65
        around = around.filter(F.size("near") > 1)
        star = around.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
        star = star.filter("a < b")
    else:  # one bit: a point that is itself a fingerprint
        star = flipped.join(many.select(F.col("fingerprint").alias("point")), "point")
        star = star.select(F.least("point", "fingerprint").alias("a"), F.greatest("point", "fingerprint").alias("b"))
        star = star.limit(0) if max_bits == 0 else star
    return direct.unionByName(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge and is not the smallest of its component.

    Edges (a, b) are rewired to smaller ends, by turns over larger and over smaller neighbours,
    until every node hangs on the smallest one.  Each round is a written table.  Repeated edges
    count once; without any edge there is no row.
    """
    edges = settle(edges.select(F.col("b").alias("node"), F.col("a").alias("root")), "edges")
    state = _digest(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("low"))
        least = least.select("node", F.least("node", "low").alias("low"))
        large = both.join(least, "node").filter("root > node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        large = settle(large.distinct(), "large-star")

        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node").filter("root > low").select(F.col("root").alias("node"), F.col("low").alias("root"))
        hung = low.select("node", F.col("low").alias("root"))
        edges = settle(small.unionByName(hung).distinct(), "small-star")
        before, state = state, _digest(edges)
        if state == before:
            break
    return edges


def _digest(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


# The Golay code ------------------------------------------------------------------------


def _keys(nodes: DataFrame) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("fingerprint", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy()
            for at in range(0, len(values), 4096):
                keys, places = golay_keys(values[at : at + 4096].view(np.uint64))
                yield [keys, values[at : at + 4096][places]]

    return arrow_map(nodes, schema, make)


def golay_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the fingerprints, and the place of the fingerprint that each belongs to."""
    parts = [(values >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in _SEGMENTS]
    keys, places = [], []
    for number, exact in enumerate(parts):
        following = (number + 1) % len(parts)
        flips = np.array([0, *(1 << bit for bit in range(_SEGMENTS[following][1]))])
        indices = np.sort(codeword_index(parts[following][:, None] ^ flips), axis=1)
        new = np.ones(indices.shape, dtype=bool)
        new[:, 1:] = indices[:, 1:] != indices[:, :-1]
        place, column = np.nonzero(new)
        keys.append(number << 40 | exact[place] << 12 | indices[place, column])
        places.append(place)
    return np.concatenate(keys), np.concatenate(places)


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the only codeword within three bits of each 23-bit word."""
    low, high, errors = _golay_tables()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[syndrome]) >> 11


@lru_cache(maxsize=1)
def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the lower 12 and the upper 11 bits, and the error of each syndrome."""
    rest = [1]  # x^n modulo the generator
    for _ in range(22):
        shifted = rest[-1] << 1
        rest.append(shifted ^ _GENERATOR if shifted >> 11 else shifted)

    def syndromes(powers: list[int]) -> np.ndarray:
        table = np.zeros(1, dtype=np.int64)
        for power in powers:
            table = np.concatenate([table, table ^ power])
        return table

    low, high = syndromes(rest[:12]), syndromes(rest[12:])
    errors = np.zeros(1 << 11, dtype=np.int64)
    bits = [1 << bit for bit in range(23)]
    for i in range(23):
        for j in range(i, 23):
            for k in range(j, 23):
                error = bits[i] | bits[j] | bits[k]
                errors[low[error & 0xFFF] ^ high[error >> 12]] = error
    return low, high, errors
