"""Divergence of the sources of a language, by a K-squared quadtree over group-term counts.

The counts of a language form a matrix: a row for each of its sources, a column for each kept
term.  The matrix is cut into square tiles; a tile is a tree of quadrants down to single cells,
stored level by level as one bit per quadrant, set if it holds a count above zero.

The divergence of two rows is a sum over all columns.  Columns where both are zero cost the same
each, so every column is priced at that first (``_baseline``).  Where one row is zero, all cells
of the other with equal price differ from that by the same amount (``_one_sided``).  Only columns
where both rows have a count are left: two trees of the same columns are descended jointly, and a
quadrant that either lacks is left at once (``_traverse``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from termloom.llm.support import arrow_map, lookup
from termloom.session import broadcast_if, measured, settle

# Documents of a language that must hold a term, and the terms reported of a group.
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
# Prices are shares of this.
SCALE = 1_000_000_000

SIDE_BITS = 10
SIDE = 1 << SIDE_BITS  # rows and columns of a tile
_ENTRIES = 400_000  # counts a task holds before it hands them on
_PIECE = 1 << 20  # bytes of a text that are cut into terms at a time
_CHUNK = 1 << 18  # pairs of quadrants looked at together

# Everything that is no part of a term becomes a blank, A-Z becomes lower case.
_BREAKS = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
_CLEAN = bytes.maketrans(_BREAKS + _UPPER, b" " * len(_BREAKS) + _UPPER.lower())


# Counts --------------------------------------------------------------------------------


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time."""
    clean, at = text.translate(_CLEAN), 0
    while at < len(clean):
        end = clean.find(b" ", at + _PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs) of a table (lang, source, text), summed up.

    A row with a null term stands for the group itself.
    """
    schema = pa.schema(
        [
            ("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
            ("n", pa.int64()), ("n_docs", pa.int64()),
        ]
    )

    def columns(groups: dict) -> list:
        rows = []
        for (lang, source), (total, held) in groups.items():
            rows.append((lang, source, None, 0, 0))
            rows += [(lang, source, term, n, held[term]) for term, n in total.items()]
        return list(map(list, zip(*rows, strict=True)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        groups, entries = {}, 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total, held = groups.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(total), set()
                for words in _terms(text):
                    total.update(words)
                    own.update(words)
                held.update(own)
                entries += len(total) - before
                if entries >= _ENTRIES:
                    yield columns(groups)
                    groups, entries = {}, 0
        if groups:
            yield columns(groups)

    counted = arrow_map(docs.select("lang", "source", F.col("text").cast("binary")), schema, make)
    summed = counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")
    )
    return summed.withColumn("term", F.col("term").cast("string"))


def price(n: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * n_terms)), exact however large the counts."""
    wide = (n.cast("decimal(19,0)") + 2) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, total.cast("decimal(19,0)") + n_terms * 2) + 1


def difference(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)); prices are so small that a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def price_cells(counted: DataFrame, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """Cells above zero of the kept terms, and the groups that make up the rows.

    cells: lang, source, row, term, n_docs (of the language), first (one cell of each term), p,
    zero (price of no occurrence) and q (the language's price).
    groups: lang, source, row, n_terms (kept by the language), zero.
    """
    of_term = Window.partitionBy("lang", "term")
    kept = counted.filter(F.col("term").isNotNull()).select(
        "lang", "source", "term", "n",
        F.sum("n_docs").over(of_term).alias("n_docs"),
        F.sum("n").over(of_term).alias("lang_n"),
        (F.min("source").over(of_term) == F.col("source")).alias("first"),
    )
    kept = settle(kept.filter(F.col("n_docs") >= least_documents), "kept-terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("int")).alias("firsts"))
    groups = counted.filter(F.col("term").isNull()).select("lang", "source")
    groups = groups.join(totals, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total",
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("row"),
        F.sum("firsts").over(of_lang).alias("n_terms"),
        F.sum("total").over(of_lang).alias("lang_total"),
    )
    zero = F.when(F.col("n_terms") > 0, price(F.lit(0), F.col("total"), F.col("n_terms"))).otherwise(1)
    groups = settle(groups.withColumn("zero", zero.cast("bigint")), "groups")

    cells = lookup(kept, groups, ["lang", "source"]).select(
        "lang", "source", "row", "term", "n_docs", "first", "n_terms", "zero",
        price(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
        price(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")).alias("q"),
    )
    return settle(cells, "cells"), groups.select("lang", "source", "row", "n_terms", "zero")


# Pairs of groups -----------------------------------------------------------------------


def _partners(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with every other group of their language as other, other_row, other_zero."""
    others = groups.select(
        F.col("lang").alias("_lang"), F.col("row").alias("other_row"), F.col("zero").alias("other_zero")
    )
    same = (F.col("lang") == F.col("_lang")) & (F.col("row") != F.col("other_row"))
    return rows.join(broadcast_if(others, measured(others)), same).drop("_lang")


def _ordered(value: Column) -> list[Column]:
    low, high = F.least("row", "other_row"), F.greatest("row", "other_row")
    return ["lang", low.alias("a"), high.alias("b"), value.alias("value")]


def _baseline(groups: DataFrame) -> DataFrame:
    """Every column at the price of two zeros, once for each pair."""
    pairs = _partners(groups, groups).filter("row < other_row")
    return pairs.select(*_ordered(F.col("n_terms") * difference(F.col("zero"), F.col("other_zero"))))


def _one_sided(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """What a group's cells add if the other group has zeros opposite them.

    Cells of equal price are counted first.
    """
    alike = cells.groupBy("lang", "row", "zero", "p").agg(F.count(F.lit(1)).alias("cells"))
    more = difference(F.col("p"), F.col("other_zero")) - difference(F.col("zero"), F.col("other_zero"))
    return _partners(alike, groups).select(*_ordered(F.col("cells") * more))


class QuadTree:
    """The cells above zero of one tile.

    ``bits`` has for each level, from the whole tile down, one number per quadrant that is not
    all zero: bit 2 * lower + right is set for each quarter that is not all zero either.
    ``prices`` has the cells in the order of the last level, ``zeros`` the price of no occurrence
    by row.
    """

    def __init__(self, bits: list[np.ndarray], prices: np.ndarray, zeros: np.ndarray):
        self.bits, self.prices, self.zeros = bits, prices, zeros
        sizes = [_ONES[level] for level in bits]
        self.starts = [np.cumsum(size) - size for size in sizes]

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, prices: np.ndarray, zeros: np.ndarray) -> QuadTree:
        code = np.zeros(len(rows), dtype=np.int64)
        for bit in range(SIDE_BITS):
            code |= ((cols >> bit & 1) | (rows >> bit & 1) << 1) << 2 * bit
        order = np.argsort(code)
        code, bits = code[order], []
        for _ in range(SIDE_BITS):
            parent, start = np.unique(code >> 2, return_index=True)
            bits.append(np.bitwise_or.reduceat(np.left_shift(1, code & 3), start).astype(np.uint8))
            code = parent
        return cls(bits[::-1], prices[order], zeros)

    def pack(self) -> bytes:
        sizes = np.array([len(level) for level in self.bits], dtype=np.int64)
        parts = [sizes, *self.bits, self.prices.astype(np.int64), self.zeros.astype(np.int64)]
        return b"".join(part.tobytes() for part in parts)

    @classmethod
    def unpack(cls, data: bytes) -> QuadTree:
        sizes = np.frombuffer(data, np.int64, SIDE_BITS)
        at, bits = sizes.nbytes, []
        for size in sizes.tolist():
            bits.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        numbers = np.frombuffer(data[at:], np.int64)
        return cls(bits, numbers[:-SIDE], numbers[-SIDE:])

    def quarter(self, level: int, nodes: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each node has the quarter, and its number on the next level."""
        bits = self.bits[level][nodes]
        return bits >> place & 1 == 1, self.starts[level][nodes] + _ONES[bits & (1 << place) - 1]


_ONES = np.array([i.bit_count() for i in range(16)], dtype=np.int64)


def _traverse(a: QuadTree, b: QuadTree, total: np.ndarray, same: bool) -> None:
    """Add to ``total`` what the columns add in which both a row of ``a`` and one of ``b`` have
    a count, beyond what the two one-sided prices say.  ``same`` if both are one tile, of which
    each pair of rows is taken once.

    Pairs of quadrants wait on a stack in chunks, so that only a few of them are held at a time.
    """
    root = np.zeros(1, dtype=np.int64)
    waiting = [(0, root, root, root, root)]
    while waiting:
        level, x, y, x_row, y_row = waiting.pop()
        if len(x) > _CHUNK:
            waiting.append((level, x[_CHUNK:], y[_CHUNK:], x_row[_CHUNK:], y_row[_CHUNK:]))
            x, y, x_row, y_row = (part[:_CHUNK] for part in (x, y, x_row, y_row))
        if level == SIDE_BITS:
            p, q, p0, q0 = a.prices[x], b.prices[y], a.zeros[x_row], b.zeros[y_row]
            more = _difference(p, q) - _difference(p, q0) - _difference(p0, q) + _difference(p0, q0)
            np.add.at(total, (x_row, y_row), more)
            continue
        parts = []
        for right in (0, 1):
            for upper in (0, 1):
                for lower in (0, 1):
                    has_x, next_x = a.quarter(level, x, 2 * upper + right)
                    has_y, next_y = b.quarter(level, y, 2 * lower + right)
                    both = has_x & has_y
                    if same and upper >= lower:
                        # A quadrant meets itself: the upper half with the lower one, once, and
                        # both halves with themselves until they are single cells.
                        itself = x == y
                        both &= ~itself if upper > lower or level == SIDE_BITS - 1 else True
                    if both.any():
                        parts.append(
                            (next_x[both], next_y[both], 2 * x_row[both] + upper, 2 * y_row[both] + lower)
                        )
        if parts:
            waiting.append((level + 1, *map(np.concatenate, zip(*parts, strict=True))))


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def build_tiles(cells: DataFrame) -> DataFrame:
    """(lang, block, band, tree): the tiles that are not all zero.

    Columns of a language are dealt to blocks by a hash of the term, frequent terms first in
    each, so that the zeros of rare terms lie together.
    """
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("n_terms") / (SIDE // 2))).cast("int")
    terms = cells.filter("first").select("lang", "term", "n_docs", block.alias("block"))
    by_use = Window.partitionBy("lang", "block").orderBy(F.col("n_docs").desc(), "term")
    terms = terms.withColumn("col", F.row_number().over(by_use) - 1)
    # A block that drew more than SIDE terms goes on in further blocks.
    terms = terms.select(
        "lang", "term", "block", F.floor(F.col("col") / SIDE).cast("int").alias("more"), (F.col("col") % SIDE).alias("col")
    )
    placed = cells.join(terms, ["lang", "term"]).select(
        "lang", "block", "more", F.floor(F.col("row") / SIDE).cast("int").alias("band"),
        (F.col("row") % SIDE).alias("row"), "col", "p", "zero",
    )
    schema = pa.schema(
        [("lang", pa.string()), ("block", pa.int32()), ("more", pa.int32()), ("band", pa.int32()), ("tree", pa.binary())]
    )

    def build(table: pa.Table) -> pa.Table:
        rows, cols, prices, zero = (table[name].to_numpy() for name in ("row", "col", "p", "zero"))
        zeros = np.zeros(SIDE, dtype=np.int64)
        zeros[rows] = zero
        tree = QuadTree.of(rows.astype(np.int64), cols.astype(np.int64), prices, zeros)
        own = {name: [table[name][0].as_py()] for name in schema.names[:-1]}
        return pa.table({**own, "tree": [tree.pack()]}, schema=schema)

    groups = placed.groupBy("lang", "block", "more", "band")
    return groups.applyInArrow(build, from_arrow_schema(schema))


def _both_sided(tiles: DataFrame) -> DataFrame:
    """What columns with a count in both groups of a pair add to the one-sided prices.

    Each task adds up its tiles before it hands sums on.
    """
    left = tiles.withColumnsRenamed({"band": "left_band", "tree": "left"})
    right = tiles.withColumnsRenamed({"band": "right_band", "tree": "right"})
    pairs = left.join(right, ["lang", "block", "more"]).filter("left_band <= right_band")
    # Each pair of tiles is read by one task; a language's many blocks spread over all.
    pairs = pairs.select("lang", "left_band", "right_band", "left", "right")
    schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])

    def columns(totals: dict) -> Iterator[list]:
        for (lang, low, high), total in totals.items():
            a, b = np.nonzero(total)
            yield [[lang] * len(a), a + low * SIDE, b + high * SIDE, total[a, b]]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        totals = {}
        for batch in batches:
            for lang, low, high, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = lang, low, high
                if key not in totals and len(totals) == 8:  # 8 MB each
                    yield from columns(totals)
                    totals = {}
                total = totals.setdefault(key, np.zeros((SIDE, SIDE), dtype=np.int64))
                _traverse(QuadTree.unpack(a), QuadTree.unpack(b), total, low == high)
        yield from columns(totals)

    return arrow_map(pairs, schema, make)


def group_divergence(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the summed difference of each pair of rows, a below b."""
    tiles = settle(build_tiles(cells), "tiles")
    parts = _baseline(groups).unionByName(_one_sided(cells, groups)).unionByName(_both_sided(tiles))
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


# Audit ---------------------------------------------------------------------------------


def audit_sources(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """How the sources of each language differ, exactly.

    Terms are runs of ASCII letters and of all characters beyond ASCII, A-Z lowered; a language
    keeps those that ``least_documents`` of its rows hold.  The price of a term in a group is
    1 + floor(SCALE * (n + 2) / (N + 2 * V)) for n occurrences of N, with V kept terms, and two
    prices p, q differ by floor((p - q)^2 / (p + q)).

    Part ``pair`` has the sum over all kept terms for every two groups of a language (0 without
    kept terms), part ``term`` the ``top_terms`` terms of each group that are dearer there than
    in the whole language.  Nulls read as ''; repeated rows are documents of their own; texts of
    any length are read in pieces; ties go by item; an empty table gives no rows.

    Returns lang, source, part, item, value, rank.
    """
    names = {"lang": lang_column, "source": source_column, "text": text_column}
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in names.items()))
    counted = settle(count_terms(texts), "term-counts")
    cells, groups = price_cells(counted, least_documents)

    sums = group_divergence(cells, groups)
    both = sums.select("lang", F.col("a").alias("row"), F.col("b").alias("other"), "value").unionByName(
        sums.select("lang", F.col("b").alias("row"), F.col("a").alias("other"), "value")
    )
    sources = groups.select("lang", "row", "source")
    items = groups.select("lang", F.col("row").alias("other"), F.col("source").alias("item"))
    named = lookup(lookup(both, sources, ["lang", "row"]), items, ["lang", "other"])
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    dearer = cells.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        difference(F.col("p"), F.col("q")).alias("value"),
    )
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(best).alias("rank")
    return pairs.select("*", rank).unionByName(
        dearer.select("*", rank).filter(F.col("rank") <= top_terms)
    )
