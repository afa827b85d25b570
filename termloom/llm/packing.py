"""Best-fit packing by exact-complement hashing.

Documents are encoded and cut into pieces of at most ``capacity`` tokens.  How to combine
pieces depends on their lengths alone, of which there are at most ``capacity``, so the plan is
made from the number of pieces of each length and is bounded by ``capacity``, not by the corpus.
Pieces then look up their place in the plan by length and by their number among the pieces of
that length, which is counted per task and needs no large group.

The plan takes lengths from the longest down.  The gap that a length leaves is looked up among
the sums of one, two and three lengths that are still available; each hit is used as often as
the counts allow.  What finds no exact complement is packed best-fit, longest first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.encoding import id_bytes, word_encoder
from termloom.llm.support import arrow_map, rows_map, texts_of
from termloom.session import settle

CAPACITY = 4096

# Chunks that a packing task remembers by default.
MEMO_CHUNKS = 600_000

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()),
        ("place", pa.int64()),
    ]
)
_PACKED = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    memo_chunks: int = MEMO_CHUNKS,
) -> DataFrame:
    """Place every document in sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a vocabulary with word ends.  A null or empty text is its end
    id alone.  A worker remembers the ids of ``memo_chunks`` chunks of text; fewer take less memory
    and more time.  Documents longer than ``capacity`` are cut; the last piece may be shorter.
    Repeated rows are packed as often as they occur; an empty table gives no rows.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    pieces = settle(_pieces(texts_of(docs, id_column, text_column), tokenizer, capacity, end_id, memo_chunks), "pieces")
    tallies = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per length reaches the driver.
    counts = {row["length"]: row["n"] for row in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    numbered = pieces.join(tallies.select("length", "part", first), ["length", "part"]).select(
        *_PIECES.names[:5], (F.col("first") + F.col("place")).alias("number")
    )
    return _assign(numbered, plan_sequences(counts, capacity))


def _pieces(texts: DataFrame, tokenizer: str, capacity: int, end_id: int, memo_chunks: int) -> DataFrame:
    end = id_bytes([end_id])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = word_encoder(tokenizer, memo_chunks)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}  # pieces so far by length
        for doc_id, text in rows:
            ids = encoder.encode(text or "") + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                length = len(own) // 4
                place = seen.get(length, 0)
                seen[length] = place + 1
                yield doc_id, piece, at // 4, length, zlib.crc32(own), part, place

    return rows_map(texts, _PIECES, make)


def _assign(numbered: DataFrame, plan: list[tuple]) -> DataFrame:
    """Look up the place of each piece; ``plan`` has a bounded number of rows."""
    rows = np.array(sorted(plan), dtype=np.int64).reshape(-1, 6)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            length, number = (batch.column(name).to_numpy() for name in ("length", "number"))
            at = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                low, high = np.searchsorted(rows[:, 0], [value, value + 1])
                own = length == value
                at[own] = low - 1 + np.searchsorted(rows[low:high, 1], number[own], side="right")
            _, first, per_sequence, sequence, offset, _ = rows[at].T
            places = number - first
            yield [
                *(batch.column(name) for name in _PIECES.names[:5]),
                sequence + places // per_sequence,
                offset + length * (places % per_sequence),
            ]

    return arrow_map(numbered, _PACKED, make)


# The plan ------------------------------------------------------------------------------


@dataclass
class _Supply:
    """Pieces still available by length, and the rows of the plan so far.

    A row is (length, first number, pieces per sequence, first sequence, offset, sequences).
    """

    counts: np.ndarray
    used: np.ndarray = field(init=False)
    rows: list[tuple] = field(default_factory=list)
    sequences: int = 0

    def __post_init__(self):
        self.used = np.zeros_like(self.counts)

    def fills(self, lengths: tuple[int, ...]) -> int:
        """How many sequences the lengths can fill together."""
        return min(int(self.counts[n]) // lengths.count(n) for n in set(lengths))

    def emit(self, pattern: list[tuple[int, int]], times: int) -> None:
        """Use ``times`` sequences that each hold (length, how many) one after the other."""
        offset = 0
        for length, many in pattern:
            self.rows.append((length, int(self.used[length]), many, self.sequences, offset, times))
            self.used[length] += many * times
            offset += length * many
        self.sequences += times


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple]:
    """Plan rows for ``counts`` pieces of each length."""
    supply = _Supply(np.zeros(capacity + 1, dtype=np.int64))
    for length, n in counts.items():
        supply.counts[length] = n
    _fill_exactly(supply, capacity)
    _fit_best(supply, capacity)
    return supply.rows


def _fill_exactly(supply: _Supply, capacity: int) -> None:
    for length in range(capacity, 0, -1):
        if not supply.counts[length]:
            continue
        sums = _sums(supply.counts)
        while supply.counts[length]:
            filling = next(_complements(supply, length, capacity - length, *sums), None)
            if filling is None:
                break
            lengths = (length, *filling)
            times = supply.fills(lengths)
            for n in lengths:
                supply.counts[n] -= times
            supply.emit([(n, 1) for n in lengths], times)


def _sums(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sums two and three available lengths reach.

    Counts only fall, so an index made earlier never misses a sum.
    """
    there = (counts > 0).astype(float)
    size = 4 * len(there)
    single = np.fft.rfft(there, size)
    pairs = np.fft.irfft(single**2, size) > 0.5
    # Sums of a third length and a sum of two; ones again, so that rounding stays far from a half.
    triples = np.fft.irfft(np.fft.rfft(pairs.astype(float), size) * single, size) > 0.5
    return pairs, triples


def _complements(
    supply: _Supply, length: int, gap: int, pairs: np.ndarray, triples: np.ndarray
) -> Iterator[tuple[int, ...]]:
    """Available combinations of no, one, two or three lengths that fill ``gap`` exactly."""
    counts = supply.counts

    def pairs_of(total: int, most: int) -> Iterator[tuple[int, int]]:
        larger = np.arange(min(total - 1, most), (total + 1) // 2 - 1, -1)
        for a in larger[(counts[larger] > 0) & (counts[total - larger] > 0)].tolist():
            yield a, total - a

    if gap == 0:
        yield ()
        return
    if supply.fills((length, gap)):
        yield (gap,)
    for pair in pairs_of(gap, length) if pairs[gap] else ():
        if supply.fills((length, *pair)):
            yield pair
    if not triples[gap]:
        return
    largest = np.arange(min(gap - 2, length), (gap + 2) // 3 - 1, -1)
    for a in largest[(counts[largest] > 0) & pairs[gap - largest]].tolist():
        for pair in pairs_of(gap - a, a):
            if supply.fills((length, a, *pair)):
                yield a, *pair


def _fit_best(supply: _Supply, capacity: int) -> None:
    """Best fit for the rest, longest first; open sequences of one pattern stay together."""
    gaps: list[int] = []
    opened: dict[int, list[tuple[list, int]]] = {}

    def keep(pattern: list[tuple[int, int]], gap: int, times: int) -> None:
        if gap not in opened:
            opened[gap] = []
            insort(gaps, gap)
        opened[gap].append((pattern, times))

    for length in range(capacity, 0, -1):
        left = int(supply.counts[length])
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                many = capacity // length
                if left >= many:
                    keep([(length, many)], capacity - many * length, left // many)
                if left % many:
                    keep([(length, left % many)], capacity - left % many * length, 1)
                break
            gap = gaps[at]
            pattern, times = opened[gap].pop()
            now = min(times, left)
            if times > now:
                opened[gap].append((pattern, times - now))
            elif not opened[gap]:
                del opened[gap]
                gaps.pop(at)
            keep([*pattern, (length, 1)], gap - length, now)
            left -= now
        supply.counts[length] = 0
    for groups in opened.values():
        for pattern, times in groups:
            supply.emit(pattern, times)
