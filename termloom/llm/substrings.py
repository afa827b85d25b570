"""Substring deduplication by level-wise doubling.

First level, half the length (rounded down): of the half-windows inside each full window the one
with the smallest hash is its anchor.  Equal windows have equal anchors, so only anchors that
occur in two documents survive, a small part of all positions, and no repeated window is lost.

Second level, the full length, twice the first (and one word more if it is odd): a surviving anchor is extended to the words around it, as far as
any full window with that anchor reaches (its context).  Documents that share a context share
all of these windows, and the first of them stands for all.  Only where one anchor has several
contexts are the windows themselves compared, once for each context, not for each copy.

Windows that are compared between documents are told apart by 128 bits, and so are anchors with
their contexts; which words of a document go is then found by 64 bits among its own windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.support import arrow_map, mix64, powers, rows_map, texts_of, unused
from termloom.session import settle

WINDOW_WORDS = 50

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordWindows:
    """Hashes of all windows of one text."""

    def __init__(self, text: str | None, length: int):
        from xxhash import xxh64_intdigest

        self.words = (text or "").encode().split()
        self.length, self.half = length, length // 2
        n = len(self.words)
        hashes = np.fromiter(map(xxh64_intdigest, self.words), np.uint64, n)
        self.sums, self.shifts = [], []
        for base in _BASES:
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(hashes * powers(base, n), out=sums[1:])
            self.sums.append(sums)
            self.shifts.append(powers(pow(base, -1, 1 << 64), n + 1))

    def spans(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the words from ``starts`` to ``ends``."""
        sums = self.sums[which]
        return mix64((sums[ends] - sums[starts]) * self.shifts[which][starts])

    def windows(self, starts: np.ndarray, which: int = 0) -> np.ndarray:
        return self.spans(starts, starts + self.length, which)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and context of every anchor."""
        n, half = len(self.words), self.half
        if n < self.length:
            none = np.zeros(0, dtype=np.int64)
            return none, none.view(np.uint64), none.view(np.uint64)
        starts = np.arange(n - half + 1)
        hashes = self.spans(starts, starts + half)
        reach = self.length - half + 1  # half-windows in a window
        least = _sliding(hashes, reach, np.minimum)
        padded = np.pad(least, reach - 1)
        starts = np.flatnonzero(_sliding(padded, reach, np.maximum) == hashes)
        left = np.maximum(starts - (self.length - half), 0)
        right = np.minimum(starts + self.length, n)
        shape = ((starts - left) << 32 | (right - starts)).astype(np.uint64)
        return starts, hashes[starts], mix64(self.spans(left, right, 1) ^ mix64(shape))

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that contain one of the given anchors."""
        marks = np.zeros(len(self.words) - self.length + 2, dtype=np.int64)
        np.add.at(marks, np.maximum(anchors - (self.length - self.half), 0), 1)
        np.add.at(marks, np.minimum(anchors + 1, len(marks) - 1), -1)
        return np.flatnonzero(np.cumsum(marks)[:-1])

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """Which words the windows at ``starts`` cover."""
        marks = np.zeros(len(self.words) + 1, dtype=np.int64)
        marks[starts] += 1
        np.subtract.at(marks, starts + self.length, 1)
        return np.cumsum(marks)[:-1] > 0


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) of each ``width`` neighbouring values."""
    n, step, best = len(values) - width + 1, 1, values
    while 2 * step <= width:
        best = choose(best[:-step], best[step:])
        step *= 2
    return choose(best[:n], best[width - step : width - step + n])


def remove_repeats(
    docs: DataFrame,
    length: int = WINDOW_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Remove words covered by a window of ``length`` words that also starts in a document with
    a smaller id.

    Words are what stands between ASCII blanks.  Windows are judged on the input.  A null text
    has no words.  Rows of one id are each judged against smaller ids only; a null id is neither
    smaller than another nor larger.  An empty table gives no rows.

    Returns doc_id, n_words, n_removed and kept (the words left, joined by one space).
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    texts = texts_of(docs, id_column, text_column)
    marks = _marks(texts, length)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, contexts, windows in rows:
            kept, n_removed = _without(text, contexts, windows, length)
            yield doc_id, len(kept) + n_removed, n_removed, b" ".join(kept).decode()

    return rows_map(texts.join(marks, "doc_id", "left").select("doc_id", "text", "contexts", "windows"), schema, make)


def drop_repeats(docs: DataFrame, length: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, n_chars and any others) without the words that
    :func:`remove_repeats` removes.

    Texts that lose nothing stay as they are; those that lose all their words go.
    """
    marks = _marks(texts_of(docs), length)
    name = unused(docs, "_marks")
    marks = marks.select(F.col("doc_id").alias("_id"), F.struct("contexts", "windows").alias(name))
    joined = docs.join(marks, docs["doc_id"] == marks["_id"], "left").select(docs["*"], marks[name])
    places = {name: docs.columns.index(name) for name in ("text", "n_chars")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, marks = batch.columns[:-1], batch.column(batch.num_columns - 1).to_pylist()
            texts, sizes = (columns[place].to_pylist() for place in places.values())
            keep = [True] * len(texts)
            for i, mark in enumerate(marks):
                if mark is None:
                    continue
                kept, n_removed = _without(texts[i], mark["contexts"], mark["windows"], length)
                if n_removed:
                    texts[i] = b" ".join(kept).decode()
                    sizes[i] = len(texts[i])
                    keep[i] = bool(kept)
            for place, values in zip(places.values(), (texts, sizes), strict=True):
                columns[place] = pa.array(values, columns[place].type)
            changed = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
            yield changed.filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, docs.schema)


def _without(text: str | None, contexts: list, windows: list, length: int) -> tuple[list[bytes], int]:
    """The words left of a text, and how many are removed."""
    if not contexts and not windows:
        return (text or "").encode().split(), 0
    own = WordWindows(text, length)
    if len(own.words) < length:  # a row of the same id but another text
        return own.words, 0
    starts, _, found = own.anchors()
    shared = own.around(starts[np.isin(found.view(np.int64), contexts or [])])
    if windows:
        every = np.arange(len(own.words) - length + 1)
        again = np.isin(own.windows(every).view(np.int64), windows)
        shared = np.union1d(shared, every[again])
    removed = own.covered(shared)
    kept = [word for word, gone in zip(own.words, removed.tolist(), strict=True) if not gone]
    return kept, len(own.words) - len(kept)


def _marks(texts: DataFrame, length: int) -> DataFrame:
    """Per document the contexts and the windows that a smaller id has too."""
    found = settle(_anchors(texts, length), "anchors")
    repeated = found.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    repeated = repeated.filter("low < high").select("anchor")
    live = settle(found.join(repeated, "anchor"), "survivors")

    contexts = settle(live.groupBy("anchor", "context").agg(F.min("doc_id").alias("holder")), "contexts")
    shared = live.join(contexts, ["anchor", "context"]).filter("holder < doc_id")
    shared = shared.select("doc_id", F.col("context").alias("whole"), F.lit(None).cast("bigint").alias("window"))

    varied = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    compared = contexts.join(varied, "anchor").groupBy("holder").agg(F.collect_list("context").alias("contexts"))
    windows = settle(_windows(texts.join(compared, F.col("doc_id") == F.col("holder")), length), "windows")
    firsts = windows.groupBy("window", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    firsts = firsts.filter("low < high").select("window", "check", "low")
    later = windows.join(firsts, ["window", "check"]).filter("low < doc_id")
    later = later.select("doc_id", F.lit(None).cast("bigint").alias("whole"), "window")

    return shared.unionByName(later).groupBy("doc_id").agg(
        F.collect_set("whole").alias("contexts"), F.collect_set("window").alias("windows")
    )


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, anchor, context), each once per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("anchor", pa.int64()), ("context", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            gathered: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, anchors, contexts = WordWindows(text, length).anchors()
                contexts, at = np.unique(contexts, return_index=True)
                if doc_id is not None and len(at):
                    gathered.append((np.full(len(at), doc_id), anchors[at], contexts))
                if len(gathered) == 256:
                    yield _columns(gathered)
                    gathered = []
            if gathered:
                yield _columns(gathered)

    return arrow_map(texts, schema, make)


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, window, check): both hashes of the windows around the given contexts."""
    schema = pa.schema([("doc_id", pa.int64()), ("window", pa.int64()), ("check", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for doc_id, text, contexts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = WordWindows(text, length)
                if len(own.words) < length:
                    continue
                starts, _, found = own.anchors()
                at = own.around(starts[np.isin(found.view(np.int64), contexts)])
                hashes, first = np.unique(own.windows(at), return_index=True)
                yield _columns([(np.full(len(first), doc_id), hashes, own.windows(at[first], 1))])

    return arrow_map(texts.select("doc_id", "text", "contexts"), schema, make)


def _columns(gathered: list[tuple]) -> list[pa.Array]:
    return [pa.array(np.concatenate(column).view(np.int64)) for column in zip(*gathered, strict=True)]
