"""Entries of documents and postings of terms, worked out for an Arrow batch of documents at once.

Spark bounds its batches in rows and bytes; they are worked out by slices, which bounds the arrays in
between.  The functions are closures, so executors need numpy and pyarrow for them, but no module of
this package.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.folding import fold_letters
from termloom.functions.text import BLANK_CHARS, STOPWORDS

ENTRIES = "array<struct<term:string,tf:int,positions:array<int>>>"
COUNTS = "array<struct<term:string,tf:int>>"
BLOCKS = (
    "term string, first bigint, places bigint, "
    "docs array<struct<doc_id:bigint,tf:int,doc_terms:int,positions:array<int>>>"
)

# Bytes of text, or of a single longer text, that are worked out at once.
SLICE_BYTES = 16 << 20


def _sorting() -> Callable:
    """A function of keys below ``top`` that returns them in order, and the places they come from."""
    import numpy as np

    def in_order(key, top):
        bits = len(key).bit_length()
        if top >> (62 - bits):
            by = np.argsort(key, kind="stable")
            return key[by], by
        # One number for key and place; numbers alone are sorted several times as fast as places.
        packed = (key << bits) | np.arange(len(key))
        packed.sort()
        return packed >> bits, packed & ((1 << bits) - 1)

    return in_order


def _slicing() -> Callable:
    """A function of sizes that returns the ends of slices of at most ``most`` in all, or of one row."""
    import numpy as np

    def slices(sizes, most):
        ends, start = np.cumsum(sizes), 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + most, side="right")), start + 1)
            yield start, stop
            start = stop

    return slices


def _gathering() -> Callable:
    """A function of the rows, places and numbered names of tokens that returns each row's entries in
    order of term, and the sum of its squared counts."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    in_order = _sorting()

    def gather(row, place, code, names, n_rows):
        # Numbers in alphabetical order, so that rows and terms are sorted as one number.
        n_names = max(len(names), 1)
        order = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        key, by = in_order(row * n_names + rank[code], n_rows * n_names)  # the places of a row ascend already
        first = np.flatnonzero(np.diff(key, prepend=-1))
        tf = np.diff(first, append=len(key))
        of_row, term = np.divmod(key[first], n_names)
        bounds = np.searchsorted(of_row, np.arange(n_rows + 1))
        places = pa.ListArray.from_arrays(
            pa.array(np.append(first, len(key)), pa.int32()), pa.array(place[by], pa.int32())
        )
        terms = names.take(pa.array(order[term])).cast(pa.string())
        entries = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int32()), places], ["term", "tf", "positions"])
        squares = np.append(0, np.cumsum(tf * tf))
        return (
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), entries),
            pa.array(squares[bounds[1:]] - squares[bounds[:-1]], pa.int64()),
        )

    return gather


def _measuring() -> Callable:
    """A function of lists that returns how long each one is."""
    import numpy as np
    import pyarrow.compute as pc

    def lengths(lists):
        return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    return lengths


def text_entries(text: Column, spelled: bool = False) -> Column:
    """``total``, the number of tokens of a text, ``squares``, the sum of their squared counts, and ``entries``.

    The tokens are those of ``normalize_tokens``.  Letters are folded in Spark; of the result, ASCII is
    lowered and cut here, and words are told from stopwords once for a slice.  With ``spelled`` entries
    have no positions, and ``tokens`` are spelled out in order with a blank between.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    gather, lengths, slices, most = _gathering(), _measuring(), _slicing(), SLICE_BYTES
    small, large = bytes(range(97, 123)), bytes(range(65, 91))
    lower = bytes.maketrans(large, small)
    blanks = BLANK_CHARS.encode().decode("unicode_escape").encode()
    gone = bytes(sorted(set(range(256)) - set(small + large + blanks)))
    left_out = pa.array(["", *STOPWORDS])

    def of_slice(texts: pa.Array) -> pa.Array:
        plain = (None if raw is None else raw.translate(lower, gone) for raw in texts.to_pylist())
        words = pc.ascii_split_whitespace(pa.array(plain, pa.binary()).cast(pa.string()))
        coded = words.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        kept = ~pc.is_in(coded.dictionary, left_out).to_numpy(zero_copy_only=False)[code]
        row, code = np.repeat(np.arange(len(words)), lengths(words))[kept], code[kept]
        total = np.bincount(row, minlength=len(words))
        ends = np.cumsum(total)
        place = np.arange(len(row)) - np.repeat(ends - total, total)
        found, squares = gather(row, place, code, coded.dictionary, len(words))
        parts = {"total": pa.array(total, pa.int32()), "squares": squares, "entries": found}
        if spelled:
            rows = found.flatten()
            counts = pa.StructArray.from_arrays([rows.field("term"), rows.field("tf")], ["term", "tf"])
            parts["entries"] = pa.ListArray.from_arrays(found.offsets, counts)
            bounds = pa.array(np.append(0, ends), pa.int32())
            tokens = pa.ListArray.from_arrays(bounds, coded.dictionary.take(pa.array(code)))
            parts["tokens"] = pc.binary_join(tokens, " ")
        return pa.StructArray.from_arrays(list(parts.values()), list(parts))

    def entries(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.concat_arrays([of_slice(texts[a:b]) for a, b in slices(sizes, most)] or [of_slice(texts)])

    folded = fold_letters(text)
    # What is beyond ASCII may have a letter of ASCII as its lower case.
    ready = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.lower(folded))
    kind = f"struct<total:int,squares:bigint,entries:{ENTRIES}>"
    if spelled:
        kind = f"struct<total:int,squares:bigint,entries:{COUNTS},tokens:string>"
    # Deterministic, a filter on the result would work it out again.
    return F.arrow_udf(entries, kind).asNondeterministic()(ready)


def posting_blocks(parsed: DataFrame, frequent: list[str] | None = None) -> DataFrame:
    """Postings of ``(doc_id, tokens)`` by blocks: those of one term in the documents of one slice.

    ``first`` is the first document of a block, ``places`` the number of its positions.  Documents of a
    block are in order.  With ``frequent`` the terms are pairs of neighbours that are both among these,
    both words with a blank between; a pair stands where its first word does.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    in_order, lengths, slices, most = _sorting(), _measuring(), _slicing(), SLICE_BYTES
    chosen = None if frequent is None else pa.array(frequent, pa.string())

    def of_slice(ids: pa.Array, tokens: pa.Array) -> pa.RecordBatch:
        order = pc.sort_indices(ids)
        ids, words = ids.take(order), pc.split_pattern(tokens.take(order), " ")
        coded, total = words.flatten().dictionary_encode(), lengths(words)
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        row = np.repeat(np.arange(len(ids)), total)
        place = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
        if chosen is not None:
            often = pc.is_in(names, chosen).to_numpy(zero_copy_only=False)[code]
            here = np.flatnonzero(often[1:] & often[:-1] & (row[1:] == row[:-1]))
            n_names = max(len(names), 1)
            both, pair = np.unique(code[here] * n_names + code[here + 1], return_inverse=True)
            halves = (names.take(pa.array(half)) for half in np.divmod(both, n_names))
            names = pc.binary_join_element_wise(*halves, pa.scalar(" ", names.type))
            row, place, code = row[here], place[here], pair
        n_rows = max(len(ids), 1)
        key, by = in_order(code * n_rows + row, len(names) * n_rows)
        posting = np.flatnonzero(np.diff(key, prepend=-1))
        ends = np.append(posting, len(key))
        term, of_row = np.divmod(key[posting], n_rows)
        block = np.flatnonzero(np.diff(term, prepend=-1))
        bounds = np.append(block, len(posting))
        fields = {
            "doc_id": ids.take(pa.array(of_row)),
            "tf": pa.array(np.diff(ends), pa.int32()),
            "doc_terms": pa.array(total[of_row], pa.int32()),
            "positions": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[by], pa.int32())),
        }
        docs = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        columns = {
            "term": names.take(pa.array(term[block])).cast(pa.string()),
            "first": ids.take(pa.array(of_row[block])),
            "places": pa.array(np.diff(ends[bounds]), pa.int64()),
            "docs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), docs),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens = batch.column(0), batch.column(1).cast(pa.string())
            sizes = pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in slices(sizes, most):
                yield of_slice(ids[a:b], tokens[a:b])

    return parsed.select("doc_id", "tokens").mapInArrow(invert, BLOCKS)


def neighbour_entries(entries: Column) -> Column:
    """Entries of pairs of neighbours, both words with a blank between, of entries ``(term, positions)``.

    A pair stands where its first word does.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    gather, lengths = _gathering(), _measuring()

    def pairs(entries: pa.Array) -> pa.Array:
        per_row, rows = lengths(entries), entries.flatten()
        positions = rows.field("positions")
        per_entry = lengths(positions)
        coded = rows.field("term").dictionary_encode()
        row = np.repeat(np.repeat(np.arange(len(entries)), per_row), per_entry)
        code = np.repeat(coded.indices.to_numpy().astype(np.int64), per_entry)
        place = positions.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        by = np.lexsort((place, row))
        row, code, place = row[by], code[by], place[by]
        here = np.flatnonzero((row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1))
        n_terms = max(len(coded.dictionary), 1)
        both, pair = np.unique(code[here] * n_terms + code[here + 1], return_inverse=True)
        first, second = (coded.dictionary.take(pa.array(half)) for half in np.divmod(both, n_terms))
        names = pc.binary_join_element_wise(first, second, pa.scalar(" ", first.type))
        return gather(row[here], place[here], pair, names, len(entries))[0]

    return F.arrow_udf(pairs, ENTRIES)(entries)
