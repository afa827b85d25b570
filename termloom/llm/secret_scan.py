"""Secret scans with corpus-wide ownership frequency.

Base patterns find assignments, access keys and hex runs.  The method adds what they miss: any
other string that mixes letters and digits like a token.  Every found value is known by its
digest, and for each digest the distinct repositories and owners that hold it are counted over
the corpus.  A repository is a distinct text, so exact copies count once, under one owner.  A
value that several owners or many repositories hold is a copied example; any other is taken for
a live credential.  The bar for candidates is low, as the counts decide: host names and version
strings are found in many places.  Base spans stay whatever the count says.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.support import lookup, rows_map, unused
from termloom.session import settle

# Distinct owners from which on a value counts as a widely copied example.
EXAMPLE_OWNERS = 3
# Distinct texts from which on it counts as one even if one owner holds them all.
EXAMPLE_REPOSITORIES = 10
# Bits of entropy per character from which on a string without a name may be a token.
RANDOM_BITS = 2.5

# The base patterns.
_ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_LEAST_ASSIGN, _LEAST_ACCESS = 12, 18
_NAMES = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "owned")

_LOOSE = re.compile(r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*[0-9])[A-Za-z0-9+/_.=-]{12,}")

_SPAN = pa.struct(
    [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.binary())]
)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the base patterns by start, then kind; code points."""
    spans = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= _LEAST_ASSIGN:
                spans.append((0, *match.span(), match[2]))
    for match in _ACCESS.finditer(text):
        if len(match[0]) >= _LEAST_ACCESS:
            spans.append((1, *match.span(), match[0]))
    spans += [(2, *match.span(), match[0]) for match in _HEX.finditer(text)]
    return sorted(spans, key=lambda span: (span[1], span[0]))


def loose_spans(text: str, base: list[tuple]) -> Iterator[tuple[int, int, int, str]]:
    """Token-like strings that overlap no base span."""
    starts = [span[1] for span in base]
    reach = list(accumulate((span[2] for span in base), max))
    for match in _LOOSE.finditer(text):
        value, (start, end) = match[0], match.span()
        before = bisect_left(starts, end)
        if looks_random(value) and not (before and reach[before - 1] > start):
            yield 3, start, end, value


def looks_random(value: str) -> bool:
    """Letters and digits mixed, with at least RANDOM_BITS of entropy per character."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= RANDOM_BITS


def find_candidates(
    docs: DataFrame, id_column: str, owner_column: str, text_column: str
) -> DataFrame:
    """(row, doc_id, version, owner, found): the spans of every text, written out.

    ``row`` tells repeated rows apart; ``version`` is a hash of the text.
    """
    schema = pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()),
            ("owner", pa.string()), ("found", pa.list_(_SPAN)),
        ]
    )
    texts = docs.select(
        F.col(id_column).cast("bigint"), F.xxhash64(text_column), F.col(owner_column).cast("string"),
        F.col(text_column),
    )

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 40
        for place, (doc_id, version, owner, text) in enumerate(rows):
            base = base_spans(text or "")
            spans = [*base, *loose_spans(text or "", base)]
            found = [
                {"kind": kind, "start": start, "end": end, "digest": hashlib.sha256(value.encode()).digest()}
                for kind, start, end, value in spans
            ]
            yield first + place, doc_id, version, owner, found

    return settle(rows_map(texts, schema, make), "candidates")


def ownership(candidates: DataFrame) -> DataFrame:
    """(digest, n_repositories, n_owners): each distinct text is a repository of one owner."""
    held = candidates.select(
        F.explode("found.digest").alias("digest"), F.col("version").alias("repository"), "owner"
    )
    # Distinct pairs first, so that a value held everywhere is counted by many tasks.
    pairs = held.groupBy("digest", "repository").agg(F.min("owner").alias("owner"))
    per_owner = pairs.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("digest").agg(
        F.sum("n").alias("n_repositories"), F.count("owner").alias("n_owners")
    )


def scan_secrets(
    docs: DataFrame,
    example_owners: int = EXAMPLE_OWNERS,
    id_column: str = "doc_id",
    owner_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """Spans of secrets in every whole text.

    Base spans are always reported; other token-like strings only if they are no example: fewer
    than ``example_owners`` owners and EXAMPLE_REPOSITORIES distinct texts hold the value.  A null text is empty; a null owner is no owner.  Repeated rows are
    reported as often as they occur, an empty table gives no rows.

    Returns doc_id and spans: array of (kind, start, end, n_repositories, n_owners, is_example),
    by start, then kind in the order of KINDS.
    """
    candidates = find_candidates(docs, id_column, owner_column, text_column)
    spans = _judged(candidates, example_owners)
    span = F.struct("start", "kind", "end", "n_repositories", "n_owners", "is_example")
    grouped = spans.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return candidates.select("row", "doc_id").join(grouped, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(grouped.schema["spans"].dataType)).alias("spans")
    )


def _judged(candidates: DataFrame, example_owners: int) -> DataFrame:
    """One row per span with its counts; strings without a name only if they are no example."""
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    counts = settle(ownership(candidates).withColumn("is_example", copied), "ownership")
    spans = lookup(candidates.select("row", "doc_id", "version", F.inline("found")), counts, ["digest"])
    return spans.filter((F.col("kind") < 3) | ~F.col("is_example"))


def redact_secrets(
    docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` (doc_id, text, source, n_chars and any others) with ``mark`` in place of every
    span that is not a widely copied example.

    A null text stays null; repeated rows are treated alike, rows of one id by their own text; an
    empty table stays empty.
    """
    spans = _judged(find_candidates(docs, "doc_id", "source", "text"), example_owners)
    name = unused(docs, "_spans")
    found = spans.filter(~F.col("is_example")).groupBy("doc_id", "version").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias(name)
    )
    found = found.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), name)
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_version"])
    joined = docs.join(found, same, "left").select(docs["*"], found[name])
    places = {name: docs.columns.index(name) for name in ("text", "n_chars")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, spans = batch.columns[:-1], batch.column(batch.num_columns - 1).to_pylist()
            texts, sizes = (columns[place].to_pylist() for place in places.values())
            for i, own in enumerate(spans):
                if own:
                    texts[i] = redacted(texts[i], [(span["start"], span["end"]) for span in own], mark)
                    sizes[i] = len(texts[i])
            for place, values in zip(places.values(), (texts, sizes), strict=True):
                columns[place] = pa.array(values, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)


def redacted(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with ``mark`` for each run of overlapping spans, which come in order."""
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])
