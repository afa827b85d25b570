"""Building the index: documents, terms and postings.

A document is one row, so its terms, counts and positions are worked out from that row alone,
for an Arrow batch of documents at once: sort the tokens' numbers, find where each run of equal ones
starts, cut the runs.  Tokens are never shuffled; only the finished postings are, when the index is
stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.runs import neighbour_entries, text_entries
from termloom.functions.text import snippet
from termloom.session import broadcast_if, hold, measured, settle, spread
from termloom.sources.corpus import assign_doc_ids, document_key

DOCUMENT_COLUMNS = [
    "doc_id", "filename", "doc_key", "filepath", "snippet",
    "total_terms", "doc_magnitude", "uploaded_at",
]
TERM_COLUMNS = ["term", "df", "cf"]
POSTING_COLUMNS = ["doc_id", "term", "tf", "doc_terms", "positions"]


@dataclass(frozen=True)
class StoredTables:
    """The tables of a stored index as they are, with rows of documents that were replaced.

    ``layouts`` are the numbers of hash bits by which batches number their buckets, ``frequent``
    the terms whose neighbours are stored as pairs, ``replaced`` the ids that do not count any
    more, None if there are none.  ``spelled`` are documents with their key and tokens, which are null
    where a batch was made from postings.
    """

    documents: DataFrame
    entries: DataFrame
    terms: DataFrame
    postings: DataFrame
    pairs: DataFrame
    pair_counts: DataFrame
    grams: DataFrame
    gram_counts: DataFrame
    layouts: list[int]
    frequent: list[str]
    replaced: DataFrame | None
    spelled: DataFrame

    def live(self, rows: DataFrame) -> DataFrame:
        """``rows`` without those of replaced documents, an id of which occurs once.

        An anti-join would be moved below the join that ``rows`` may come from, to all postings.
        """
        if self.replaced is None:
            return rows
        gone = self.replaced.withColumn("_gone", F.lit(True))
        return rows.join(gone, "doc_id", "left").filter(F.col("_gone").isNull()).select(*rows.columns)


@dataclass(frozen=True)
class SearchIndex:
    """The three tables of an index.

    ``postings`` repeats the document's token count as ``doc_terms`` so that scoring needs no
    join with ``documents``.  A stored index also has ``entries``, the terms and counts of each
    document by its id, from which counters are taken back, and its tables as they are ``stored``:
    searches look terms up there and leave replaced documents out of the few rows they find.
    ``parsed`` has the same postings by document, ``(doc_id, doc_key, total_terms, entries)``, if they
    are at hand.
    """

    documents: DataFrame
    terms: DataFrame
    postings: DataFrame
    entries: DataFrame | None = None
    stored: StoredTables | None = None
    parsed: DataFrame | None = None

    @property
    def described(self) -> DataFrame:
        """Documents by id, for ids that are known to count."""
        return self.stored.documents if self.stored else self.documents


def parse_documents(docs: DataFrame, spelled: bool = False) -> DataFrame:
    """Tokenise documents and gather their entries; documents without tokens are dropped.

    Adds doc_key, snippet, total_terms, doc_magnitude and
    ``entries array<struct<term, tf, positions>>`` and removes the text.  With ``spelled`` entries have
    no positions, and ``tokens`` are spelled out in order, which takes far less to write.
    """
    docs = docs.filter(F.col("text").isNotNull())
    if "filepath" not in docs.columns:
        docs = docs.withColumn("filepath", F.lit(None).cast("string"))
    docs = docs.withColumn("doc_key", document_key(F.col("filename")))
    docs = docs.withColumn("snippet", snippet(F.col("text")))
    if "seq" in docs.columns:  # tells versions of equal rank apart, whole texts compared
        docs = docs.withColumn("text_hash", F.sha2("text", 256))
    kept = [name for name in docs.columns if name != "text"]

    docs = docs.select(*kept, text_entries(F.col("text"), spelled).alias("found")).filter("found.total > 0")
    total = F.col("found.total")
    return docs.select(
        *kept,
        total.alias("total_terms"),
        (F.sqrt(F.col("found.squares").cast("double")) / total).alias("doc_magnitude"),
        F.col("found.entries").alias("entries"),
        *([F.col("found.tokens").alias("tokens")] if spelled else []),
    )


def frequent_pairs(parsed: DataFrame, frequent: list[str]) -> DataFrame:
    """Postings of neighbouring frequent terms: ``(doc_id, term, positions)``.

    ``term`` is both words with a blank between, ``positions`` are those of the first.  ``parsed``
    has doc_id and entries; documents are worked out within their row.
    """
    chosen = F.filter("entries", lambda e: e["term"].isin(frequent))
    docs = hold(parsed.select("doc_id", "entries"), "chosen", chosen, ["doc_id"])
    docs = docs.filter(F.size("chosen") > 0).select("doc_id", neighbour_entries(F.col("chosen")).alias("pairs"))
    return docs.select("doc_id", F.inline("pairs")).select("doc_id", "term", "positions")


def latest_versions(docs: DataFrame, spelled: bool = False) -> DataFrame:
    """Parsed documents, of each ``doc_key`` only the valid version with the highest ``seq``.

    Versions of equal ``seq`` are ordered by a hash of their whole text, then by path.  Only
    keys are compared: the parsed rows are written once, and the losing versions, usually few,
    are taken out of them.  ``row`` is the number that each was written with.
    """
    numbered = parse_documents(spread(docs), spelled).withColumn("row", F.monotonically_increasing_id())
    parsed = settle(numbered, "versions")
    newest = Window.partitionBy("doc_key").orderBy(
        F.col("seq").desc(), F.col("text_hash").desc(), F.col("filepath").desc(), "row"
    )
    order = parsed.select("row", "doc_key", "seq", "text_hash", "filepath")
    losers = order.withColumn("place", F.row_number().over(newest)).filter("place > 1").select("row")
    losers = settle(losers, "losers")
    winners = parsed.join(broadcast_if(losers, measured(losers)), "row", "left_anti")
    return winners.drop("seq", "text_hash")


def parse_corpus(
    docs: DataFrame, after: int = -1, keep: Callable[[DataFrame], DataFrame] = settle, spelled: bool = False
) -> DataFrame:
    """Parsed documents with ids, written out once, by ``keep`` if it is given, which returns them as written.

    With a ``seq`` column, the order of arrival, several versions of a document may come.
    Missing ids are given above ``after``.  The time of the load is fixed here.
    """
    docs = docs.withColumn("uploaded_at", F.current_timestamp())
    if "seq" not in docs.columns:
        parsed = parse_documents(spread(docs), spelled)
        return keep(parsed) if "doc_id" in parsed.columns else assign_doc_ids(parsed, after, keep)
    versions = latest_versions(docs, spelled)
    if "doc_id" not in versions.columns:
        versions = versions.select((F.col("row") + F.lit(after + 1)).alias("doc_id"), "*")
    # Versions are written with their numbers already; nothing is gained by writing them again.
    return versions.drop("row") if keep is settle else keep(versions.drop("row"))


def document_rows(parsed: DataFrame) -> DataFrame:
    """The ``documents`` table of parsed documents."""
    return parsed.select(*DOCUMENT_COLUMNS)


def document_entries(parsed: DataFrame) -> DataFrame:
    """Terms and counts of parsed documents, one row per document, without positions."""
    counts = F.transform("entries", lambda e: F.struct(e["term"].alias("term"), e["tf"].alias("tf")))
    return parsed.select("doc_id", counts.alias("entries"))


def posting_rows(parsed: DataFrame) -> DataFrame:
    """The ``postings`` table of parsed documents, one row per document and term."""
    rows = parsed.select("doc_id", "total_terms", F.inline("entries"))
    return rows.select(
        "doc_id", "term", "tf", F.col("total_terms").alias("doc_terms"), "positions"
    )


def spelled_documents(index: SearchIndex) -> DataFrame | None:
    """``(doc_id, doc_key, total_terms, entries)`` of a stored index, with positions, from its tokens.

    None if there are documents without stored tokens.  Tokens are words of a-z, and cutting them again
    gives the same ones.
    """
    if not index.stored or index.stored.spelled.filter(F.col("tokens").isNull()).limit(1).count():
        return None
    docs = index.stored.live(index.stored.spelled)
    docs = docs.select("doc_id", "doc_key", "total_terms", text_entries(F.col("tokens")).alias("found"))
    return docs.select("doc_id", "doc_key", "total_terms", F.col("found.entries").alias("entries"))


def keyed_postings(index: SearchIndex) -> DataFrame:
    """Postings with the key of their document: ``(doc_key, term, tf, positions)``.

    Where postings are at hand by document, they need not be moved to the documents: only keys of
    ids that several documents share, usually few, are looked up.
    """
    columns = ["doc_key", "term", "tf", "positions"]
    keys = index.documents.select("doc_id", "doc_key")
    if index.parsed is None:
        return index.postings.join(keys, "doc_id").select(*columns)
    shared = keys.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    shared = settle(keys.join(shared, "doc_id", "left_semi"), "shared-ids")
    shared = broadcast_if(shared, measured(shared)).withColumnRenamed("doc_key", "other_key")
    docs = index.parsed.filter(F.col("doc_id").isNotNull())
    docs = docs.join(shared.withColumn("is_shared", F.lit(True)), "doc_id", "left")
    key = F.when(F.col("is_shared"), F.col("other_key")).otherwise(F.col("doc_key"))
    return docs.select(key.alias("doc_key"), F.inline("entries")).select(*columns)


def term_rows(postings: DataFrame) -> DataFrame:
    """The dictionary: document frequency and collection frequency per term."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum(F.col("tf").cast("bigint")).alias("cf")
    )


def build_index(docs: DataFrame) -> SearchIndex:
    """Index ``docs`` without storing the index.

    Columns: filename, text and optionally doc_id, filepath and seq.
    """
    parsed = parse_corpus(docs)
    postings = posting_rows(parsed)
    return SearchIndex(document_rows(parsed), term_rows(postings), postings)


def corpus_size(index: SearchIndex) -> DataFrame:
    """One row with the number of indexed documents."""
    counted = index.described.select(F.lit(1).cast("bigint").alias("n"))
    if index.stored and index.stored.replaced is not None:
        # Every replaced id is a stored document, so nothing needs to be joined.
        counted = counted.unionByName(index.stored.replaced.select(F.lit(-1).cast("bigint").alias("n")))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_docs"))


def document_ids(index: SearchIndex) -> DataFrame:
    """All document ids, the universe of a negation."""
    return index.documents.select("doc_id")


def known_terms(index: SearchIndex, words: DataFrame) -> DataFrame:
    """Dictionary rows (term, df) of some words.

    In a stored index the counters of several batches are added up for these words only.
    """
    if not index.stored:
        return index.terms.join(words, "term").select("term", "df")
    found = index.stored.terms.join(words, "term")
    return found.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")


def bucket_of(term: Column, bits: Column) -> Column:
    """Number of a term's bucket: the lowest bits of its hash."""
    return F.pmod(F.xxhash64(term), F.pow(F.lit(2), bits).cast("bigint")).cast("int")


def probe_postings(
    index: SearchIndex, terms: DataFrame, columns: list[str], only: list[str] | None = None
) -> DataFrame:
    """Join rows that have a ``term`` with the postings of that term.

    On a stored index the join also runs on the bucket, so that the partitions without any
    wanted term are pruned while the query runs, and replaced documents are left out of what
    was found.  ``only`` names the terms if they are known to be few; the files, sorted by term,
    are then read only where these are.
    """
    if not index.stored:
        return index.postings.select("term", *columns).join(terms, "term")
    return _probe(index.stored, index.stored.postings, terms, columns, only)


def probe_pairs(
    index: SearchIndex, pairs: DataFrame, columns: list[str], only: list[str] | None = None
) -> DataFrame:
    """:func:`probe_postings` for pairs of frequent terms, with both words as ``term``."""
    return _probe(index.stored, index.stored.pairs, pairs, columns, only)


def _probe(
    stored: StoredTables, table: DataFrame, terms: DataFrame, columns: list[str], only: list[str] | None
) -> DataFrame:
    if only is not None:
        table = table.filter(F.col("term").isin(only))
    keyed = terms.filter(F.col("term") > "").withColumn("bits", F.explode(F.array(*map(F.lit, stored.layouts))))
    keyed = keyed.withColumn("bucket", bucket_of(F.col("term"), F.col("bits")))
    rows = table.select("bits", "bucket", "term", *columns)
    return stored.live(rows.join(keyed, ["bits", "bucket", "term"]).drop("bits", "bucket"))
