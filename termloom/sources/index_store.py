"""Stored index: plain Parquet tables, each partitioned by the batch that wrote its rows.

Layout under the root folder, every table with ``batch=<n>`` first::

    documents                      documents in order of id
    entries                        parsed documents with tokens; each one's terms and their counts are read again
    terms                          counters of a term, or changes of them
    postings/bits=<b>/bucket=<k>   each file sorted by term, then by blocks of documents
    pairs/bits=<b>/bucket=<k>      postings of neighbouring frequent terms
    pair_counts                    documents of each such pair
    grams, gram_counts             letter grams of the dictionary, and how many terms have each
    frequent                       terms whose neighbours are stored as pairs, of a base only
    replaced                       ids of documents of earlier batches that are gone
    batches                        one row for a batch that is complete, written last

A batch writes its own partitions and nothing else.  Readers take the batches from the last
``base`` on, a batch that holds everything, add the counters up and leave replaced documents out.
A batch without its row in ``batches`` does not count; writing it again overwrites its partitions.
One writer at a time feeds a root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.runs import posting_blocks
from termloom.operators.indexing import (
    DOCUMENT_COLUMNS,
    POSTING_COLUMNS,
    TERM_COLUMNS,
    SearchIndex,
    StoredTables,
    bucket_of,
    document_rows,
    frequent_pairs,
    parse_corpus,
    term_rows,
)
from termloom.operators.maintenance import entries_of, replaced_documents, term_deltas
from termloom.operators.matching import term_grams
from termloom.session import broadcast_if, measured, scratch_path, settle

# One posting bucket, and one sorted part of the postings, per this many tokens.
TOKENS_PER_BUCKET = 2_000_000
# A term is frequent from this share of all tokens on, so there are at most this many.
FREQUENT_TERMS = 500
# Parts of a bucket at least, over which blocks of more than so many places are dealt.
PARTS_OF_BUCKET = 4
PLACES_TO_DEAL = 1_000

SCHEMAS = {
    "documents": (
        "doc_id bigint, filename string, doc_key string, filepath string, snippet string, "
        "total_terms int, doc_magnitude double, uploaded_at timestamp"
    ),
    "entries": "doc_id bigint, entries array<struct<term:string,tf:int>>",
    "spelled": "doc_id bigint, doc_key string, total_terms int, tokens string",
    "terms": "term string, df bigint, cf bigint",
    "postings": (
        "doc_id bigint, term string, tf int, doc_terms int, positions array<int>, bits int, bucket int"
    ),
    "pairs": "doc_id bigint, term string, positions array<int>, bits int, bucket int",
    "pair_counts": "term string, df bigint",
    "grams": "gram string, term string",
    "gram_counts": "gram string, n bigint",
    "frequent": "term string",
    "replaced": "doc_id bigint",
    "batches": "base bigint, bits int, next_doc_id bigint, stream string, batch_id bigint",
}


@dataclass(frozen=True)
class Version:
    """The batches that make up the index, and what is to be known before a search."""

    base: int
    last: int
    next_doc_id: int
    layouts: list[int]


# Reading -------------------------------------------------------------------------------


def _table(spark: SparkSession, root: str, table: str, columns: str | None = None) -> DataFrame:
    """A table with its columns, or those of another name in ``SCHEMAS``."""
    reader = spark.read.schema(f"{SCHEMAS[columns or table]}, batch bigint")
    return reader.option("basePath", f"{root.rstrip('/')}/{table}").parquet(f"{root.rstrip('/')}/{table}")


def _batches(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return _table(spark, root, "batches")
    except AnalysisException as error:  # the folder does not exist yet
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The batches that count, or None if there is no index yet; one row whatever their number."""
    batches = _batches(spark, root)
    if batches is None:
        return None
    # Layouts of batches before the base do no harm: they name buckets that hold nothing.
    facts = batches.agg(
        F.max("base"), F.max("batch"), F.max("next_doc_id"), F.sort_array(F.collect_set("bits"))
    ).first()
    return None if facts[0] is None else Version(*facts)


def last_batch(spark: SparkSession, root: str, stream: str) -> int:
    """Number of the last batch of a stream that counts, -1 before the first."""
    batches = _batches(spark, root)
    if batches is None:
        return -1
    last = batches.filter(F.col("stream") == stream).agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def _open(spark: SparkSession, root: str, version: Version) -> SearchIndex:
    def read(table: str, first: int = version.base, columns: str | None = None) -> DataFrame:
        rows = _table(spark, root, table, columns)
        return rows.filter(F.col("batch").between(first, version.last)).drop("batch")

    names = ("documents", "entries", "terms", "postings", "pairs", "pair_counts", "grams", "gram_counts")
    frequent = _table(spark, root, "frequent").filter(F.col("batch") == version.base)
    frequent = [row[0] for row in frequent.select("term").collect()]  # at most FREQUENT_TERMS
    replaced = None
    if version.last > version.base:  # the base replaces nothing
        replaced = read("replaced", version.base + 1)
        replaced = broadcast_if(replaced, measured(replaced))
    spelled = read("entries", columns="spelled")
    stored = StoredTables(*map(read, names), version.layouts, frequent, replaced, spelled)
    terms = stored.terms
    if replaced is not None:
        terms = terms.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")
    return SearchIndex(
        stored.live(stored.documents),
        terms,
        stored.live(stored.postings.select(*POSTING_COLUMNS)),
        stored.live(stored.entries),
        stored,
    )


def load_index(spark: SparkSession, root: str) -> SearchIndex:
    """Open the index under ``root``."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no index under {root}")
    return _open(spark, root, version)


# Writing -------------------------------------------------------------------------------


def _write(df: DataFrame, root: str, table: str, batch: int, *by: str) -> None:
    """Overwrite one batch of a table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writer.partitionBy(*by).parquet(f"{root.rstrip('/')}/{table}/batch={batch}")


def _layout(tokens: int) -> int:
    """Bits of the term's hash that number the buckets of a batch."""
    return (-(-tokens // TOKENS_PER_BUCKET) - 1).bit_length() if tokens else 0


def _write_buckets(rows: DataFrame, root: str, table: str, batch: int, tokens: int) -> None:
    """Range partitioning on (bucket, term, doc_id) spreads the postings of a frequent term
    over as many tasks as they need."""
    bits, order = _layout(tokens), ["bucket", "term", "doc_id"]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TOKENS_PER_BUCKET))
    rows = rows.select("*", bucket_of(F.col("term"), F.lit(bits)).alias("bucket"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    _write(rows.withColumn("bits", F.lit(bits)), root, table, batch, "bits", "bucket")


def _write_blocks(blocks: DataFrame, root: str, table: str, batch: int, tokens: int, columns: list[str]) -> None:
    """Write postings that come by blocks into buckets, of which each part is one sorted file.

    Only blocks are shuffled and sorted, and no pass of their own finds ranges.  A term is in one
    part of its bucket, but for its large blocks, which are dealt over all parts.
    """
    bits, conf = _layout(tokens), blocks.sparkSession.conf
    n_parts = max(int(conf.get("spark.sql.shuffle.partitions")), -(-tokens // TOKENS_PER_BUCKET))
    n_parts = max(PARTS_OF_BUCKET, -(-n_parts >> bits))
    large = F.col("places") > PLACES_TO_DEAL
    # The lowest bits of the term's hash number its bucket.
    dealt = F.when(large, F.xxhash64("term", "first")).otherwise(F.shiftright(F.xxhash64("term"), 32))
    blocks = blocks.select("*", bucket_of(F.col("term"), F.lit(bits)).alias("bucket"))
    part = (F.col("bucket") * n_parts + F.pmod(dealt, F.lit(n_parts))).cast("int")
    blocks = blocks.repartitionById(n_parts << bits, part).sortWithinPartitions("term", "first")
    rows = blocks.select("term", F.lit(bits).alias("bits"), "bucket", F.inline("docs"))
    # A part has one bucket, so its writer needs no rows in order of bucket, for which all would be sorted.
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, 1)
    try:
        _write(rows.select(*columns, "bits", "bucket"), root, table, batch, "bits", "bucket")
    finally:
        conf.set(name, before)


def _write_words(terms: DataFrame, root: str, batch: int) -> None:
    """Counters of a batch, and the grams of the terms it adds to."""
    _write(terms.select(*TERM_COLUMNS).repartitionByRange("term").sortWithinPartitions("term"), root, "terms", batch)
    written = _table(terms.sparkSession, root, "terms").filter((F.col("batch") == batch) & (F.col("df") > 0))
    # Cut and sorted where the terms are: searches read all grams, and only rows of the wanted ones travel.
    _write(term_grams(written.select("term")).sortWithinPartitions("gram", "term"), root, "grams", batch)
    written = _table(terms.sparkSession, root, "grams").filter(F.col("batch") == batch)
    counts = written.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    _write(counts.coalesce(1), root, "gram_counts", batch)


def _write_pair_counts(spark: SparkSession, root: str, batch: int) -> None:
    written = _table(spark, root, "pairs").filter(F.col("batch") == batch)
    counts = written.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    _write(counts, root, "pair_counts", batch)


def _write_pairs(parsed: DataFrame, frequent: list[str], root: str, batch: int, tokens: int) -> None:
    blocks = posting_blocks(parsed, frequent)
    _write_blocks(blocks, root, "pairs", batch, tokens, ["doc_id", "term", "positions"])
    _write_pair_counts(parsed.sparkSession, root, batch)


def _finish(
    spark: SparkSession, root: str, batch: int, base: int, tokens: int, next_doc_id: int,
    stream: str | None = None, batch_id: int | None = None,
) -> SearchIndex:
    """Make a written batch count."""
    row = [(base, _layout(tokens), next_doc_id, stream, batch_id)]
    _write(spark.createDataFrame(row, SCHEMAS["batches"]).coalesce(1), root, "batches", batch)
    return _open(spark, root, current_version(spark, root))


def _write_parsed(docs: DataFrame, root: str, batch: int, after: int = -1) -> DataFrame:
    """Parse documents straight into the batch's entries, from which its other tables are made."""

    def keep(parsed: DataFrame) -> DataFrame:
        rows = parsed.select(*DOCUMENT_COLUMNS, "entries", "tokens")
        _write(rows, root, "entries", batch)
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{root.rstrip('/')}/entries/batch={batch}")

    return parse_corpus(docs, after, keep, spelled=True)


def index_corpus(
    docs: DataFrame, root: str, stream: str | None = None, batch_id: int | None = None
) -> SearchIndex:
    """Index ``docs`` straight into a stored index.

    The parsed documents are written once, so each text is tokenised once although the
    documents, the postings and the pairs come from it.
    """
    previous = current_version(docs.sparkSession, root)
    parsed = _write_parsed(docs, root, previous.last + 1 if previous else 1)
    return _save(SearchIndex(document_rows(parsed), None, None), root, previous, parsed, stream, batch_id)


def save_index(
    index: SearchIndex, root: str, stream: str | None = None, batch_id: int | None = None
) -> SearchIndex:
    """Store a whole index as a new base under ``root`` and return it.

    Without a terms table the dictionary is counted from the stored postings.
    """
    return _save(index, root, current_version(index.documents.sparkSession, root), None, stream, batch_id)


def _save(
    index: SearchIndex, root: str, previous: Version | None, parsed: DataFrame | None,
    stream: str | None, batch_id: int | None,
) -> SearchIndex:
    """``parsed`` are the documents with their entries and tokens, if these are written already; else
    they are gathered from the postings."""
    spark = index.documents.sparkSession
    batch = previous.last + 1 if previous else 1

    def written(table: str) -> DataFrame:
        return _table(spark, root, table).filter(F.col("batch") == batch)

    _write(index.documents.select(*DOCUMENT_COLUMNS), root, "documents", batch)
    tokens, next_doc_id = written("documents").agg(
        F.coalesce(F.sum("total_terms"), F.lit(0)), F.coalesce(F.max("doc_id") + 1, F.lit(0))
    ).first()
    if parsed is None:
        _write_buckets(index.postings.select(*POSTING_COLUMNS), root, "postings", batch, tokens)
        entries = index.entries
        if entries is None:  # of one document, so bounded by it
            entries = index.postings.groupBy("doc_id").agg(F.collect_list(F.struct("term", "tf")).alias("entries"))
        _write(entries.select("doc_id", "entries"), root, "entries", batch)
    else:
        _write_blocks(posting_blocks(parsed), root, "postings", batch, tokens, POSTING_COLUMNS)
    terms = index.terms
    if terms is None:
        terms = term_rows(written("postings").select("term", "tf"))
    _write_words(terms, root, batch)

    frequent = written("terms").filter(F.col("cf") * FREQUENT_TERMS >= tokens).select("term")
    _write(frequent.coalesce(1), root, "frequent", batch)
    words = [row[0] for row in written("frequent").select("term").collect()]
    if parsed is None:
        of_document = written("postings").filter(F.col("term").isin(words)).groupBy("doc_id")
        gathered = of_document.agg(F.collect_list(F.struct("term", "positions")).alias("entries"))
        # Written first, as ranges are found by a pass of their own: pairs are few, but dear to work out.
        _write_buckets(settle(frequent_pairs(gathered, words), "pairs"), root, "pairs", batch, tokens)
        _write_pair_counts(spark, root, batch)
    else:
        _write_pairs(parsed, words, root, batch, tokens)
    next_doc_id = max(next_doc_id, previous.next_doc_id if previous else 0)
    return _finish(spark, root, batch, batch, tokens, next_doc_id, stream, batch_id)


def add_batch(
    spark: SparkSession, root: str, batch: DataFrame, stream: str | None = None, batch_id: int | None = None
) -> SearchIndex:
    """Add or replace the batch's documents in the index under ``root``.

    Only the batch's own partitions are written.  Columns: filename, text, seq (the order of
    arrival) and optionally filepath; all documents get new ids.
    """
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no index under {root}")
    index, number = _open(spark, root, version), version.last + 1
    parsed = _write_parsed(required_columns(batch), root, number, version.next_doc_id - 1)
    keys = parsed.select("doc_key")
    replaced = settle(replaced_documents(index, broadcast_if(keys, measured(keys))), "replaced")
    _write(replaced, root, "replaced", number)
    _write(document_rows(parsed), root, "documents", number)
    tokens, last_id = parsed.agg(F.coalesce(F.sum("total_terms"), F.lit(0)), F.max("doc_id")).first()
    _write_blocks(posting_blocks(parsed), root, "postings", number, tokens, POSTING_COLUMNS)
    if index.stored.frequent:
        _write_pairs(parsed, index.stored.frequent, root, number, tokens)
    added = parsed.select(F.inline("entries"))
    removed = entries_of(index, replaced).select(F.inline("entries"))
    deltas = term_deltas(added, 1).unionByName(term_deltas(removed, -1))
    summed = deltas.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    # A term may gain one document and lose another; its grams are needed all the same.
    _write_words(summed.filter("df <> 0 OR cf <> 0"), root, number)
    next_doc_id = version.next_doc_id if last_id is None else last_id + 1
    return _finish(spark, root, number, version.base, tokens, next_doc_id, stream, batch_id)


def required_columns(batch: DataFrame) -> DataFrame:
    """The batch without ids of its own; it must say in which order its rows arrived."""
    if "seq" not in batch.columns:
        raise ValueError("a batch needs a column seq, the order of arrival")
    return batch.drop("doc_id")


def compact(spark: SparkSession, root: str) -> SearchIndex:
    """Store the index anew as one base, without replaced documents and with its own buckets and
    frequent terms.  Partitions of earlier batches may then be deleted."""
    return save_index(load_index(spark, root), root)


# Once per application ------------------------------------------------------------------


def source_fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of the files under ``path`` by name, size and time; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    digest = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    return str(files.agg(digest).first()[0])


_opened: dict[tuple[str, str, str], SearchIndex] = {}


def index_once(spark: SparkSession, path: str, docs: DataFrame) -> SearchIndex:
    """Index the documents stored at ``path`` once per application and reuse the result.

    The index lives in the shared folder and is built anew when the files change.
    """
    key = (spark.sparkContext.applicationId, path, source_fingerprint(spark, path))
    if key not in _opened:
        _opened[key] = index_corpus(docs, scratch_path(spark, "index"))
    return _opened[key]
