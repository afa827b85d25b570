"""Leaf matching: which documents hold a term, a pattern or a phrase.

Leaves come as a table ``(query_id, leaf_id, kind, value)`` and hits go out as
``(query_id, leaf_id, doc_id)``, so one query or a million take the same plan.  Equal values
are looked up once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom import session
from termloom.operators.indexing import SearchIndex, corpus_size, known_terms, probe_pairs, probe_postings
from termloom.session import Size, broadcast_if, bytes_of, hold, measured, settle

HIT_COLUMNS = ["query_id", "leaf_id", "doc_id"]

# Hits of which one task works out at most so many, if every document had every value.
HITS_PER_TASK = 16 << 20

# Letters of a gram, by which patterns are looked up in the dictionary, and what fills up the last.
GRAM_LENGTH = 3
PADDING = "$"
# Terms of phrases up to which the files are searched for them by name; with more the answer is
# the same.
LITERAL_TERMS = 200


def deal_by_document(index: SearchIndex, rows: DataFrame, n_asked: int) -> DataFrame:
    """Shuffle rows by ``doc_id``, to as many tasks as ``n_asked`` hits of each document ask for."""
    most = n_asked * corpus_size(index).first()[0]
    if most <= HITS_PER_TASK:
        return rows.repartition("doc_id")
    n_parts = int(index.documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(n_parts, -(-most // HITS_PER_TASK)), "doc_id")


def leaf_values(leaves: DataFrame, kind: str) -> DataFrame:
    """Distinct non-empty-leaf values of one kind."""
    wanted = (F.col("kind") == kind) & F.col("value").isNotNull()
    return leaves.filter(wanted).select("value").distinct()


def _of_leaves(leaves: DataFrame, kind: str, found: DataFrame, size: Size) -> DataFrame:
    """Turn (value, doc_id) into hits of every leaf of that kind and value."""
    wanted = leaves.filter(F.col("kind") == kind).select("query_id", "leaf_id", "value")
    return found.join(broadcast_if(wanted, size), "value").select(*HIT_COLUMNS)


# Terms ---------------------------------------------------------------------------------


def match_terms(index: SearchIndex, leaves: DataFrame, size: Size | None = None) -> DataFrame:
    """Hits of the term leaves: documents that contain exactly that term.

    ``size``, here and below, is the size of the leaves if the caller knows it.
    """
    size = leaf_size(leaves) if size is None else size
    wanted = leaves.filter((F.col("kind") == "term") & F.col("value").isNotNull())
    wanted = wanted.select("query_id", "leaf_id", F.col("value").alias("term"))
    return probe_postings(index, broadcast_if(wanted, size), ["doc_id"]).select(*HIT_COLUMNS)


def term_documents(index: SearchIndex, term: str) -> DataFrame:
    """Documents of one literal term; the comparison is pushed down to the files."""
    if not index.stored:
        return index.postings.filter(F.col("term") == term).select("doc_id")
    return index.stored.live(index.stored.postings.filter(F.col("term") == term).select("doc_id"))


def leaf_size(leaves: DataFrame) -> Size:
    """Rows and text of the leaves, to decide about broadcasts."""
    return measured(leaves.select("query_id", "leaf_id", "value"))


# Patterns ------------------------------------------------------------------------------


def clean_pattern(value: Column) -> Column:
    """Resolve escapes; null for patterns that no term can match.

    Terms consist of a-z only.  A backslash before a letter stands for that letter; every
    other escape, and every other literal character, asks for something no term contains.
    """
    plain = F.regexp_replace(value, r"\\([a-z])", "$1")
    return F.when(~plain.rlike(r"[^a-z%_]"), plain)


def term_grams(terms: DataFrame) -> DataFrame:
    """The distinct grams of each term: ``(gram, term)``.

    A gram is GRAM_LENGTH letters; the last ones of a term are filled up with PADDING, so every
    shorter run of letters is the start of a gram.
    """
    padded = F.concat("term", F.lit(PADDING * (GRAM_LENGTH - 1)))
    starts = F.sequence(F.lit(1), F.length("term"))
    grams = terms.select("term", padded.alias("padded"), F.explode(starts).alias("at"))
    grams = grams.select("term", "padded", "at", F.substring("padded", F.col("at"), F.lit(GRAM_LENGTH)).alias("gram"))
    # A gram counts where it stands first.
    return grams.filter(F.instr("padded", F.col("gram")) == F.col("at")).select("gram", "term")


def pattern_grams(pattern: Column) -> Column:
    """Lists of grams, one of each list in every term that matches the pattern.

    From each literal run of GRAM_LENGTH letters or more every gram on its own; if there is no
    such run, all grams that start with the longest one.
    """
    runs = F.split(pattern, "[%_]")
    whole = F.flatten(
        F.transform(
            F.filter(runs, lambda run: F.length(run) >= GRAM_LENGTH),
            lambda run: F.transform(
                F.sequence(F.lit(1), F.length(run) - (GRAM_LENGTH - 1)),
                lambda at: F.array(F.substring(run, at, F.lit(GRAM_LENGTH))),
            ),
        )
    )
    longest = F.array_max(F.transform(runs, lambda run: F.struct(F.length(run).alias("n"), run.alias("run"))))["run"]
    letters = F.array(*map(F.lit, "abcdefghijklmnopqrstuvwxyz"))
    endings = F.concat(letters, F.array(F.lit(PADDING)))
    # Nothing follows padding but padding.
    two = F.flatten(
        F.transform(
            endings,
            lambda a: F.when(a == PADDING, F.array(F.lit(PADDING * 2))).otherwise(
                F.transform(endings, lambda b: F.concat(a, b))
            ),
        )
    )
    short = F.when(F.length(longest) == 2, F.transform(endings, lambda end: F.concat(longest, end))).when(
        F.length(longest) == 1, F.transform(two, lambda end: F.concat(longest, end))
    )
    return F.when(F.size(whole) > 0, whole).when(F.length(longest) > 0, F.array(short))


def _with_rarest(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each gram of the list that the fewest terms have.

    ``counts`` has at most one row for each possible gram, 27 ** 3, and is broadcast.
    """
    lists = wanted.select("value", "pattern", F.posexplode(pattern_grams(F.col("pattern"))).alias("list", "grams"))
    grams = lists.select("value", "pattern", "list", F.explode("grams").alias("gram"))
    priced = grams.join(F.broadcast(counts), "gram", "left")
    n_terms = F.sum(F.coalesce("n", F.lit(0))).alias("n_terms")
    kept = F.collect_list(F.when(F.col("n").isNotNull(), F.col("gram"))).alias("grams")  # of one pattern
    priced = priced.groupBy("value", "pattern", "list").agg(n_terms, kept)
    best = priced.groupBy("value", "pattern").agg(F.min_by("grams", F.struct("n_terms", "list")).alias("grams"))
    return best.select("value", "pattern", F.explode("grams").alias("gram"))


def expand_patterns(index: SearchIndex, patterns: DataFrame) -> DataFrame:
    """Dictionary terms that contain a pattern: ``(value, term)``.

    ``%`` and ``_`` are wildcards.  A pattern and a term meet on the rarest letter gram that the
    pattern asks for (an equi-join, not a comparison of every pattern with every term) and are then
    compared in full.  A stored index has its grams at hand; patterns without any letter are
    compared with the whole dictionary, and no gram is cut for them.
    """
    wanted = patterns.select("value", clean_pattern(F.col("value")).alias("pattern"))
    wanted = wanted.filter(F.col("pattern").isNotNull())
    has_letter = F.col("pattern").rlike("[a-z]")
    facts = wanted.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("n_bytes"),
        F.count_if(~has_letter).alias("n_wild"),
    ).first()
    size = Size(facts["n"], 2 * facts["n_bytes"])
    literal = ~F.col("pattern").rlike("[%_]")
    fits = F.when(literal, F.contains("term", "pattern")).otherwise(
        F.expr("term LIKE concat('%', pattern, '%')")
    )
    grams = index.stored.grams if index.stored else settle(term_grams(index.terms), "grams")
    counts = index.stored.gram_counts if index.stored else grams.select("gram", F.lit(1).alias("n"))
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n"))
    probes = _with_rarest(wanted.filter(has_letter), counts)
    # A single letter asks for at most 27 * 26 + 1 grams, everything else for fewer.
    most = size.times(27 * 27)
    # Several grams of one list may lead to a term, and several batches may hold it.
    found = grams.join(broadcast_if(probes, most), "gram").filter(fits).select("value", "term").distinct()
    if index.stored and index.stored.replaced is not None:
        found = settle(found, "found")
        words = found.select("term").distinct()
        known = known_terms(index, broadcast_if(words, measured(words))).select("term")
        found = found.join(known, "term", "left_semi")
    if not facts["n_wild"]:
        return found
    return found.unionByName(_of_length(index, wanted.filter(~has_letter), size))


def _of_length(index: SearchIndex, wild: DataFrame, size: Size) -> DataFrame:
    """Terms that have at least as many letters as a pattern of wildcards alone asks for."""
    lengths = wild.select("value", F.length(F.replace("pattern", F.lit("%"))).alias("least"))
    terms = index.terms.select("term", F.explode(F.sequence(F.lit(0), F.length("term"))).alias("least"))
    return terms.join(broadcast_if(lengths, size), "least").select("value", "term")


def is_open(pattern: Column) -> Column:
    """Whether a pattern asks for nothing, so that every indexed document has it."""
    return pattern.rlike(r"^%*\z")


def match_patterns(index: SearchIndex, leaves: DataFrame, size: Size | None = None) -> DataFrame:
    """Hits of the pattern leaves: documents with any term that contains the pattern.

    Patterns made of ``%`` alone, and the empty one, hold for every indexed document and are
    answered from the documents table.
    """
    values, open_ended = leaf_values(leaves, "pattern"), is_open(F.col("value"))
    expanded = settle(expand_patterns(index, values.filter(~open_ended)), "patterns")
    expanded = broadcast_if(expanded, measured(expanded))
    found = probe_postings(index, expanded, ["doc_id"]).select("value", "doc_id").distinct()

    patterns = leaves.filter(F.col("kind") == "pattern")
    size = leaf_size(patterns) if size is None else size
    hits = _of_leaves(leaves, "pattern", found, size)
    everywhere = patterns.filter(open_ended).select("query_id", "leaf_id")
    paired = pair_with_documents(index, everywhere)
    return hits.unionByName(paired.select(*HIT_COLUMNS))


# Phrases -------------------------------------------------------------------------------


def phrase_parts(phrases: DataFrame, frequent: list[str]) -> DataFrame:
    """The parts a phrase is looked up by: ``(phrase_id, n_parts, at, term, is_pair)``.

    Two neighbouring frequent tokens are one part, both words with a blank between; every token
    that is in no such pair is a part of its own.  A token may be in two pairs.
    """
    tokens = F.split("value", " ")
    phrases = hold(phrases, "tokens", tokens, ["phrase_id"])
    often = F.transform("tokens", lambda token: token.isin(frequent))
    phrases = hold(phrases, "often", often, ["phrase_id", "tokens"])

    def part(token: Column, at: Column) -> Column:
        own, after = F.get("often", at), F.coalesce(F.get("often", at + 1), F.lit(False))
        before = (at > 0) & F.coalesce(F.get("often", at - 1), F.lit(False))
        pair = F.struct(
            at.alias("at"), F.concat_ws(" ", token, F.get("tokens", at + 1)).alias("term"), F.lit(True).alias("is_pair")
        )
        single = F.struct(at.alias("at"), token.alias("term"), F.lit(False).alias("is_pair"))
        return F.when(own & after, pair).when(~own | ~before, single)

    parts = F.array_compact(F.transform("tokens", part))
    phrases = hold(phrases, "parts", parts, ["phrase_id"])
    return phrases.select("phrase_id", F.size("parts").alias("n_parts"), F.inline("parts"))


def _few_parts(parts: DataFrame) -> tuple[list[str], list[str]] | tuple[None, None]:
    """Terms and pairs by name, if there are few."""
    rows = parts.select("term", "is_pair").distinct().limit(LITERAL_TERMS + 1).collect()
    if len(rows) > LITERAL_TERMS:
        return None, None
    return [row[0] for row in rows if not row[1]], [row[0] for row in rows if row[1]]


def _probe_parts(index: SearchIndex, parts: DataFrame, size: Size, columns: list[str], few: tuple) -> DataFrame:
    """Postings of phrase parts, from the pairs of a stored index or from its terms."""
    singles = parts.filter(~F.col("is_pair")).drop("is_pair")
    found = probe_postings(index, broadcast_if(singles, size), columns, few[0])
    if index.stored and index.stored.frequent:
        pairs = parts.filter("is_pair").drop("is_pair")
        found = found.unionByName(probe_pairs(index, broadcast_if(pairs, size), columns, few[1]))
    return found


def match_phrases(
    index: SearchIndex,
    leaves: DataFrame,
    size: Size | None = None,
    skip_repeated: bool = False,
) -> DataFrame:
    """Hits of the phrase leaves: documents with the phrase's tokens in a row.

    The value of a phrase leaf is its normalised text, so stopwords neither count nor break a
    phrase.  A document qualifies when shifting each token's positions back by the token's
    place in the phrase leaves a common start.  With ``skip_repeated`` phrases that repeat a
    token match nothing.

    Phrases are numbered first, and only their numbers travel with tokens and documents.
    """
    values = leaf_values(leaves, "phrase").filter(F.col("value") != "")
    if skip_repeated:
        tokens = F.split("value", " ")
        values = values.filter(F.size(F.array_distinct(tokens)) == F.size(tokens))
    number = F.monotonically_increasing_id().alias("phrase_id")
    phrases = settle(values.select(number, "value"), "phrases")
    found = _phrase_documents(index, phrases)
    size = leaf_size(leaves) if size is None else size
    asked = leaves.filter(F.col("kind") == "phrase").select("query_id", "leaf_id", "value")
    asked = asked.join(broadcast_if(phrases, size), "value").drop("value")
    return found.join(broadcast_if(asked, Size(size.rows)), "phrase_id").select(*HIT_COLUMNS)


def _phrase_documents(index: SearchIndex, phrases: DataFrame) -> DataFrame:
    """Documents of numbered phrases ``(phrase_id, value)``: ``(phrase_id, doc_id)``."""
    frequent = index.stored.frequent if index.stored else []
    wanted = settle(phrase_parts(phrases, frequent), "phrase-parts")
    size_of_parts = measured(wanted)

    # Only documents of a phrase's rarest part can hold it.
    few = _few_parts(wanted)
    rarest, n_candidates = _rarest_parts(index, wanted, size_of_parts)
    named = ["phrase_id", "term", "is_pair"]
    if _few_rows(rarest.select("phrase_id", "df"), Size(n_candidates)) or not _few_rows(wanted, size_of_parts):
        # Both sides of this join, and the grouping behind it, share the distribution by (phrase_id, doc_id).
        entries = _probe_parts(index, wanted, size_of_parts, ["doc_id", "positions"], few)
        hits = _probe_parts(index, rarest.select(*named), size_of_parts, ["doc_id"], few)
        candidates = broadcast_if(hits.select("phrase_id", "doc_id"), Size(n_candidates))
        entries = entries.join(candidates, ["phrase_id", "doc_id"], "left_semi").withColumn("rare", F.lit(True))
    else:
        # Many documents for few phrases: the places of a part travel once, not for each phrase that has it.
        number = F.monotonically_increasing_id().alias("part_id")
        parts = settle(wanted.select("term", "is_pair").distinct().select("*", number), "parts")
        places = _probe_parts(index, parts, size_of_parts, ["doc_id", "positions"], few)
        # Lists of places are sorted where they meet, so a task gets fewer of them.
        places = deal_by_document(index, places.select("doc_id", "part_id", "positions"), 4 * size_of_parts.rows)
        asked = wanted.join(rarest.select(*named, F.lit(True).alias("rare")), named, "left")
        asked = asked.join(parts, ["term", "is_pair"]).drop("term", "is_pair")
        entries = places.join(F.broadcast(asked), "part_id")

    gathered = entries.groupBy("phrase_id", "doc_id").agg(
        F.collect_list(F.struct("at", "positions")).alias("entries"),
        F.first("n_parts").alias("n_parts"),
        F.max("rare").alias("rare"),
    )
    complete = gathered.filter(F.col("rare") & (F.size("entries") == F.col("n_parts")))
    starts = F.aggregate(
        "entries",
        _starts(F.col("entries")[0]),
        lambda common, entry: F.array_intersect(common, _starts(entry)),
    )
    return complete.filter(F.size(starts) > 0).select("phrase_id", "doc_id")


def _starts(entry: Column) -> Column:
    return F.transform(entry["positions"], lambda pos: pos - entry["at"])


def _few_rows(df: DataFrame, size: Size) -> bool:
    return bytes_of(df, size) <= session.BROADCAST_BYTES


def _rarest_parts(index: SearchIndex, wanted: DataFrame, size: Size) -> tuple[DataFrame, int]:
    """Each phrase's rarest part, ``(phrase_id, term, is_pair, df)``, and the documents of all of these.

    The dictionary gives their number, replaced documents of pairs included, before any posting is
    read; beyond the limit they are shuffled instead of broadcast.
    """
    words = broadcast_if(wanted.filter(~F.col("is_pair")).select("term").distinct(), size)
    known = known_terms(index, words)
    if index.stored and index.stored.frequent:
        pairs = broadcast_if(wanted.filter("is_pair").select("term").distinct(), size)
        found = index.stored.pair_counts.join(pairs, "term")
        known = known.unionByName(found.groupBy("term").agg(F.sum("df").alias("df")))
    rarest = (
        wanted.join(broadcast_if(known, size), "term")
        .groupBy("phrase_id")
        .agg(F.min_by(F.struct("term", "is_pair", "df"), F.struct("df", "term")).alias("rarest"))
        .select("phrase_id", "rarest.term", "rarest.is_pair", "rarest.df")
    )
    rarest = settle(rarest, "rarest")
    return rarest, rarest.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]


# Everything ----------------------------------------------------------------------------

# Documents that a row whose answer is everything meets in one task.
DOCUMENTS_PER_SLICE = 100_000


def pair_with_documents(index: SearchIndex, rows: DataFrame) -> DataFrame:
    """Every document for each of the rows, whose answer is everything.

    The documents are sliced by a hash of their id, more slices the more there are, and each
    row is repeated per slice, so the unavoidable output comes from many tasks.
    """
    n_slices = max(1, -(-index.documents.count() // DOCUMENTS_PER_SLICE))
    repeated = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    repeated = broadcast_if(repeated, measured(rows).times(n_slices))
    slice_of = F.pmod(F.xxhash64("doc_id"), F.lit(n_slices)).cast("int")
    documents = index.documents.select("doc_id", slice_of.alias("slice"))
    return documents.join(repeated, "slice").drop("slice")


def match_leaves(
    index: SearchIndex,
    leaves: DataFrame,
    size: Size | None = None,
    kinds: set[str] | None = None,
) -> DataFrame:
    """Hits of all leaves, as if none were negated.  ``kinds`` names those that occur."""
    size = leaf_size(leaves) if size is None else size
    matchers = {"term": match_terms, "pattern": match_patterns, "phrase": match_phrases}
    chosen = [match for kind, match in matchers.items() if kinds is None or kind in kinds]
    return reduce(DataFrame.unionByName, [match(index, leaves, size) for match in chosen])


# Values by number ----------------------------------------------------------------------

# The number of a value that every document has.
EVERYWHERE = -1
# Numbers of patterns that a posting takes along in one row, about.
NUMBERS_AT_ONCE = 1000


def number_values(leaves: DataFrame) -> DataFrame:
    """Distinct values of the leaves with a number: ``(kind, value, value_id)``.

    ``leaves`` are written with a number of their own, ``row``; a value has the least of its leaves.
    """
    values = leaves.filter(F.col("value").isNotNull()).groupBy("kind", "value")
    least = values.agg(F.min("row").alias("least"))
    everywhere = (F.col("kind") == "pattern") & is_open(F.col("value"))
    return least.select("kind", "value", F.when(everywhere, EVERYWHERE).otherwise(F.col("least")).alias("value_id"))


def find_terms(index: SearchIndex, words: DataFrame, size: Size, columns: list[str]) -> DataFrame:
    """Documents of numbered terms ``(value_id, term)``: ``(doc_id, values)``, and columns of the postings."""
    found = probe_postings(index, broadcast_if(words, size), ["doc_id", *columns])
    return found.select("doc_id", F.array("value_id").alias("values"), *columns)


def find_patterns(index: SearchIndex, patterns: DataFrame, size: Size) -> DataFrame:
    """Documents of numbered patterns ``(value_id, value)``: ``(doc_id, values)``.

    A posting takes the numbers of all patterns along that its term contains, so each is moved once
    whatever the number of patterns; a document has one row for each such term.
    """
    expanded = expand_patterns(index, patterns.select("value"))
    expanded = expanded.join(broadcast_if(patterns, size), "value").select("value_id", "term")
    expanded = settle(expanded, "patterns")
    n_blocks = max(1, -(-patterns.count() // NUMBERS_AT_ONCE))
    block = F.pmod(F.xxhash64("value_id"), F.lit(n_blocks)).alias("block")
    terms = expanded.groupBy("term", block).agg(F.collect_list("value_id").alias("values"))
    # A pair of pattern and term takes more room than a number in a list.
    terms = broadcast_if(terms.drop("block"), measured(expanded))
    return probe_postings(index, terms, ["doc_id"]).select("doc_id", "values")


def find_phrases(index: SearchIndex, phrases: DataFrame) -> DataFrame:
    """Documents of numbered phrases ``(value_id, value)``: ``(doc_id, values)``."""
    phrases = phrases.filter(F.col("value") != "").withColumnRenamed("value_id", "phrase_id")
    return _phrase_documents(index, phrases).select("doc_id", F.array("phrase_id").alias("values"))


def find_everywhere(index: SearchIndex) -> DataFrame:
    """Every document with the number EVERYWHERE: ``(doc_id, values)``."""
    return index.documents.select("doc_id", F.array(F.lit(EVERYWHERE).cast("bigint")).alias("values"))
