"""Personal data by bootstrapped contextual extraction, in built-in columns only.

Base patterns find mail and network addresses, card and phone numbers.  They are the seeds: every
seed occurrence induces lexical patterns, the words around it and the shape of the value.  The
same patterns are read off all other strings that look like identifiers.  Patterns and values
form a graph, whose scores are computed in rounds: a pattern scores the mean of its distinct
values, a value that is no seed the best of its trusted patterns.  Values with such a pattern are
reported wherever they stand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.support import lookup
from termloom.session import hold, settle

PERSONAL_KINDS = ("email", "ip", "card", "phone", "context")
BASE_KINDS = 4
CONTEXT = 4  # kind of what patterns discover

# A pattern is trusted from this score in thousandths and this many distinct scored values on.
TRUSTED = 800
SUPPORT = 3
ROUNDS = 4

# The base patterns.  They find what the plain forms find, but start only where a
# run of their first characters starts or the last match ended, and never give characters back,
# so that long runs take linear time.  The card pattern holds its limits of 14 and 19 digits.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_BASE = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# What may be an identifier: a string with six digits or an @, 5 to 64 characters long.
_CHAR = "[A-Za-z0-9._%+@-]"
_CANDIDATE = (
    rf"(?<!{_CHAR})(?:(?=(?:[A-Za-z._%+-]*+[0-9]){{6}})|(?={_LOCAL}*+@)){_CHAR}{{5,64}}+(?!{_CHAR})"
)
_TRAILING = "._%+-"
_WINDOW = 80  # characters on each side from which the words of a pattern come


def _found(kind: int, pattern: str) -> Column:
    """Matches of one pattern with the length of the gap before each, and the text around it."""
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    gaps = F.split("text", pattern, -1)

    def entry(match: Column, place: Column, cut: Column) -> Column:
        before, after = F.get(cut["gaps"], place), F.get(cut["gaps"], place + 1)
        return F.struct(
            F.lit(kind).alias("kind"),
            place.alias("place"),
            F.char_length(before).cast("bigint").alias("gap"),
            match.alias("value"),
            F.right(before, F.lit(_WINDOW)).alias("before"),
            F.left(after, F.lit(_WINDOW)).alias("after"),
        )

    # The lambda reads the gaps of one value, split once, and only if there is any match.
    cut = F.struct(matches.alias("matches"), F.when(F.size(matches) > 0, gaps).alias("gaps"))
    return F.flatten(
        F.transform(
            F.array(cut), lambda c: F.transform(c["matches"], lambda match, place: entry(match, place, c))
        )
    )


def _luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits has a right check digit."""
    plain = F.lpad(digits, 19, "0")
    doubled = F.translate(plain, "0123456789", "0246813579")
    places = [F.substring(doubled if at % 2 else plain, at + 1, 1).cast("int") for at in range(19)]
    return reduce(Column.__add__, places) % 10 == 0


def _holds() -> Column:
    """Whether a match is what its kind asks for."""
    value, digits = F.col("value"), F.regexp_replace("value", "[^0-9]", "")
    return (
        F.when(F.col("kind") == 1, value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(F.col("kind") == 2, _luhn(digits))
        .when(F.col("kind") == 3, F.length(digits).between(10, 15))
        .otherwise(True)
    )


def find_matches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(row, doc_id, found): all matches of every text, written out; ``row`` is one per row."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    kinds = [*_BASE, _CANDIDATE]
    found = F.concat(*(_found(kind, pattern) for kind, pattern in enumerate(kinds)))
    return settle(hold(texts, "found", found, ["row", "doc_id"]), "matches")


def place_matches(matches: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, words): valid base matches, and the candidates that
    overlap none of them; written out.

    ``words`` are the two before and the one behind, null where there is none.
    """
    rows = matches.select("row", F.inline("found"))
    length = F.char_length("value").cast("bigint")
    in_text = Window.partitionBy("row", "kind").orderBy("place")
    end = F.sum(F.col("gap") + length).over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("start", end - length)
    kept = F.when(F.col("kind") == CONTEXT, F.rtrim("value", F.lit(_TRAILING))).otherwise(F.col("value"))
    rows = rows.withColumn("value", kept).withColumn("end", F.col("start") + length)
    rows = rows.filter(_holds())

    # Both windows only look back, so a text of many matches takes linear time.
    base = F.col("kind") < BASE_KINDS
    ahead = Window.partitionBy("row").orderBy("start", "kind")
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("kind").desc())
    so_far = (Window.unboundedPreceding, 0)
    reach = F.max(F.when(base, F.col("end"))).over(ahead.rowsBetween(*so_far))
    following = F.min(F.when(base, F.col("start"))).over(back.rowsBetween(*so_far))
    rows = rows.withColumn("reach", reach).withColumn("following", following)
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.col("following") >= F.col("end"), F.lit(True))
    )
    rows = rows.filter(base | apart)

    # A value further left in the same gap list stands for itself.
    left = _words(F.concat(F.when(F.col("place") > 0, "# ").otherwise(""), "before"))
    words = F.struct(
        F.try_element_at(left, F.lit(-2)).alias("second"),
        F.try_element_at(left, F.lit(-1)).alias("first"),
        F.try_element_at(_words(F.col("after")), F.lit(1)).alias("behind"),
    )
    return settle(rows.select("row", "kind", "start", "end", "value", words.alias("words")), "placed")


def _words(text: Column) -> Column:
    """Words in lower case; # for each with a digit or an @."""
    plain = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}@#]+", " "))
    marked = F.regexp_replace(plain, r"[^ ]*[\p{N}@#][^ ]*", "#")
    return F.filter(F.split(marked, " "), lambda word: word != "")


def shape(value: Column) -> Column:
    """``value`` with 9 for each run of digits and a for each run of letters."""
    return F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]+", "9")


def induced_patterns() -> Column:
    """Patterns of an occurrence, as digests: two words before; the words on both sides; the word
    before with the shape of the value."""
    first, second, behind = (F.col(f"words.{name}") for name in ("first", "second", "behind"))
    patterns = F.array(
        F.concat(F.lit("2 "), second, F.lit(" "), first),
        F.concat(F.lit("1 "), first, F.lit(" _ "), behind),
        F.concat(F.lit("s "), first, F.lit(" "), shape(F.col("value"))),
    )
    return F.transform(F.array_compact(patterns), lambda pattern: F.md5(pattern))


def score_graph(placed: DataFrame, trusted: int, support: int, rounds: int) -> DataFrame:
    """(instance, score): the values that are no seed but stand in a trusted pattern.

    Scores are whole thousandths, seeds have 1,000, so every order of addition gives the same.
    """
    edges = placed.select(
        F.explode(induced_patterns()).alias("pattern"), _instance(), (F.col("kind") < BASE_KINDS).alias("seed")
    )
    edges = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    edges = settle(edges, "edges")
    patterns = edges.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("seed").cast("bigint")).alias("n_scored")
    )
    patterns = settle(patterns.withColumn("total", F.col("n_scored") * 1000), "patterns")
    others = edges.filter(~F.col("seed")).select("pattern", "instance")
    instances = None
    for _ in range(rounds):
        known = patterns
        if instances is not None:
            more = lookup(others, instances, ["instance"]).groupBy("pattern").agg(
                F.count(F.lit(1)).alias("more"), F.sum("score").alias("gain")
            )
            known = patterns.join(more, "pattern", "left").fillna(0, ["more", "gain"]).select(
                "pattern", "n", (F.col("n_scored") + F.col("more")).alias("n_scored"),
                (F.col("total") + F.col("gain")).alias("total"),
            )
        score = F.call_function("div", F.col("total"), F.col("n"))
        good = known.filter((F.col("n_scored") >= support) & (score >= trusted))
        good = settle(good.select("pattern", score.alias("score")), "trusted")
        # A value stays in a pattern that gets better, so values are only ever added.
        before = instances
        instances = lookup(others, good, ["pattern"]).groupBy("instance").agg(F.max("score").alias("score"))
        instances = settle(instances, "instances")
        if before is not None and instances.count() == before.count():
            break
    return instances


def _instance() -> Column:
    return F.md5(F.lower("value")).alias("instance")


def find_personal(
    docs: DataFrame,
    trusted: int = TRUSTED,
    support: int = SUPPORT,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Spans of personal data in every whole text.

    Base spans are always reported.  A string of six digits or more, or with an @, that overlaps
    none of them is reported as ``context`` if a pattern it stands in, here or elsewhere, holds
    at least ``support`` distinct seeds or earlier finds and scores ``trusted`` thousandths.
    A null text is empty; repeated rows are reported as often as they occur, their values count
    once; an empty table gives no rows.

    Returns doc_id and spans: array of (start, kind, end) by start, then kind in the order of
    PERSONAL_KINDS; code points, end exclusive.
    """
    matches = find_matches(docs, id_column, text_column)
    placed = place_matches(matches)
    discovered = score_graph(placed, trusted, support, rounds)
    candidates = placed.filter(F.col("kind") == CONTEXT).select("row", "start", "kind", "end", _instance())
    unseen = lookup(candidates, discovered, ["instance"]).select("row", "start", "kind", "end")
    spans = placed.filter(F.col("kind") < BASE_KINDS).select("row", "start", "kind", "end").unionByName(unseen)
    grouped = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    empty = F.array().cast(grouped.schema["spans"].dataType)
    return matches.select("row", "doc_id").join(grouped, "row", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans")
    )
