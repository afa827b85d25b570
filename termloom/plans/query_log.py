"""From a table of query strings to leaves and scoring terms.

The language has terms, ``CADENA(phrase)``, ``PATRON(pattern)`` and the operators NOT, AND, OR
in falling precedence; operands side by side are joined by OR.  There is no grouping, so a
query is an OR of ANDs of possibly negated leaves, which is how the leaves table spells it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import BLANK_CHARS, normalize_tokens
from termloom.session import hold

# The function names and operator words, compared in lower case.
PHRASE_WORD = "cadena"
PATTERN_WORD = "patron"
OPERATOR_WORDS = ("and", "or", "not")

_CALL = rf"(?:{PHRASE_WORD}|{PATTERN_WORD})[{BLANK_CHARS}]*\([^\n]*?\)"
_OPERATORS = "|".join(OPERATOR_WORDS)

LEAF_COLUMNS = ["query_id", "disjunct_id", "leaf_id", "kind", "value", "negated"]


def query_parts(q: Column, operator_split: str = "word") -> Column:
    """Calls and blank-separated words of a query, in order.

    ``operator_split="substring"`` also cuts operator words out of longer words.
    """
    stop = rf"{_CALL}|[{BLANK_CHARS}]|\z"
    first = _CALL
    if operator_split == "substring":
        stop, first = f"{_OPERATORS}|{stop}", f"{_CALL}|{_OPERATORS}"
    elif operator_split != "word":
        raise ValueError(f"unknown operator_split {operator_split!r}")
    word = rf"[^{BLANK_CHARS}]+?(?={stop})"
    return F.regexp_extract_all(F.lower(q), F.lit(f"{first}|{word}"), F.lit(0))


def _call_value(part: Column) -> Column:
    inner = F.regexp_extract(part, rf"\(([^\n]*)\)\z", 1)
    return F.btrim(F.btrim(inner, F.lit(" \t\n\r\0\x0b")), F.lit("\"'"))


def _classified(queries: DataFrame, operator_split: str) -> DataFrame:
    """One row per part with its role and neighbours' roles."""
    parts = queries.filter(F.trim("q") != "").select(
        "query_id", F.posexplode(query_parts(F.col("q"), operator_split)).alias("at", "part")
    )
    is_operator = F.col("part").isin(*OPERATOR_WORDS)
    parts = parts.withColumn("role", F.when(is_operator, F.col("part")).otherwise("operand"))

    in_order = Window.partitionBy("query_id").orderBy("at")
    before, after = F.lag("role").over(in_order), F.lead("role").over(in_order)
    parts = parts.withColumn("before", before).withColumn("after", after)

    role, before, after = F.col("role"), F.col("before"), F.col("after")
    nothing = F.lit("nothing")
    bad_and = (role == "and") & (
        (F.coalesce(before, nothing) != "operand")
        | ~F.coalesce(after, nothing).isin("operand", "not")
    )
    bad_not = (role == "not") & (
        (F.coalesce(after, nothing) != "operand")
        | F.coalesce(before, nothing).isin("operand", "not")
    )
    starts_disjunct = (role == "or") | ((role == "operand") & (before == "operand"))
    return (
        parts.withColumn("malformed", F.max(bad_and | bad_not).over(Window.partitionBy("query_id")))
        .withColumn(
            "disjunct_id",
            F.sum(F.when(starts_disjunct, 1).otherwise(0)).over(in_order).cast("int"),
        )
        .withColumn(
            "leaf_id",
            F.sum(F.when(role == "operand", 1).otherwise(0)).over(in_order).cast("int"),
        )
    )


def parse_query_log(queries: DataFrame, operator_split: str = "word") -> DataFrame:
    """Leaves of a query log ``(query_id, q)``.

    A term leaf holds the word's first token, a phrase leaf the normalised phrase and a
    pattern leaf the pattern as typed, in lower case.  An operand that has no token, such as a
    stopword, stays as a leaf with a null or empty value that matches nothing.  Malformed
    queries have no leaves; see :func:`query_status`.
    """
    operands = _classified(queries, operator_split).filter(
        (F.col("role") == "operand") & ~F.col("malformed")
    )
    part = F.col("part")
    is_call = part.rlike(rf"^{_CALL}\z")
    kind = (
        F.when(is_call & part.startswith(PHRASE_WORD), "phrase")
        .when(is_call, "pattern")
        .otherwise("term")
    )
    typed = operands.withColumn("kind", kind).withColumn(
        "raw", F.when(F.col("kind") == "term", part).otherwise(_call_value(part))
    )
    typed = hold(typed, "tokens", normalize_tokens(F.col("raw")))
    value = (
        F.when(F.col("kind") == "pattern", F.col("raw"))
        .when(F.col("kind") == "phrase", F.array_join("tokens", " "))
        .otherwise(F.get("tokens", 0))
    )
    return typed.select(
        "query_id",
        "disjunct_id",
        "leaf_id",
        "kind",
        value.alias("value"),
        F.coalesce(F.col("before") == "not", F.lit(False)).alias("negated"),
    )


def scoring_terms(leaves: DataFrame) -> DataFrame:
    """Terms that make up the query vector, repeats kept: ``(query_id, term)``.

    All leaves contribute, negated ones too: terms, patterns as typed, and the tokens of
    phrases.
    """
    tokens = (
        F.when(F.col("kind") == "phrase", F.filter(F.split("value", " "), lambda t: t != ""))
        .when(F.col("value").isNotNull(), F.array("value"))
    )
    return leaves.select("query_id", F.explode(tokens).alias("term"))


def query_status(queries: DataFrame, operator_split: str = "word") -> DataFrame:
    """Per query: ``ok``, ``blank``, ``malformed`` or ``no_scoring_terms``.

    Only ``ok`` queries can have results.
    """
    checked = _classified(queries, operator_split)
    flags = checked.groupBy("query_id").agg(F.max("malformed").alias("malformed"))
    scored = scoring_terms(parse_query_log(queries, operator_split)).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_terms")
    )
    status = (
        F.when(F.col("malformed").isNull(), "blank")
        .when(F.col("malformed"), "malformed")
        .when(F.col("n_terms").isNull(), "no_scoring_terms")
        .otherwise("ok")
    )
    return (
        queries.select("query_id")
        .join(flags, "query_id", "left")
        .join(scored, "query_id", "left")
        .select("query_id", status.alias("status"))
    )
