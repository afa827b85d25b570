"""Query strings to leaves, and random queries against a plain evaluation in Python."""

import random
import re

import pytest

from conftest import GOLDEN_DOCS
from termloom import parse_query_log, ranked_search, scoring_terms

LOG = {
    "Queso AND cabra": [(0, 1, "term", "queso", False), (0, 2, "term", "cabra", False)],
    "a NOT b": [],
    "x OR w z": [(0, 1, "term", "x", False), (1, 2, "term", "w", False), (2, 3, "term", "z", False)],
    "x OR OR w": [(0, 1, "term", "x", False), (2, 2, "term", "w", False)],
    "NOT x AND w": [(0, 1, "term", "x", True), (0, 2, "term", "w", False)],
    "casa de 12": [(0, 1, "term", "casa", False), (1, 2, "term", None, False), (2, 3, "term", None, False)],
    "CADENA('El Queso de Cabra') AND NOT Patron( \"Á%b_c\" )":
        [(0, 1, "phrase", "queso cabra", False), (0, 2, "pattern", "á%b_c", True)],
    "cadena (dos palabras)cadena(tres) fin":
        [(0, 1, "phrase", "dos palabras", False), (1, 2, "phrase", "tres", False), (2, 3, "term", "fin", False)],
    "PATRON() CADENA()": [(0, 1, "pattern", "", False), (1, 2, "phrase", "", False)],
    "(queso) AND (cabra)": [(0, 1, "term", "queso", False), (0, 2, "term", "cabra", False)],
    "historia": [(0, 1, "term", "historia", False)],
    "cadena patron": [(0, 1, "term", "cadena", False), (1, 2, "term", "patron", False)],
    "AND": [], "NOT": [], "x AND OR y": [], "OR": [], "NOT NOT x": [], "x AND": [], "  ": [],
}


def test_leaves(spark):
    log = spark.createDataFrame(list(enumerate(LOG)), "query_id bigint, q string")
    got = {i: [] for i in range(len(LOG))}
    for r in parse_query_log(log).orderBy("query_id", "leaf_id").collect():
        got[r["query_id"]].append((r["disjunct_id"], r["leaf_id"], r["kind"], r["value"], r["negated"]))
    assert got == dict(enumerate(LOG.values()))


def test_substring_split(spark):
    log = spark.createDataFrame([(1, "historia cuando PATRON(or)")], "query_id bigint, q string")
    rows = parse_query_log(log, operator_split="substring").orderBy("leaf_id").collect()
    assert [(r["disjunct_id"], r["kind"], r["value"]) for r in rows] == [
        (0, "term", "hist"), (1, "term", "ia"), (2, "term", "cu"), (2, "term", None), (3, "pattern", "or"),
    ]
    with pytest.raises(ValueError):
        parse_query_log(log, operator_split="letters")


def test_scoring_terms(spark):
    log = spark.createDataFrame(
        [(1, "queso NOT"), (2, "queso queso AND NOT vino CADENA(la cabra come) PATRON(x_) de")],
        "query_id bigint, q string",
    )
    rows = scoring_terms(parse_query_log(log)).collect()
    assert sorted((r["query_id"], r["term"]) for r in rows) == [
        (2, "cabra"), (2, "come"), (2, "queso"), (2, "queso"), (2, "vino"), (2, "x_"),
    ]


# A plain model of the corpus: tokens by hand-applied rules.
STOP = {"la", "de", "un", "el", "es", "y", "no", "que"}
TOKENS = {}
for doc_id, _, text in GOLDEN_DOCS:
    plain = text.lower().translate(str.maketrans("áéíóú", "aeiou"))
    words = re.sub(r"[^a-z\s]", "", plain).split()
    tokens = [w for w in words if w not in STOP]
    if tokens:
        TOKENS[doc_id] = tokens


def holds(leaf: str, tokens: list[str]) -> bool:
    if leaf.startswith("PATRON"):
        pattern = leaf[7:-1].replace("_", ".").replace("%", ".*")
        return any(re.search(pattern, token) for token in tokens)
    if leaf.startswith("CADENA"):
        phrase = [w for w in leaf[7:-1].split() if w not in STOP]
        size = len(phrase)
        return size > 0 and any(tokens[i:i + size] == phrase for i in range(len(tokens)))
    return leaf in tokens


OPERANDS = ["queso", "cabra", "camina", "vino", "nada", "de", "PATRON(cam)", "PATRON(a%o)",
            "PATRON(_e)", "CADENA(queso de cabra)", "CADENA(cabra camina)", "CADENA(vino vino)"]


def test_random_queries(spark, golden_index):
    rng = random.Random(7)
    queries, expected = [], set()
    for query_id in range(150):
        disjuncts = [
            [(rng.random() < 0.35, rng.choice(OPERANDS)) for _ in range(rng.randint(1, 3))]
            for _ in range(rng.randint(1, 3))
        ]
        spelled = [
            " AND ".join(("NOT " if negated else "") + leaf for negated, leaf in disjunct)
            for disjunct in disjuncts
        ]
        queries.append((query_id, " OR ".join(spelled)))
        if all(leaf == "de" for disjunct in disjuncts for _, leaf in disjunct):
            continue  # nothing to score by
        for doc_id, tokens in TOKENS.items():
            if any(all(holds(leaf, tokens) != negated for negated, leaf in d) for d in disjuncts):
                expected.add((query_id, doc_id))
    log = spark.createDataFrame(queries, "query_id bigint, q string")
    got = {(r["query_id"], r["doc_id"]) for r in ranked_search(golden_index, log).collect()}
    assert got == expected
