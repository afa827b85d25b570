"""What is found is moved by its documents before it meets the leaves that ask for it."""

import random
import re

import pytest

from termloom import parse_query_log, ranked_search, session
from termloom.operators import matching
from termloom.operators.matching import match_phrases
from termloom.operators.ranking import rank_runs, sorted_runs
from termloom.plans.search import search
from termloom.session import settle
from termloom.sources.index_store import index_corpus

WORDS = ["pan", "panes", "vino", "agua", "queso", "sal", "manzana", "sol"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(7)
    return {i: " ".join(draw.choices(WORDS, [9, 3, 5, 4, 2, 2, 1, 1], k=draw.randint(1, 9))) for i in range(90)}


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    rows = [(i, f"{i}.txt", text) for i, text in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, filename string, text string")
    return index_corpus(docs, str(tmp_path_factory.mktemp("by-document")))


@pytest.fixture(scope="module")
def log(spark):
    shapes = ["NOT {0} AND {1}", 'CADENA("{0} {1}")', "PATRON({2})", "{0} {1}", "NOT {0}", "PATRON(%) AND {0}", "{0} AND NOT PATRON({2})"]
    rows = []
    for n in range(56):
        a, b = WORDS[n % 8], WORDS[(n * 3 + 1) % 8]
        rows.append((n, shapes[n % 7].format(a, b, a[: 1 + n % 3])))
    return spark.createDataFrame([*rows, (None, "pan"), (None, "NOT pan AND vino")], "query_id bigint, q string")


def _wanted(texts):
    """Matches of the log, worked out one by one."""
    found = set()
    for n in range(56):
        a, b = WORDS[n % 8], WORDS[(n * 3 + 1) % 8]
        part = a[: 1 + n % 3]
        for i, text in texts.items():
            has = text.split()
            holds = [a not in has and b in has, f" {a} {b} " in f" {text} ", part in text.replace(" ", "_"), a in has or b in has,
                     a not in has, a in has, a in has and part not in text.replace(" ", "_")][n % 7]
            if holds:
                found.add((n, i))
    return found


@pytest.mark.parametrize("limit", [32 << 20, 6000])
def test_every_size_finds_the_same(spark, index, log, texts, monkeypatch, limit):
    leaves = settle(parse_query_log(log))
    monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(matching, "HITS_PER_TASK", 500)
    monkeypatch.setattr(matching, "NUMBERS_AT_ONCE", 2)
    got = [tuple(row) for row in search(index, leaves).select("query_id", "doc_id").collect()]
    assert sorted(got) == sorted(_wanted(texts))
    ranked = ranked_search(index, log).select("query_id", "doc_id").collect()
    assert sorted(map(tuple, ranked)) == sorted(_wanted(texts))


def test_hits_of_queries_are_not_shuffled(spark, index, log):
    text = _plan(search(index, settle(parse_query_log(log))))
    assert "hashpartitioning(doc_id" in text
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", text)


def test_many_candidates_move_each_place_once(spark, index, texts, monkeypatch):
    log = spark.createDataFrame([(n, f'CADENA("{a} {b}")') for n, (a, b) in enumerate((a, b) for a in WORDS[:4] for b in WORDS[:4])], "query_id bigint, q string")
    leaves = settle(parse_query_log(log))
    dealt = []
    deal = matching.deal_by_document
    monkeypatch.setattr(matching, "deal_by_document", lambda index, rows, n: dealt.append(rows.count()) or deal(index, rows, n))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 5000)
    got = {tuple(row) for row in match_phrases(index, leaves).select("query_id", "doc_id").collect()}
    pairs = [(a, b) for a in WORDS[:4] for b in WORDS[:4]]
    assert got == {(n, i) for n, (a, b) in enumerate(pairs) for i, text in texts.items() if f" {a} {b} " in f" {text} "}
    assert len(dealt) == 1


def test_only_keys_are_sorted_and_sizes_broadcast(spark):
    rows = [(q, d, (d * 7 % 5) / 3, d * 0.5) for q in (1, 2) for d in range(40)]
    scored = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double, dot double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        runs = sorted_runs(scored, ["query_id", "doc_id"])
        ranked = rank_runs(runs)
        text = _plan(ranked)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert runs.columns == ["query_id", "doc_id", "run", "place"]
    assert "SortMergeJoin" not in text
    want = []
    for q in (1, 2):
        own = sorted((r for r in rows if r[0] == q), key=lambda r: (-round(r[2], 10), r[1]))
        want += [(q, r[1], place) for place, r in enumerate(own, 1)]
    assert sorted(tuple(r) for r in ranked.select("query_id", "doc_id", "rank").collect()) == sorted(want)
