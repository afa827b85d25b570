"""Hand-checked index contents and query results on a five-document corpus."""

import pytest

from termloom import build_index, leaf_counts, parse_query_log, query_status, ranked_search, search

POSTINGS = {
    (1, "queso"): [0, 2, 4, 7], (1, "cabra"): [1], (1, "sabroso"): [3], (1, "manchego"): [5],
    (1, "tambien"): [6], (1, "excelente"): [8],
    (2, "cabra"): [0, 3], (2, "come"): [1], (2, "hierba"): [2], (2, "camina"): [4],
    (3, "camion"): [0, 2, 4], (3, "rojo"): [1], (3, "azul"): [3], (3, "camina"): [5],
    (4, "quesocabra"): [0], (4, "vino"): [1, 2], (4, "tinto"): [3],
}

# query -> [(doc_id, score, cosine)] in rank order
RESULTS = {
    "queso": [(1, 0.616131, 1.210057)],
    "cabra": [(2, 0.277259, 0.523970), (1, 0.077016, 0.151257)],
    "queso cabra": [(1, 0.693147, 1.149952), (2, 0.277259, 0.234327)],
    "queso AND cabra": [(1, 0.693147, 1.149952)],
    "queso AND NOT cabra": [],
    "NOT camina": [(1, 0, 0), (4, 0, 0)],
    "queso OR camina AND cabra": [(1, 0.693147, 1.049758), (2, 0.415888, 0.320865)],
    "queso queso cabra": [(1, 0.693147, 1.210613), (2, 0.277259, 0.127081)],
    'CADENA("queso de cabra")': [(1, 0.693147, 1.149952)],
    'CADENA("cabra queso")': [(1, 0.693147, 1.149952)],
    'CADENA("cabra come hierba")': [(2, 0.831777, 0.873283)],
    "PATRON(cam)": [(2, 0, 0), (3, 0, 0)],
    "PATRON(c_m)": [(2, 0, 0), (3, 0, 0)],
    "PATRON(camión)": [],
    "PATRON(camion)": [(3, 0.693147, 1.200566)],
    "camión": [(3, 0.693147, 1.200566)],
    "PATRON()": [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0)],
    "PATRON(___________)": [],
    "PATRON(__________)": [(4, 0, 0)],
    "casa de queso": [(1, 0.616131, 0.855639)],
    "queso AND de": [],
    "CADENA(el)": [],
    "NOT": [],
    "NOT de": [],
    "camion AND NOT PATRON(tint)": [(3, 0.693147, 0.848928)],
    "queso NOT cabra": [],
    "NOT NOT queso": [],
    "queso AND": [],
    "AND queso": [],
    "OR queso OR": [(1, 0.616131, 1.210057)],
    "historia": [],
    "": [],
    "   ": [],
    "0": [],
    "ausente": [],
    "queso AND NOT ausente": [(1, 0.616131, 0.855639)],
}


def test_postings(golden_index):
    rows = golden_index.postings.collect()
    assert {(r["doc_id"], r["term"]): r["positions"] for r in rows} == POSTINGS
    assert all(r["tf"] == len(r["positions"]) for r in rows)


def test_documents(golden_index):
    rows = {r["doc_id"]: r for r in golden_index.documents.collect()}
    assert {d: r["total_terms"] for d, r in rows.items()} == {1: 9, 2: 5, 3: 6, 4: 4}
    magnitudes = {1: 0.509175, 2: 0.529150, 3: 0.577350, 4: 0.612372}
    for doc_id, magnitude in magnitudes.items():
        assert rows[doc_id]["doc_magnitude"] == pytest.approx(magnitude, abs=1e-6)
    assert rows[2]["snippet"] == "La cabra come hierba; la cabra camina."


def test_terms(golden_index):
    rows = {r["term"]: (r["df"], r["cf"]) for r in golden_index.terms.collect()}
    repeated = {"cabra": (2, 3), "camina": (2, 2), "queso": (1, 4), "camion": (1, 3), "vino": (1, 2)}
    assert {t: c for t, c in rows.items() if c != (1, 1)} == repeated
    assert set(rows) == {term for _, term in POSTINGS}


@pytest.fixture(scope="module")
def answers(spark, golden_index, golden_docs):
    log = spark.createDataFrame(list(enumerate(RESULTS)), "query_id bigint, q string")
    stored = ranked_search(golden_index, log).collect()
    unstored = ranked_search(build_index(golden_docs), log).collect()
    top = ranked_search(golden_index, log, k=1).collect()
    return stored, unstored, top


def _of(rows, query_id):
    mine = sorted((r for r in rows if r["query_id"] == query_id), key=lambda r: r["rank"])
    assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
    return [(r["doc_id"], r["score"], r["cosine_sim"]) for r in mine]


@pytest.mark.parametrize("query_id,q", list(enumerate(RESULTS)))
def test_results(answers, query_id, q):
    stored, unstored, top = answers
    expected = RESULTS[q]
    for rows in (stored, unstored):
        got = _of(rows, query_id)
        assert [doc for doc, _, _ in got] == [doc for doc, _, _ in expected]
        for (_, score, cosine), (_, want_score, want_cosine) in zip(got, expected):
            assert score == pytest.approx(want_score, abs=1e-6)
            assert cosine == pytest.approx(want_cosine, abs=1e-6)
    assert [doc for doc, _, _ in _of(top, query_id)] == [doc for doc, _, _ in expected[:1]]


def test_results_are_described(answers):
    row = next(r for r in answers[0] if r["query_id"] == 0)
    assert (row["filename"], row["snippet"][:14]) == ("uno.txt", "Queso de cabra")


def test_repeated_word_phrase(spark, golden_index):
    from termloom.operators.matching import match_phrases

    log = spark.createDataFrame([(1, 'CADENA("cabra queso sabroso queso")')], "query_id bigint, q string")
    leaves = parse_query_log(log)
    assert [r["doc_id"] for r in match_phrases(golden_index, leaves).collect()] == [1]
    assert match_phrases(golden_index, leaves, skip_repeated=True).count() == 0


def test_search_agrees_with_ranked_matches(spark, golden_index):
    log = spark.createDataFrame(
        [(i, q) for i, q in enumerate(RESULTS) if q not in ("NOT de",)], "query_id bigint, q string"
    )
    got = {(r["query_id"], r["doc_id"]) for r in search(golden_index, parse_query_log(log)).collect()}
    want = {(i, doc) for i, q in enumerate(RESULTS) for doc, _, _ in RESULTS[q]}
    ids = {r[0] for r in log.collect()}
    assert {pair for pair in got if pair[0] in ids} == {p for p in want if p[0] in ids}


def test_leaf_counts(spark, golden_index):
    log = spark.createDataFrame(
        [(1, "queso AND NOT cabra"), (2, "PATRON(cam) CADENA(cabra queso) ausente de")],
        "query_id bigint, q string",
    )
    rows = leaf_counts(golden_index, parse_query_log(log)).collect()
    assert {(r["query_id"], r["leaf_id"]): r["n_docs"] for r in rows} == {
        (1, 1): 1, (1, 2): 2, (2, 1): 2, (2, 2): 1, (2, 3): 0, (2, 4): 0,
    }


def test_status(spark):
    log = spark.createDataFrame(
        [(1, "queso"), (2, " "), (3, "a AND"), (4, "de la"), (5, "queso NOT cabra"), (6, "PATRON()")],
        "query_id bigint, q string",
    )
    rows = {r["query_id"]: r["status"] for r in query_status(log).collect()}
    assert rows == {
        1: "ok", 2: "blank", 3: "malformed", 4: "no_scoring_terms", 5: "malformed", 6: "ok",
    }


def test_results_without_any_broadcast(spark, golden_index, answers, monkeypatch):
    from termloom import session

    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = spark.createDataFrame(list(enumerate(RESULTS)), "query_id bigint, q string")
        result = ranked_search(golden_index, log)
        assert "BroadcastHashJoin" not in result._jdf.queryExecution().executedPlan().toString()
        rows = result.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9)) for r in rows}
    want = {(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 9)) for r in answers[0]}
    assert got == want
