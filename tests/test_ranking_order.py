"""Results are sorted by columns that are at hand, and the searches of a log take every conversation."""

import duckdb

import __spark_entry__ as entry
from termloom.operators import ranking
from termloom.session import settle


def test_sort_evaluates_no_expression(spark, monkeypatch):
    plans = []

    def recorded(df, name="settled"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, name)

    monkeypatch.setattr(ranking, "settle", recorded)
    rows = [(q, d, d * 7 % 5 + d * 1e-13) for q in (1, 2) for d in range(40)] + [(3, 1, None), (3, 2, -1.0)]
    scored = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double")
    got = sorted(tuple(row) for row in ranking.rank_all(scored).select("query_id", "rank", "doc_id").collect())
    sorts = [line for line in "\n".join(plans).splitlines() if "Sort" in line or "RepartitionByExpression" in line]
    assert sorts and not any("round(" in line for line in sorts)
    want = []
    for q in (1, 2, 3):
        own = sorted((r for r in rows if r[0] == q), key=lambda r: (r[2] is None, -round(r[2] or 0, 10), r[1]))
        want += [(q, place, r[1]) for place, r in enumerate(own, 1)]
    assert got == want
    best = ranking.top_k(scored, 3)
    assert best.columns == ["query_id", "doc_id", "score", "rank"]
    assert sorted(tuple(r) for r in best.select("query_id", "rank", "doc_id").collect()) == [w for w in want if w[1] < 4]


def test_mixed_log_search_takes_every_conversation(spark, tmp_path):
    texts = ["pan vino", "vino agua", "pan y agua", "pan", "queso", None]
    documents = [(i, texts[i % 6]) for i in range(12)]
    turns = [(c, t, "user", texts[(c + t) % 3]) for c in range(151) for t in range(6)] + [(None, 1, "user", "pan")]
    spark.createDataFrame(documents, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(turns, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(tuple(r) for r in entry.queries()["mixed_log_search"](spark, str(tmp_path)).select("query_id", "doc_id").collect())
    asked = {(c + t) * (c + t + 1) // 2 + t for c in range(151) for t in range(6)}
    answered = {query for query, _ in got}
    # Phrases and patterns of these turns are in some document each; negations are as they fall.
    assert {query for query in asked if query % 6 in (1, 2)} <= answered <= asked
    assert {query % 6 for query in answered} == {0, 1, 2}
    duck = duckdb.connect()
    for name in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == sorted(duck.sql(f"SELECT query_id, doc_id FROM ({entry.oracle_sql()['mixed_log_search']})").fetchall())
