"""The build works texts out once, for many documents at a time, and finds the tokens that columns find."""

from pyspark.sql import functions as F

from termloom.functions.text import normalize_tokens
from termloom.operators import indexing
from termloom.operators.indexing import frequent_pairs, parse_corpus, parse_documents
from termloom.operators.maintenance import ingest_report

TEXTS = [
    "".join(map(chr, range(128))) * 2,
    "Pan-de\x0bVino\x85  9 pan\tPAN\n\r\x0cvino\x1cpan",
    "Ñandú 山 \U0001f600x Kelvin İstanbul Straße ﬁn ﾊﾟﾝ ภาษาไทย",
    " de la que ", "", None, "12 34", "y", "a" * 3_000 + " " + "pan vino " * 5_000,
    "Camión rojo, camión azul", "queso de cabra y queso",
]
SCHEMA = "doc_id bigint, filename string, text string"


def _docs(spark):
    return spark.createDataFrame([(at, f"{at}.txt", text) for at, text in enumerate(TEXTS)], SCHEMA)


def test_entries_are_the_tokens_of_the_columns(spark):
    want, totals = {}, {}
    for doc_id, tokens in _docs(spark).select("doc_id", normalize_tokens(F.col("text"))).collect():
        for at, token in enumerate(tokens or []):
            want.setdefault((doc_id, token), []).append(at)
            totals[doc_id] = at + 1
    rows = parse_documents(_docs(spark)).collect()
    assert {row.doc_id: row.total_terms for row in rows} == totals
    got = {(row.doc_id, e.term): (e.tf, e.positions) for row in rows for e in row.entries}
    assert got == {key: (len(places), places) for key, places in want.items()}
    for row in rows:
        assert [e.term for e in row.entries] == sorted(e.term for e in row.entries)
        assert abs(row.doc_magnitude - sum(e.tf**2 for e in row.entries) ** 0.5 / row.total_terms) < 1e-12


def test_texts_are_worked_out_in_batches_and_once(spark):
    plan = parse_documents(_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "split" not in plan


def test_nothing_to_index(spark):
    none = _docs(spark).filter("doc_id in (3, 4, 5, 6)")
    assert parse_documents(none).count() == 0
    lone = parse_documents(_docs(spark).filter("doc_id = 10"))
    assert frequent_pairs(lone, ["queso", "pan"]).count() == 0
    assert frequent_pairs(lone, []).count() == 0


def test_versions_are_written_once(spark, monkeypatch):
    written, settle = [], indexing.settle
    monkeypatch.setattr(indexing, "settle", lambda df, name="settled": written.append(df.columns) or settle(df, name))
    rows = [("A.txt", 0, "pan vino"), ("a.txt", 1, "agua"), ("b.txt", 0, "pan"), (None, 0, "vino"), (None, None, "pan")]
    batch = spark.createDataFrame(rows, "filename string, seq bigint, text string")
    winners = parse_corpus(batch, 40, indexing.settle)
    assert sum("entries" in columns for columns in written) == 1
    got = {(row.filename, row.entries[0].term) for row in winners.collect()}
    assert got == {("a.txt", "agua"), ("b.txt", "pan"), (None, "vino")}
    ids = [row.doc_id for row in winners.select("doc_id").collect()]
    assert len(set(ids)) == 3 and min(ids) > 40
    assert {"row", "seq", "text_hash"}.isdisjoint(winners.columns)


def test_report_cuts_each_text_once(spark, golden_index):
    rows = [("uno.txt", 0, "pan"), ("x.txt", 0, None), ("x.txt", 1, "de la"), ("x.txt", 2, "vino"), ("x.txt", 3, "pan")]
    report = ingest_report(golden_index, spark.createDataFrame(rows, "filename string, seq bigint, text string"))
    assert "text" not in report._jdf.queryExecution().optimizedPlan().toString()
    status = {(row.doc_key, row.seq): row.status for row in report.collect()}
    assert status == {
        ("uno.txt", 0): "re-indexed", ("x.txt", 0): "failed", ("x.txt", 1): "skipped",
        ("x.txt", 2): "indexed", ("x.txt", 3): "re-indexed",
    }
