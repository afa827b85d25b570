"""Updating an index must equal building it anew."""

import pytest
from pyspark.sql import functions as F

from termloom import build_index, ingest_report, load_index, ranked_search, save_index, upsert
from termloom.sources.index_store import current_version

BATCH = [
    ("UNO.txt", 1, "primera version"),
    ("uno.TXT", 2, "vino nuevo y queso"),
    ("uno.txt", 3, "123 de la"),
    ("dos.txt", 4, "..."),
    ("seis.txt", 5, "hierba alta"),
    ("cinco.txt", 6, "ahora con texto"),
    ("nulo.txt", 7, None),
]
FINAL = {
    "uno.txt": "vino nuevo y queso",
    "dos.txt": "La cabra come hierba; la cabra camina.",
    "tres.txt": "Camión rojo, camión azul: el camión no camina 123.",
    "cuatro.txt": "queso-cabra y vino. Vino tinto.",
    "cinco.txt": "ahora con texto",
    "seis.txt": "hierba alta",
}


def contents(index):
    keys = index.documents.select("doc_id", "doc_key")
    documents = {
        (r["doc_key"], r["snippet"], r["total_terms"], round(r["doc_magnitude"], 9))
        for r in index.documents.collect()
    }
    terms = {(r["term"], r["df"], r["cf"]) for r in index.terms.collect()}
    postings = {
        (r["doc_key"], r["term"], r["tf"], r["doc_terms"], tuple(r["positions"]))
        for r in index.postings.join(keys, "doc_id").collect()
    }
    return documents, terms, postings


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(BATCH, "filename string, seq bigint, text string")


@pytest.fixture(scope="module")
def updated(golden_index, batch):
    return upsert(golden_index, batch)


def test_upsert_equals_rebuild(spark, updated):
    final = [(i, name, text) for i, (name, text) in enumerate(FINAL.items())]
    rebuilt = build_index(spark.createDataFrame(final, "doc_id bigint, filename string, text string"))
    assert contents(updated) == contents(rebuilt)


def test_counters_add_up(updated):
    tokens = updated.documents.agg(F.sum("total_terms")).first()[0]
    assert updated.terms.agg(F.sum("cf")).first()[0] == tokens
    assert updated.terms.filter("df > cf OR df <= 0").count() == 0
    assert updated.terms.filter("term = 'manchego'").count() == 0


def test_ids_are_unique(updated):
    ids = [r["doc_id"] for r in updated.documents.collect()]
    assert len(ids) == len(set(ids)) == len(FINAL)


def test_report(golden_index, batch):
    rows = ingest_report(golden_index, batch).orderBy("seq").collect()
    assert [(r["doc_key"], r["status"]) for r in rows] == [
        ("uno.txt", "re-indexed"), ("uno.txt", "re-indexed"), ("uno.txt", "skipped"),
        ("dos.txt", "skipped"), ("seis.txt", "indexed"), ("cinco.txt", "indexed"),
        ("nulo.txt", "failed"),
    ]


def test_repeated_arrival_is_reindexed(spark, golden_index):
    rows = [("a.txt", 1, "algo"), ("a.txt", 2, "otra cosa"), ("a.txt", 0, "99")]
    files = spark.createDataFrame(rows, "filename string, seq bigint, text string")
    report = ingest_report(golden_index, files).orderBy("seq").collect()
    assert [r["status"] for r in report] == ["skipped", "indexed", "re-indexed"]


def test_versions(spark, golden_index, updated, tmp_path):
    root = str(tmp_path)
    assert current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        load_index(spark, root)
    first = save_index(golden_index, root)
    old = contents(first)
    second = save_index(upsert(first, spark.createDataFrame(BATCH, "filename string, seq bigint, text string")), root)
    assert current_version(spark, root).last == 2
    assert contents(load_index(spark, root)) == contents(second) == contents(updated)
    assert contents(first) == old


def test_repeated_term_outranks_single_mention(spark):
    docs = [(1, "largo.txt", "una mencion del tema " + "relleno " * 60),
            (2, "corto.txt", "tema tema tema relleno"), (3, "otro.txt", "nada")]
    index = build_index(spark.createDataFrame(docs, "doc_id bigint, filename string, text string"))
    log = spark.createDataFrame([(1, "tema")], "query_id bigint, q string")
    rows = ranked_search(index, log).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == [2, 1]
    assert rows[0]["score"] > rows[1]["score"]
