"""Upserted postings get the key of their document without being moved to the documents."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from termloom import load_index, upsert
from termloom.operators.indexing import keyed_postings
from termloom.sources.index_store import add_batch, compact, index_corpus
from termloom.session import settle

SCHEMA = "doc_id bigint, filename string, text string"
DOCS = [(1, "uno", "pan vino pan"), (2, "dos", "vino agua"), (2, "otro", "agua agua sal"), (3, "tres", "pan"),
        (3, "tres", "pan"), (4, None, "queso pan"), (5, "cinco", "sal sal vino"), (6, "seis", "de la")]
BATCH = [("UNO", 1, "nuevo vino"), ("siete", 1, "pan nuevo"), ("cinco", 2, "..."), ("siete", 2, "agua Évora")]


def _rows(df):
    return sorted(map(str, df.select("doc_key", "term", "tf", F.array_join("positions", ",")).collect()))


def test_no_posting_is_shuffled_for_its_key(spark, tmp_path):
    words = ["pan", "vino", "agua", "queso", "sal"]
    documents = [(i, " ".join(words[(i * k) % 5] for k in range(1, 9))) for i in range(30)] + [(30, None), (31, "12")]
    turns = [(c, t, "user", words[(c + t) % 5] + " nuevo") for c in range(0, 12, 2) for t in range(3)]
    tables = {"documents": (documents, "doc_id bigint, text string"),
              "conversations": (turns, "conv_id bigint, turn bigint, role string, text string"),
              "benchmark": ([(1, "pan y queso")], "item_id bigint, text string")}
    duck = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    df = entry.queries()["upsert_postings"](spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    want = duck.sql(f"SELECT doc_key, term, tf, positions FROM ({entry.oracle_sql()['upsert_postings']})").fetchall()
    assert sorted(tuple(r) for r in df.select("doc_key", "term", "tf", "positions").collect()) == sorted(want) and want


@pytest.mark.parametrize("kind", ["base", "layers", "compact"])
def test_shared_ids_get_every_key(spark, tmp_path, kind):
    index = index_corpus(spark.createDataFrame(DOCS, SCHEMA), str(tmp_path))
    batch = spark.createDataFrame(BATCH, "filename string, seq bigint, text string")
    if kind != "base":
        index = add_batch(spark, str(tmp_path), batch.filter("filename <> 'UNO'"))
    if kind == "compact":  # made from postings, so without tokens
        compact(spark, str(tmp_path))
        index = load_index(spark, str(tmp_path))
    new = upsert(index, batch)
    assert (new.parsed is None) == (kind == "compact")
    want = new.postings.join(settle(new.documents.select("doc_id", "doc_key")), "doc_id")
    assert _rows(keyed_postings(new)) == _rows(want)
    assert len(_rows(want)) > 15
