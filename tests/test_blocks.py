"""Postings are stored by blocks of a term: nothing is sampled, only blocks are sorted, and no posting is lost."""

import random

import pytest
from pyspark.sql import functions as F

from termloom.functions import runs
from termloom.functions.runs import posting_blocks
from termloom.operators.indexing import frequent_pairs, parse_documents, posting_rows
from termloom.sources import index_store
from termloom.sources.index_store import index_corpus

SCHEMA = "doc_id bigint, filename string, text string"


def _docs(spark, n=60):
    draw = random.Random(5)
    words = ["uno", "dos", "Ñandú", "de", "tres-12", *(f"raro{chr(97 + i)}" for i in range(20))]
    weights = [30, 20, 10, 10, 5, *[1] * 20]
    rows = [(i, f"{i}.txt", " ".join(draw.choices(words, weights, k=draw.randrange(60)))) for i in range(n)]
    rows += [(7, "again.txt", "uno dos uno"), (None, "no id", "uno dos"), (n, "x", None), (n + 1, "y", "12 de")]
    rows += [(n + 2, "long", "uno dos tres " * 2_000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("most", [100, 16 << 20])
def test_blocks_hold_every_posting_and_pair(spark, monkeypatch, most):
    monkeypatch.setattr(runs, "SLICE_BYTES", most)
    docs = _docs(spark)
    plain, spelled = parse_documents(docs), parse_documents(docs, spelled=True)
    columns = ["doc_id", "term", "tf", "doc_terms", "positions"]

    def rows(df):
        return sorted(map(repr, df.collect()))

    blocks = posting_blocks(spelled)
    assert rows(blocks.select("term", F.inline("docs")).select(*columns)) == rows(posting_rows(plain).select(*columns))
    for row in blocks.collect():
        ids = [doc.doc_id for doc in row.docs]
        assert row.places == sum(len(doc.positions) for doc in row.docs) and row.first == ids[0]
        assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)
    often = ["uno", "dos", "nandu"]
    got = posting_blocks(spelled, often).select("term", F.inline("docs")).select("doc_id", "term", "positions")
    assert rows(got) == rows(frequent_pairs(plain, often))
    assert posting_blocks(spelled, []).count() == 0
    same = ["doc_id", "total_terms", "doc_magnitude", F.transform("entries", lambda e: F.struct(e["term"], e["tf"])).alias("e")]
    assert [tuple(map(str, r)) for r in rows_of(plain, same)] == [tuple(map(str, r)) for r in rows_of(spelled, same)]


def rows_of(df, columns):
    return sorted(([r[0], r[1], r[2], [tuple(e) for e in r[3]]] for r in df.select(*columns).collect()), key=repr)


def test_parts_are_sorted_and_large_blocks_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "PLACES_TO_DEAL", 5)
    monkeypatch.setattr(runs, "SLICE_BYTES", 500)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    index = index_corpus(_docs(spark), str(tmp_path))
    assert spark.conf.get(name) == before
    stored = index.stored.postings.select("term", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    files, parts = {}, {}
    for row in stored.orderBy("at").collect():
        files.setdefault(row.file, []).append(row.term)
        parts.setdefault(row.term, set()).add(row.file)
    assert all(terms == sorted(terms) for terms in files.values())
    assert len(parts["uno"]) > 1 and len(parts["raroa"]) == 1
    assert index.postings.count() == posting_rows(parse_documents(_docs(spark))).count()
    written = spark.read.parquet(f"{tmp_path}/entries").schema
    assert "tokens" in written.names and "positions" not in written["entries"].simpleString()
