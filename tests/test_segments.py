"""Batches and streams: nothing is lost, nothing is written twice."""

import gzip
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_maintenance import BATCH, FINAL, contents

from termloom import build_index, ingest_report, load_index, match_phrases, parse_query_log, ranked_search, read_text_files, upsert
from termloom.operators import matching
from termloom.operators.matching import expand_patterns, leaf_values, match_patterns
from termloom.session import settle
from termloom.sources import index_store
from termloom.sources.index_store import add_batch, compact, current_version, index_corpus
from termloom.streaming import ingest
from termloom.streaming.ingest import ingest_stream

SCHEMA = "filename string, seq bigint, text string"


def files_under(root):
    return {str(path.relative_to(root)) for path in Path(root).rglob("*.parquet") if path.is_file()}


@pytest.fixture
def stored(golden_docs, tmp_path):
    root = str(tmp_path / "index")
    index_corpus(golden_docs, root)
    return root


def test_batch_equals_rebuild(spark, stored):
    index = add_batch(spark, stored, spark.createDataFrame(BATCH, SCHEMA))
    final = [(i, name, text) for i, (name, text) in enumerate(FINAL.items())]
    rebuilt = build_index(spark.createDataFrame(final, "doc_id bigint, filename string, text string"))
    assert contents(index) == contents(rebuilt)
    again = add_batch(spark, stored, spark.createDataFrame([("dos.txt", 1, "pan")], SCHEMA))
    before = contents(again)
    assert ("pan", 1, 1) in before[1] and not any(row[0] == "hierba" and row[1] == 2 for row in before[1])
    assert contents(compact(spark, stored)) == before
    version = current_version(spark, stored)
    assert version.base == version.last == 4


def test_batch_writes_only_its_own_partitions(spark, stored):
    before = files_under(stored)
    add_batch(spark, stored, spark.createDataFrame([("uno.txt", 1, "pan y vino")], SCHEMA))
    new = files_under(stored) - before
    assert before <= files_under(stored)
    assert all("/batch=2/" in f"/{name}" for name in new)
    assert not any(name.endswith(".json") for name in map(str, Path(stored).rglob("*")))
    postings = spark.read.parquet(*[f"{stored}/{name}" for name in new if name.startswith("postings")])
    assert sorted(row["term"] for row in postings.collect()) == ["pan", "vino"]
    documents = spark.read.parquet(*[f"{stored}/{name}" for name in new if name.startswith("documents")])
    assert documents.count() == 1


def test_a_batch_that_broke_off_does_not_count_and_is_written_again(spark, stored, monkeypatch):
    before = contents(index_store.load_index(spark, stored))
    batch = spark.createDataFrame([("uno.txt", 1, "pan"), ("neu.txt", 2, "vino")], SCHEMA)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(index_store, "_finish", broken)
        with pytest.raises(RuntimeError):
            add_batch(spark, stored, batch)
    assert contents(load_index(spark, stored)) == before
    again = contents(add_batch(spark, stored, batch))
    assert {row[0] for row in again[0]} == {"uno.txt", "dos.txt", "tres.txt", "cuatro.txt", "neu.txt"}
    assert ("pan", 1, 1) in again[1]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replaced_documents_are_left_out_behind_the_term_join(spark, stored):
    index = add_batch(spark, stored, spark.createDataFrame(BATCH, SCHEMA))
    wanted = spark.createDataFrame([("queso",)], "term string")
    from termloom.operators.indexing import probe_postings

    text = plan(probe_postings(index, F.broadcast(wanted), ["doc_id"])).split("== Initial Plan ==")[0]
    # The plan is printed from the top: what stands first happens last.
    assert text.index("LeftOuter") < text.index("Inner")
    assert "dynamicpruning" in text


def test_batches_have_buckets_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "TOKENS_PER_BUCKET", 5)
    root = str(tmp_path / "index")
    index_corpus(spark.createDataFrame([(0, "a.txt", "pan")], "doc_id bigint, filename string, text string"), root)
    words = " ".join(f"palabra{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5))
    index = add_batch(spark, root, spark.createDataFrame([("b.txt", 1, words), ("c.txt", 2, "pan")], SCHEMA))
    assert index.stored.layouts == [0, 3]
    assert index.stored.postings.select("bits", "bucket").distinct().count() > 4
    log = spark.createDataFrame([(1, "pan"), (2, "palabrafe"), (3, "PATRON(abrafe)")], "query_id bigint, q string")
    found = {(r.query_id, r.filename) for r in ranked_search(index, log).collect()}
    assert found == {(1, "a.txt"), (1, "c.txt"), (2, "b.txt"), (3, "b.txt")}


def test_patterns_use_the_stored_grams(spark, stored):
    leaves = settle(parse_query_log(spark.createDataFrame([(1, "PATRON(ues) PATRON(q) PATRON(am%na) PATRON(zz)")], "query_id bigint, q string")))
    index = load_index(spark, stored)
    df = expand_patterns(index, leaf_values(leaves, "pattern"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # The only lists taken apart are those of the patterns; no dictionary term is cut.
    assert all("substring(term" not in line for line in text.splitlines() if "Generate" in line)
    assert "Relation [gram#" in text and "df#" not in text
    assert match_patterns(index, leaves).count() > 0


@pytest.mark.parametrize("replaced", [False, True])
def test_grams_find_what_a_scan_finds(spark, stored, replaced):
    index = load_index(spark, stored)
    if replaced:
        index = add_batch(spark, stored, spark.createDataFrame(BATCH, SCHEMA))
    patterns = ["ues", "q", "am", "am%n", "a_i", "___", "_a%", "%", "o", "queso", "quesoo", "z", "%%b%", "é", "c%z"]
    wanted = spark.createDataFrame([(p,) for p in patterns], "value string")
    got = {(r.value, r.term) for r in expand_patterns(index, wanted).collect()}
    terms = index.terms.select("term").crossJoin(wanted)
    want = terms.filter("term LIKE concat('%', value, '%')").collect()
    assert got == {(r.value, r.term) for r in want} and got


def test_phrases_of_frequent_words_use_pairs(spark, tmp_path, monkeypatch):
    import random

    draw = random.Random(3)
    words = ["uno", "dos", "tres", *(f"raro{chr(97 + i)}" for i in range(20))]
    weights = [30, 20, 10, *[1] * 20]
    docs = [(i, f"{i}.txt", " ".join(draw.choices(words, weights, k=40))) for i in range(60)]
    monkeypatch.setattr(index_store, "FREQUENT_TERMS", 9)
    index = index_corpus(spark.createDataFrame(docs[:40], "doc_id bigint, filename string, text string"), str(tmp_path))
    assert set(index.stored.frequent) == {"uno", "dos", "tres"}
    more = [(name, i, text) for i, name, text in docs[40:]] + [("3.txt", 99, "dos uno dos")]
    index = add_batch(spark, str(tmp_path), spark.createDataFrame(more, SCHEMA))
    texts = {name: text for _, name, text in docs} | {"3.txt": "dos uno dos"}
    phrases = ["uno dos", "uno uno", "uno raroa", "raroa uno dos", "dos uno dos", "uno uno uno", "rarob raroc", "tres", "uno dos raroa dos"]
    log = spark.createDataFrame([(i, f"CADENA({p})") for i, p in enumerate(phrases)], "query_id bigint, q string")
    leaves = settle(parse_query_log(log))
    names = index.documents.select("doc_id", "filename")
    got = {(r.query_id, r.filename) for r in match_phrases(index, leaves).join(names, "doc_id").collect()}
    assert got == {(i, name) for i, p in enumerate(phrases) for name, text in texts.items() if f" {p} " in f" {text} "}
    # A phrase of two frequent words reads their pair and neither word's positions.
    only = settle(parse_query_log(log.filter("query_id = 0")))
    text = plan(match_phrases(index, only))
    assert "EqualTo(term,uno dos)" in text or "In(term, [uno dos])" in text
    assert "EqualTo(term,uno)" not in text and "uno," not in text
    monkeypatch.setattr(matching, "LITERAL_TERMS", 0)
    assert match_phrases(index, only).count() == sum(query_id == 0 for query_id, _ in got)


def test_batch_needs_an_order_and_gets_its_own_ids(spark, golden_index, stored):
    with pytest.raises(ValueError):
        upsert(golden_index, spark.createDataFrame([("a.txt", "pan")], "filename string, text string"))
    with pytest.raises(ValueError):
        add_batch(spark, stored, spark.createDataFrame([("a.txt", "pan")], "filename string, text string"))
    clash = spark.createDataFrame([(2, "c.txt", 1, "pan")], f"doc_id bigint, {SCHEMA}")
    for index in (upsert(golden_index, clash), add_batch(spark, stored, clash)):
        ids = [row["doc_id"] for row in index.documents.collect()]
        assert len(ids) == len(set(ids)) == 5


@pytest.mark.parametrize("turned", [False, True])
def test_versions_of_equal_rank_do_not_depend_on_row_order(spark, turned):
    start = "x" * 300
    rows = [("a.txt", 1, f"{start} uno"), ("a.txt", 1, f"{start} dos")]
    index = build_index(spark.createDataFrame(rows[::-1] if turned else rows, SCHEMA))
    terms = {row["term"] for row in index.terms.collect()}
    assert terms == {start, "dos"} or terms == {start, "uno"}
    winners = getattr(test_versions_of_equal_rank_do_not_depend_on_row_order, "seen", terms)
    test_versions_of_equal_rank_do_not_depend_on_row_order.seen = terms
    assert terms == winners


def damaged(folder, name):
    whole = gzip.compress(b"texto " * 2000)
    (folder / name).write_bytes(whole[: len(whole) // 2])


def test_unreadable_files_are_reported(spark, golden_index, tmp_path):
    (tmp_path / "bien.txt").write_text("queso")
    (tmp_path / "vacio.txt").write_text("123")
    damaged(tmp_path, "mal.txt.gz")
    (tmp_path / "latin.txt").write_bytes("año".encode("latin-1"))
    files = read_text_files(spark, str(tmp_path))
    report = {row["doc_key"]: (row["status"], row["filepath"]) for row in ingest_report(golden_index, files).collect()}
    assert {key: status for key, (status, _) in report.items()} == {
        "bien.txt": "indexed", "vacio.txt": "skipped", "mal.txt.gz": "failed", "latin.txt": "failed",
    }
    assert report["mal.txt.gz"][1].endswith("/mal.txt.gz")


def test_two_inboxes_and_an_unreadable_file(spark, tmp_path):
    root = str(tmp_path / "index")
    for inbox, name in (("a", "uno.txt"), ("b", "dos [x].txt")):
        folder = tmp_path / inbox
        folder.mkdir()
        (folder / name).write_text("queso fresco")
        ingest_stream(spark, str(folder), root, str(tmp_path / f"progress-{inbox}")).awaitTermination()
    damaged(tmp_path / "b", "roto.gz")
    ingest_stream(spark, str(tmp_path / "b"), root, str(tmp_path / "progress-b")).awaitTermination()
    (tmp_path / "b" / "tres.txt").write_text("vino")
    ingest_stream(spark, str(tmp_path / "b"), root, str(tmp_path / uuid.uuid4().hex)).awaitTermination()
    index = load_index(spark, root)
    assert {row["filename"] for row in index.documents.collect()} == {"uno.txt", "dos [x].txt", "tres.txt"}
    log = spark.createDataFrame([(1, "queso")], "query_id bigint, q string")
    paths = {row["filename"]: row["filepath"] for row in ranked_search(index, log).collect()}
    assert set(paths) == {"uno.txt", "dos [x].txt"} and paths["uno.txt"].endswith("/a/uno.txt")
    reports = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/reports").collect()
    assert ("roto.gz", "failed") in {(row["doc_key"], row["status"]) for row in reports}


def test_every_status_in_one_report(spark, golden_index):
    rows = [("nuevo.txt", 1, "pan"), ("uno.txt", 2, "pan"), ("x.txt", 3, "de 12"), ("y.txt", 4, None)]
    report = ingest_report(golden_index, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row["status"] for row in report} == {"indexed", "re-indexed", "skipped", "failed"}


def test_report_is_complete_after_a_crash(spark, tmp_path, monkeypatch):
    inbox, root, progress = tmp_path / "in", str(tmp_path / "index"), str(tmp_path / "progress")
    inbox.mkdir()
    (inbox / "uno.txt").write_text("queso")
    ingest_stream(spark, str(inbox), root, progress).awaitTermination()
    (inbox / "dos.txt").write_text("vino")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "add_batch", crash)
        with pytest.raises(Exception, match="lost"):
            ingest_stream(spark, str(inbox), root, progress).awaitTermination()
    ingest_stream(spark, str(inbox), root, progress).awaitTermination()
    reports = spark.read.parquet(f"{root}/reports")
    assert sorted((r.batch_id, r.doc_key, r.status) for r in reports.collect()) == [
        (0, "uno.txt", "indexed"), (1, "dos.txt", "indexed"),
    ]
    assert load_index(spark, root).documents.count() == 2
