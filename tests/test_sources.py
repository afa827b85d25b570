"""Reading files, storing indexes and ingesting a folder continuously."""

import uuid

from termloom import build_index, load_index, ranked_search, read_text_files
from termloom.sources.index_store import current_version, index_corpus
from termloom.streaming.ingest import ingest_stream


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def search_one(spark, index, q):
    log = spark.createDataFrame([(1, q)], "query_id bigint, q string")
    return [r["filename"] for r in ranked_search(index, log).orderBy("rank").collect()]


def test_text_files(spark, tmp_path):
    write(tmp_path, "Uno dos+tres%20ñ.TXT", "primera línea\nsegunda línea\n")
    write(tmp_path, "sin_extension", "otra cosa")
    files = {r["filename"]: r for r in read_text_files(spark, str(tmp_path)).collect()}
    assert set(files) == {"Uno dos+tres%20ñ.TXT", "sin_extension"}
    assert files["Uno dos+tres%20ñ.TXT"]["text"] == "primera línea\nsegunda línea\n"
    index = build_index(read_text_files(spark, str(tmp_path)))
    assert search_one(spark, index, "CADENA(linea segunda)") == ["Uno dos+tres%20ñ.TXT"]


def test_last_file_of_a_name_wins(spark, tmp_path):
    import os

    for folder, name, text, when in (("x", "a.txt", "viejo", 100), ("y", "A.txt", "nuevo", 200),
                                     ("z", "a.txt", "12", 300)):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, name, text)
        os.utime(tmp_path / folder / name, (when, when))
    index = build_index(read_text_files(spark, [str(tmp_path / f) for f in "xyz"]))
    assert search_one(spark, index, "viejo OR nuevo OR PATRON()") == ["A.txt"]
    assert search_one(spark, index, "viejo") == []


def test_stored_index_without_documents(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, filename string, text string")
    index = index_corpus(empty, str(tmp_path))
    assert index.documents.count() == index.postings.count() == index.terms.count() == 0
    assert search_one(spark, index, "queso OR NOT vino") == []


def test_stored_index_spreads_terms_over_buckets(spark, golden_docs, tmp_path, monkeypatch):
    from termloom.sources import index_store

    monkeypatch.setattr(index_store, "TOKENS_PER_BUCKET", 5)
    index = index_corpus(golden_docs, str(tmp_path))
    assert index.stored.layouts == [3]
    assert search_one(spark, index, "queso AND cabra") == ["uno.txt"]
    assert search_one(spark, index, "CADENA(cabra come) OR PATRON(tint)") == ["dos.txt", "cuatro.txt"]


def test_ingest_stream(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    root, progress = str(tmp_path / "index"), str(tmp_path / uuid.uuid4().hex)
    write(inbox, "a.txt", "queso fresco")
    write(inbox, "b.txt", "123")
    ingest_stream(spark, str(inbox), root, progress).awaitTermination()
    first = load_index(spark, root)
    assert search_one(spark, first, "PATRON(ques) OR fresco") == ["a.txt"]
    assert current_version(spark, root).last == 1

    write(inbox, "c.txt", "vino y queso")
    write(inbox, "A.txt", "pan")
    ingest_stream(spark, str(inbox), root, progress).awaitTermination()
    second = load_index(spark, root)
    assert current_version(spark, root).last == 2
    assert sorted(search_one(spark, second, "PATRON()")) == ["A.txt", "c.txt"]
    assert search_one(spark, second, "fresco") == []
