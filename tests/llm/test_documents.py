import random
import re

import brute
import duckdb
import numpy as np
import pytest
from messy_texts import messy_texts
from pyspark.sql import functions as F
from termloom.llm.language import UNDETERMINED, held_out, identify_languages, keep_determined, learn_languages
from termloom.llm.multiset import PHRASE, as_text, combined, fingerprint_edits, likeness, with_fingerprint
from termloom.llm.queries import llm_oracle_sql, llm_queries
from termloom.llm.secret_scan import KINDS, redact_secrets, scan_secrets
from termloom.llm.simhash import components, golay_keys, keep_one, links, near_duplicates
from termloom.llm.substrings import drop_repeats, remove_repeats
from termloom.llm.vectors import top_k


def key(doc_id):
    return -1 if doc_id is None else doc_id


# Substrings ----------------------------------------------------------------------------


@pytest.mark.parametrize("length", [2, 7, 10, 50, 51])
def test_repeats_are_removed(messy, length):
    docs = [(i, t) for i, t, _, _ in messy_texts()]
    want = sorted((key(i), *row) for (i, _), row in zip(docs, brute.without_repeats(docs, length)))
    got = sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept) for r in remove_repeats(messy, length).collect())
    assert got == want
    assert any(row[2] for row in got)


def test_repeats_in_random_texts(spark):
    draw = random.Random(1)
    for _ in range(3):
        docs = [(i, " ".join(draw.choices("ab", k=draw.randint(0, 60)))) for i in range(30)]
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), 8).collect()}
        assert got == {i: row for (i, _), row in zip(docs, brute.without_repeats(docs, 8))}


def test_length_of_one_word_is_refused(messy):
    with pytest.raises(ValueError):
        remove_repeats(messy, 1)


def test_dropped_repeats_keep_all_columns(messy):
    out = drop_repeats(messy)
    assert out.schema == messy.schema
    rows = out.collect()
    docs = [(i, t) for i, t, _, _ in messy_texts()]
    want = []
    for (i, text), (n, removed, kept) in zip(docs, brute.without_repeats(docs, 50)):
        if not removed:
            want.append((key(i), text or "", len(text or "")))
        elif kept:
            want.append((key(i), kept, len(kept)))
    assert sorted((key(r.doc_id), r.text or "", r.n_chars) for r in rows) == sorted(want)


def test_repeats_of_nothing(no_docs):
    assert remove_repeats(no_docs).count() == 0
    assert drop_repeats(no_docs).count() == 0


# SimHash -------------------------------------------------------------------------------


def test_golay_keys_meet_within_two_bits():
    draw = random.Random(3)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        keys, places = golay_keys(np.array([a, b], dtype=np.uint64))
        assert set(keys[places == 0]) & set(keys[places == 1])


@pytest.mark.parametrize("crowd", [5, 60])
@pytest.mark.parametrize("most", [0, 1, 2])
def test_links_join_what_is_linked(spark, crowd, most):
    draw = random.Random(crowd)
    values = set()
    for _ in range(40 if crowd == 5 else 4):
        centre = draw.getrandbits(64)
        values.update(centre ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(crowd))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    found = components(links(spark.createDataFrame([(v,) for v in values], "fingerprint bigint"), most))
    root = {r.node: r.root for r in found.collect()}
    want = brute.linked([v & (2**64 - 1) for v in values], most)
    assert [root.get(v, v) for v in values] == [values[w] for w in want]


def test_chain_of_links_is_one_component(spark):
    edges = [(i, i + 1) for i in range(200)]
    draw = random.Random(0)
    draw.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 201)}


def test_near_duplicates(messy):
    docs = sorted(((i, t) for i, t, _, _ in messy_texts()), key=lambda d: (d[0] is None, d[0] or 0))
    prints = [brute.simhash(t) for _, t in docs]
    want = sorted((key(i), p, key(docs[root][0])) for (i, _), p, root in zip(docs, prints, brute.linked(prints)))
    got = near_duplicates(messy).collect()
    assert sorted((key(r.doc_id), r.fingerprint & (2**64 - 1), key(r.component_id)) for r in got) == want


def test_no_links_and_no_components(spark):
    none = spark.createDataFrame([], "fingerprint bigint")
    assert links(none, 2).count() == 0
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    again = spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "a bigint, b bigint")
    assert sorted(tuple(r) for r in components(again).collect()) == [(2, 1), (3, 1)]


def test_near_duplicates_of_nothing(no_docs):
    assert keep_one(no_docs).count() == 0
    assert near_duplicates(no_docs).count() == 0


# Secrets -------------------------------------------------------------------------------


def test_base_spans_stay_and_owned_ones_are_added(messy):
    got = scan_secrets(messy).collect()
    base = sorted((key(r.doc_id), [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3]) for r in got)
    assert base == sorted((key(i), brute.base_spans(t)) for i, t, _, _ in messy_texts())
    added = {r.doc_id: [KINDS[s.kind] for s in r.spans if s.kind == 3] for r in got}
    assert added[11] == added[12] == ["owned"]  # one owner
    assert added[16] == added[17] == added[18] == []  # three owners: an example


def test_redaction_keeps_columns_and_examples(messy):
    out = redact_secrets(messy)
    assert out.schema == messy.schema
    rows = out.collect()
    assert len(rows) == len(messy_texts())
    texts = {r.doc_id: r.text for r in rows}
    assert texts[10] == "[SECRET] <|endoftext|> [SECRET]".replace("[SECRET] <", '[SECRET]" <')
    assert "Zz91" not in texts[12] and "aB3dE6" in texts[16] and texts[4] is None
    assert all(r.n_chars == len(r.text or "") for r in rows)


def test_an_example_of_one_owner_is_known_by_its_many_texts(spark):
    rows = [(i, f"example number {i} Zz91Kq83Lm27Xp45 here", "hot") for i in range(12)]
    rows += [(50 + i, "own Yy82Jp74Kl16Wo34 value", f"o{i}") for i in range(5)]  # copies of one text
    rows += [(70, "host mail7.example.com", "a"), (71, "see mail7.example.com", "b"), (72, "at mail7.example.com", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    added = {r.doc_id: [s.kind for s in r.spans] for r in scan_secrets(docs).collect()}
    assert all(added[i] == [] for i in range(12)) and added[70] == added[71] == added[72] == []
    assert all(added[50 + i] == [KINDS.index("owned")] for i in range(5))


def test_secrets_of_nothing(no_docs):
    assert redact_secrets(no_docs).count() == 0
    assert scan_secrets(no_docs).count() == 0


# Multiset hash -------------------------------------------------------------------------


def test_edited_texts(messy):
    rows = fingerprint_edits(messy).select(
        "doc_id", "n_chars", "edited", as_text(F.col("own")).alias("shown"),
        likeness(F.col("own"), F.col("changed")).alias("near"), likeness(F.col("own"), F.col("own")).alias("same"),
    ).collect()
    assert len(rows) == len(messy_texts())
    assert all(r.same == 1.0 and 0 <= r.near <= 1 for r in rows)
    by_id = brute.groups((i, t or "") for i, t, _, _ in messy_texts())
    ids = sorted(i for i in by_id if i is not None)
    for i, following in zip(ids, ids[1:]):
        if len(by_id[i]) == len(by_id[following]) == 1:
            text, after = by_id[i][0], by_id[following][0]
            half = len(text) // 2
            (row,) = [r for r in rows if r.doc_id == i]
            assert (row.n_chars, row.edited) == (len(text), text[: len(text) - half] + after[:half])
    assert [r.shown for r in rows if r.doc_id == 4] == [r.shown for r in rows if r.doc_id == 5]


def test_order_does_not_matter_and_parts_add_up(spark):
    texts = [("ab", "one two.\nthree four.\nfive"), ("ba", "five\none two.\nthree four."), ("a", "one two.\nthree four."), ("b", "five")]
    rows = with_fingerprint(spark.createDataFrame(texts, "name string, text string"), "print", F.col("text"), ["name"])
    prints = {r.name: r.shown for r in rows.select("name", as_text(F.col("print")).alias("shown")).collect()}
    assert prints["ab"] == prints["ba"] != prints["a"]
    a, b, ab = (rows.filter(F.col("name") == n).select(F.col("print").alias(n)) for n in ("a", "b", "ab"))
    joined = a.join(b, F.lit(True)).join(ab, F.lit(True))
    row = joined.select(
        as_text(combined(F.col("a"), F.col("b"))).alias("sum"),
        as_text(combined(F.col("ab"), F.col("b"), -1)).alias("difference"),
    ).first()
    assert (row["sum"], row["difference"]) == (prints["ab"], prints["a"])


def test_counters_hold_a_million_equal_lines(spark):
    lines = spark.range(1).select(
        F.lit("many").alias("name"),
        F.repeat(F.lit("ok.\n"), 1 << 20).alias("a"),
        F.repeat(F.lit("ok.\n"), (1 << 20) - 1).alias("b"),
    )
    a = with_fingerprint(lines, "pa", F.col("a"), ["name"])
    b = with_fingerprint(lines, "pb", F.col("b"), ["name"])
    row = a.join(b, "name").select("pa.n", likeness(F.col("pa"), F.col("pb")).alias("near")).first()
    assert row["n"] == 1 << 20 and row["near"] > 0.999


def test_fingerprints_equal_plain_sums(messy):
    def plain(text):
        lanes = [0] * 8
        for line in text.split("\n"):
            for salt in range(4):
                h = spark_hash(salt, line)
                lanes[2 * salt] = (lanes[2 * salt] + (h & 0xFFFFFFFF)) & 0xFFFFFFFF
                lanes[2 * salt + 1] = (lanes[2 * salt + 1] + (h >> 32)) & 0xFFFFFFFF
        phrases = re.findall(PHRASE, text)
        counts = [[sum(spark_hash(seed, q) >> bit & 1 for q in phrases) for bit in range(60)] for seed in range(2)]
        return len(phrases), lanes, counts

    docs = [(i, t or "") for i, t, _, _ in messy_texts() if i is not None and len(t or "") < 2000]
    got = {}
    for r in fingerprint_edits(messy).collect():
        got.setdefault(r.doc_id, []).append(r.own)
    for i, text in docs:
        n, lanes, counts = plain(text)
        packed = [counts[seed][s] | counts[seed][s + 30] << 30 for seed in range(2) for s in range(30)]
        assert any((own.n, own.lanes, own.counters) == (n, lanes, packed) for own in got[i])


def spark_hash(salt, text):
    """xxhash64 of an int column and a string column, as Spark chains them."""
    import xxhash

    mask = (1 << 64) - 1
    p1, p2, p3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    h = (42 + 0x27D4EB2F165667C5 + 4) & mask
    h ^= (salt & 0xFFFFFFFF) * p1 & mask
    h = ((h << 23 | h >> 41) & mask) * p2 + p3 & mask
    h = (h ^ h >> 33) * p2 & mask
    h = (h ^ h >> 29) * p3 & mask
    return xxhash.xxh64_intdigest(text.encode(), h ^ h >> 32)


def test_fingerprint_plan_is_native(messy):
    plan = fingerprint_edits(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_nothing(no_docs):
    assert fingerprint_edits(no_docs).count() == 0


# Vectors -------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, [float(draw.randint(-3, 3)) for _ in range(4)]) for i in range(300)]
    extra = [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, [float("inf")] * 4), (None, [1.0] * 4), (450, [])]
    frame = spark.createDataFrame(rows + extra, "vec_id bigint, embedding array<double>")
    got = top_k(frame, k=5, every=10, scale=1, shard_rows=64, block_rows=8)
    want = brute.top_k([(i, [int(x) for x in v]) for i, v in rows], 5, 10)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_top_k_of_messy_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [5.0] * 3), (50, [1.0] * 3)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    frame = frame.selectExpr("*", *(f"7 AS {name}" for name in ("vector", "shard", "block", "query_id", "rank", "score", "least")))
    got = sorted(tuple(r) for r in top_k(frame, k=3, scale=1).collect())
    # The smallest vector of an id asks; repeated candidates count each; widths do not meet.
    assert got == [(0, 1, 1, 3), (0, 2, 1, 3), (50, 1, 2, 15)]
    assert top_k(frame.limit(0)).count() == 0


def test_top_k_with_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.5, -0.5]), (7, [2.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in top_k(frame, scale=2).collect()] == [(0, 1, 7, 8)]
    assert top_k(frame.limit(0)).count() == 0


def test_top_k_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op7_kd_tree_top_k"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({llm_oracle_sql()[name]})").fetchall()
    got = llm_queries()[name](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)


# Languages -----------------------------------------------------------------------------


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify_languages(docs, learn_languages(docs)).join(docs, "doc_id").filter(held_out(F.col("doc_id")))
    rows = found.select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_messy_texts(messy, no_docs):
    model = learn_languages(messy)
    rows = identify_languages(messy, model).collect()
    assert len(rows) == len(messy_texts())
    found = {r.doc_id: r.lang_pred for r in rows}
    assert found[4] == found[5] == found[6] == found[14] == UNDETERMINED
    assert set(found.values()) <= {"en", "fr", UNDETERMINED}
    kept = keep_determined(messy, model)
    assert kept.schema == messy.schema
    assert not {4, 5, 6, 14} & {r.doc_id for r in kept.collect()}
    assert keep_determined(no_docs, model).count() == 0
    nothing = learn_languages(no_docs)
    assert {r.lang_pred for r in identify_languages(messy, nothing).collect()} == {UNDETERMINED}


def test_rows_stay_if_no_language_was_learned(messy):
    unlabelled = messy.withColumn("lang", F.lit(None).cast("string"))
    kept = keep_determined(unlabelled, learn_languages(unlabelled))
    assert kept.count() == len(messy_texts())


def test_unknown_alphabets_are_rejected_and_known_ones_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn_languages(docs)
    assert keep_determined(docs, model).count() == docs.count()
    strange = spark.createDataFrame([(i, "".join(map(chr, range(0x4E00 + i, 0x4E50 + i)))) for i in range(50)], "doc_id bigint, text string")
    assert keep_determined(strange, model).count() == 0


def test_any_number_of_languages(spark):
    draw = random.Random(2)
    rows = []
    for n in range(600):
        letters = draw.sample("abcdefghijklmnopqrstuvwxyz", 6)
        rows += [(2 * n + k, " ".join("".join(draw.choices(letters, k=5)) for _ in range(40)), f"x{n}") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = learn_languages(docs, sample_rows=1200)
    found = {r.doc_id: r.lang_pred for r in identify_languages(docs, model).collect()}
    learned = set(model.families.classes)
    assert len(learned) > 500
    assert sum(found[i] == lang for i, _, lang in rows) > 0.5 * len(rows)
    # With fewer rows than languages the most frequent ones are learned.
    few = learn_languages(docs.filter("doc_id < 40").unionByName(docs.filter("lang = 'x7'")), sample_rows=3)
    assert "x7" in few.families.classes and len(few.families.classes) <= 3


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_of_one_id_are_each_kept_or_dropped(spark, turn):
    draw = random.Random(9)
    a, b = (" ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(2))
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (6, b, "y"), (5, b, "z"), (2, a + " tail", "x")][::turn]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, other string").coalesce(1)
    kept = sorted((r.doc_id, r.text, r.other) for r in keep_one(docs, max_bits=0).collect())
    want = [(1, a, "x"), (5, b, "x")]
    if brute.simhash(a) != brute.simhash(a + " tail"):
        want.append((2, a + " tail", "x"))
    assert kept == sorted(want)
