"""The registered queries against the libraries themselves and plain versions, column by column."""

import hashlib
import math
import re
import zlib
from array import array

import brute
import public_tokenizers
import pytest
from test_vectors_codes import brute_codes
from termloom.llm.queries import llm_queries

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text or "", r.lang, r.source) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect())


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: llm_queries()[name](spark, SMOKE).collect()


def tokenizer(name):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path(name))
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(run, docs):
    encode = tokenizer("word_bpe_49k.json").encode
    want, start = {}, 0
    for doc_id, text, *_ in docs:
        ids = [*encode(text, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[doc_id, piece] = (at, len(part), zlib.crc32(array("I", part).tobytes()))
    rows = run("op1_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    assert len(used) <= math.ceil(sum(w[1] for w in want.values()) / 4096) + 1


def test_op2(run, docs):
    plain = brute.without_repeats([(i, t) for i, t, *_ in docs], 50)
    want = {i: (n, gone, brute.sha(kept)) for (i, *_), (n, gone, kept) in zip(docs, plain)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run("op2_substring_dedup")} == want


def test_op3(run, docs):
    rows = {r.doc_id: r for r in run("op3_secret_scan")}
    assert len(rows) == len(docs)
    for doc_id, text, *_ in docs:
        spans = brute.base_spans(text)
        row, names = rows[doc_id], ("assign", "access", "hex")
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[1] == kind for s in spans) for kind in range(3)]
        joined = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)
        assert row.base_sha256 == brute.sha(joined)
        assert ",".join(s for s in row.spans.split(",") if not s.startswith("owned")) == joined


def test_op4(run, docs):
    rows = {r.doc_id: r for r in run("op4_multiset_hash")}
    for (doc_id, text, *_), (_, after, *_) in zip(docs, [*docs[1:], docs[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = rows[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), brute.sha(edited))
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    prints = {}
    for doc_id, text, *_ in docs:
        prints.setdefault(text, set()).add(rows[doc_id].fingerprint)
    assert all(len(own) == 1 for own in prints.values())
    assert len({p for own in prints.values() for p in own}) == len(prints)


def test_op5(run, docs):
    prints = [brute.simhash(t) for _, t, *_ in docs]
    roots = brute.linked(prints)
    want = {i: (f"{p:016x}", docs[root][0]) for (i, *_), p, root in zip(docs, prints, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run("op5_simhash_golay")} == want


def test_op6(run, docs):
    library = tokenizer("byte_bpe_50k.json")
    want = {}
    for doc_id, text, *_ in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        want[doc_id] = (len(ids), sha(array("I", ids).tobytes()), brute.sha(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run("op6_tree_bpe")} == want


def test_op8(run, docs):
    rows = {r.doc_id: r for r in run("op8_language_id")}
    assert len(rows) == len(docs)
    learned = {lang for i, _, lang, _ in docs if zlib.crc32(str(i).encode()) % 5}
    right = total = 0
    for doc_id, text, lang, _ in docs:
        row = rows[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1
        assert row.lang_pred in learned if re.search(r"[^\W\d_]", text) else row.lang_pred == "und"
        if row.held_out:
            total, right = total + 1, right + (row.lang_pred == lang)
    assert right >= 0.95 * total > 0


def test_op9(run, docs):
    from sentencepiece import SentencePieceProcessor

    encode = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).encode
    want = {i: (len(t.encode()), len(encode(t)), len(encode(t)) > 4096) for i, t, *_ in docs}
    for _ in range(2):  # from an empty or a filled cache
        assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run("op9_token_counts")} == want


def test_op10(run, docs):
    encode = tokenizer("word_bpe_49k.json").encode
    want, start = {}, 0
    for doc_id, text, *_ in docs:
        ids = [*encode(text, add_special_tokens=False).ids, 2]
        want[doc_id] = (start, len(ids), zlib.crc32(array("I", ids).tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run("op10_bit_plane_files")} == want


def test_op12(run, spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    want, digest = brute_codes(rows)
    got = run("op12_walsh_codes")
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(want)
    assert {r.codebooks_sha256 for r in got} == {digest}
