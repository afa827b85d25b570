import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from messy_texts import messy_texts
from termloom.llm.bpe import decode_documents, encode_documents, join_ids
from termloom.llm.counting import cached_counts, count_tokens
from termloom.llm.encoding import ByteEncoder, WordEncoder, id_bytes
from termloom.llm.packing import pack_documents, plan_sequences
from termloom.llm.planes import (
    append_crc32,
    document_checksums,
    from_planes,
    read_token_parts,
    to_planes,
    write_token_files,
)

WORD, BYTE, PIECE = map(
    public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
)
BITS = [
    "a", "B", " ", "  ", "\n", "\t", "é", "é", "'s", "'", "’", "1", "23", ".", "!!", "<|endoftext|>",
    "<|startoftext|>", "　", "\xa0", "\x1f", "\x0b", "İ", "ſ", "日本", "😀", "ß", "\0", "́", "Σ",
    "'ll", "re", "\r\n", "\x85", "​", "ª", "Ⅳ", "aaaa", "    ",
]


@pytest.fixture(scope="module")
def word():
    return WordEncoder(WORD)


@pytest.fixture(scope="module")
def byte():
    return ByteEncoder(BYTE)


def random_texts(n, most):
    draw = random.Random(n)
    return ["".join(draw.choices(BITS, k=draw.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word", "byte"])
def test_chunks_give_the_ids_of_whole_texts(name, request):
    encoder = request.getfixturevalue(name)
    for text in random_texts(3000, 14):
        assert encoder.encode(text) == encoder.encode_whole(text), text


def test_decoding_equals_the_library(byte):
    for text in random_texts(500, 14):
        ids = byte.encode(text)
        numbers = np.frombuffer(ids, "<u4").tolist()
        assert byte.decode(ids) == byte.tokenizer.decode(numbers, skip_special_tokens=False)


def test_joined_halves_equal_the_whole(byte):
    draw = random.Random(2)
    texts = random_texts(6000, 60)
    texts += ["".join(draw.choices("ab", k=400)) for _ in range(100)]
    texts += [" " * draw.randint(1, 300) + "x" for _ in range(50)]
    texts += ["".join(draw.choices("étudiant日😀", k=200)) for _ in range(50)]
    for text in texts:
        cut = draw.randint(0, len(text))
        left, right = byte.encode_whole(text[:cut]), byte.encode_whole(text[cut:])
        assert join_ids(byte, left, right, window=1 + len(text) % 5) == byte.encode_whole(text), (text, cut)


def test_tree_concatenation_of_messy_texts(spark, messy, byte):
    encoded = encode_documents(messy, BYTE, leaf_chars=100)
    got = sorted(((r.doc_id or -1, bytes(r.ids), r.decoded) for r in decode_documents(encoded, BYTE).collect()))
    want = sorted((i or -1, byte.encode_whole(t or ""), t or "") for i, t, _, _ in messy_texts())
    assert got == want
    again = encode_documents(messy, BYTE, leaf_chars=100, decoded=True).collect()
    assert sorted((r.doc_id or -1, bytes(r.ids), r.decoded) for r in again) == want


def test_tree_concatenation_of_nothing(no_docs):
    assert encode_documents(no_docs, BYTE).count() == 0


# Packing -------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    capacity = 64
    counts = {draw.randint(1, capacity): draw.randint(1, 50) for _ in range(draw.randint(1, 40))}
    filled, numbers = {}, {}
    for length, first, many, sequence, offset, times in plan_sequences(counts, capacity):
        numbers.setdefault(length, []).extend(range(first, first + many * times))
        for s in range(sequence, sequence + times):
            filled.setdefault(s, []).extend((offset + length * i, length) for i in range(many))
    assert {n: sorted(v) for n, v in numbers.items()} == {n: list(range(c)) for n, c in counts.items()}
    for spans in filled.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity


def test_plan_uses_exact_complements():
    counts = {60: 5, 4: 2, 3: 1, 1: 1, 2: 6}  # 60+4 twice, 60+3+1, 60+2+2 twice
    assert max(row[3] + row[5] for row in plan_sequences(counts, 64)) == 6


def test_packed_documents(messy, word):
    rows = pack_documents(messy, WORD, capacity=64).collect()
    want = []
    for doc_id, text, _, _ in messy_texts():
        ids = word.encode_whole(text or "") + id_bytes([1])
        for piece, at in enumerate(range(0, len(ids), 256)):
            own = ids[at : at + 256]
            want.append((doc_id or -1, piece, at // 4, len(own) // 4, zlib.crc32(own)))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    for spans in brute.groups((r.sequence_id, (r.offset, r.length)) for r in rows).values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64


def test_packing_nothing(no_docs):
    assert pack_documents(no_docs, WORD).count() == 0


# Counting ------------------------------------------------------------------------------


@pytest.mark.parametrize("path", [PIECE, BYTE])
def test_counts_and_their_cache(spark, messy, tmp_path, path):
    from termloom.llm.counting import token_counter

    cache = str(tmp_path / "cache")
    count = token_counter(path)
    want = sorted((i or -1, len((t or "").encode()), count(t or "")) for i, t, _, _ in messy_texts())

    def counted():
        return sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in count_tokens(messy, path, cache).collect())

    assert counted() == want
    distinct = len({t or "" for _, t, _, _ in messy_texts()})
    assert spark.read.parquet(cache).count() == distinct
    assert counted() == want
    assert spark.read.parquet(cache).count() == distinct  # all known now
    assert cached_counts(spark, cache, path).count() == distinct


def test_counting_nothing(no_docs, tmp_path):
    assert count_tokens(no_docs, PIECE, str(tmp_path / "cache")).count() == 0


# Files ---------------------------------------------------------------------------------


@pytest.mark.parametrize("plane_bits", [1, 8])
@pytest.mark.parametrize("most", [1, 255, 256, 70_000, 2**32 - 1])
def test_planes_round_trip(plane_bits, most):
    ids = np.random.default_rng(0).integers(0, most + 1, 101, dtype=np.uint64).astype("<u4").tobytes()
    assert from_planes(to_planes(ids, plane_bits), 101, plane_bits) == ids


def test_appended_checksums():
    a, b = b"one part", b"and another"
    assert append_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("plane_bits", [1, 8])
def test_token_files(spark, messy, word, tmp_path, plane_bits):
    path = str(tmp_path / "files")
    write_token_files(messy, path, WORD, block_ids=50, plane_bits=plane_bits)
    ordered = sorted(messy_texts(), key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    want, start = [], 0
    for doc_id, text, _, _ in ordered:
        ids = word.encode_whole(text or "") + id_bytes([2])
        want.append((start, doc_id, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in document_checksums(spark, path).collect())
    assert got == want
    parts = sorted(read_token_parts(spark, path).collect(), key=lambda r: r.start)
    whole = b"".join(word.encode_whole(t or "") + id_bytes([2]) for _, t, _, _ in ordered)
    assert b"".join(bytes(r.value) for r in parts) == whole


def test_token_files_of_nothing(spark, no_docs, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(no_docs, path, WORD)
    assert document_checksums(spark, path).count() == 0
