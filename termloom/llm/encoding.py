"""Exact, memoised encoding with the ``tokenizers`` library inside Arrow tasks.

Both vocabularies split a text before any merge, and a space between two characters that are
not white space always ends one piece and starts the next.  A text is therefore cut there, each
distinct chunk goes through the library once per worker, and the ids of a text are the joined
ids of its chunks.  Ids are kept as bytes: little-endian unsigned 32-bit numbers.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# Chunks a worker remembers; beyond twice as many, those not used lately are forgotten.
MEMO_CHUNKS = 400_000
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@]*)")
_BLANKS = re.compile(r" \s|\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")


def id_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


class Memo(dict):
    """Made values by key, in two generations so that their number is bounded."""

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMO_CHUNKS):
        self.make = make
        self.limit = limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class Encoder:
    """Ids of whole texts, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS):
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        self.memo = Memo(self.encode_chunk, memo_chunks)
        self.bytes_of = _byte_characters()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.cut(text)))

    def encode_whole(self, text: str) -> bytes:
        """Ids straight from the library."""
        return id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece that the pre-tokenizer leaves whole."""
        visible = piece.encode().decode("latin-1").translate(self.bytes_of)
        return id_bytes([token.id for token in self.model.tokenize(visible)])


class WordEncoder(Encoder):
    """For vocabularies that drop white space and lower letters, with word ends.

    Chunks are what stands between spaces and line breaks.  A chunk of plain letters with
    punctuation behind is two pieces, which go to the model alone; any other chunk takes the
    library's whole way.
    """

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS):
        super().__init__(path, memo_chunks)
        self.pieces = Memo(self.encode_piece, memo_chunks)

    @staticmethod
    def cut(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def encode_chunk(self, chunk: str) -> bytes:
        match = _WORD.fullmatch(chunk)
        if match is None:
            return self.encode_whole(chunk)
        word, tail = match.groups()
        ids = self.pieces[word.lower()]
        return ids + self.pieces[tail] if tail else ids


class ByteEncoder(Encoder):
    """For byte-level vocabularies, in which a space belongs to the word behind it."""

    def __init__(self, path: str):
        super().__init__(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        back = {ord(shown): byte for byte, shown in self.bytes_of.items()}
        special = self.tokenizer.get_added_tokens_decoder()
        self.special_chars = max((len(token.content) for token in special.values()), default=0)
        self.token_bytes = [
            self.tokenizer.id_to_token(i).encode()
            if i in special
            else bytes(back[ord(c)] for c in self.tokenizer.id_to_token(i))
            for i in range(size)
        ]

    @staticmethod
    def cut(text: str) -> list[str]:
        """Chunks between which no piece reaches; a chunk keeps its leading space."""
        if _BLANKS.search(text) or text[:1] == " " or text[-1:] == " " or "\0" in text:
            return _SAFE_CUT.split(text)
        return text.replace(" ", "\0 ").split("\0")

    def encode_chunk(self, chunk: str) -> bytes:
        match = _WORD.fullmatch(chunk, 1 if chunk[:1] == " " else 0)
        if match is None or "'" in match[2]:
            return self.encode_whole(chunk)
        ids = self.encode_piece(chunk[: match.end(1)])
        return ids + self.encode_piece(match[2]) if match[2] else ids

    def decode(self, ids: bytes) -> str:
        """Text of ids, equal to ``decode(ids, skip_special_tokens=False)``."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, numbers)).decode("utf-8", "replace")


def _byte_characters() -> dict[int, str]:
    """The visible character that byte-level vocabularies use for each byte.

    Printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    table = {byte: chr(byte) for byte in shown}
    return table | {byte: chr(256 + place) for place, byte in enumerate(hidden)}


@lru_cache(maxsize=4)
def word_encoder(path: str, memo_chunks: int = MEMO_CHUNKS) -> WordEncoder:
    """The worker's encoder for ``path``, kept between tasks."""
    return WordEncoder(path, memo_chunks)


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    """The worker's encoder for ``path``, kept between tasks."""
    return ByteEncoder(path)
