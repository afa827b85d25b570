"""Text rules shared by documents and queries, as native column expressions.

The rules, in order: fold to lower-case ASCII, delete everything that is neither a letter
nor white space (so ``wine-glass`` becomes ``wineglass``), split on white space, drop
stopwords.  A token's position is its index after the stopwords are gone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.folding import fold_letters, once

# The stopwords, compared after folding.
STOPWORDS = (
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un",
    "para", "con", "no", "una", "su", "al", "lo", "como", "mas", "pero", "sus",
    "le", "ya", "o", "este", "ha", "me", "si", "sin", "sobre", "es", "son",
)

# Fixed value: length of the stored excerpt in characters.
SNIPPET_LENGTH = 250

# The white-space characters, spelled out because regex dialects disagree about ``\s``.
BLANK_CHARS = r" \t\n\x0B\f\r"

# All of ASCII that is neither a lower-case letter nor white space.
_ASCII_REST = "".join(char for char in map(chr, range(128)) if not ("a" <= char <= "z" or char in " \t\n\x0B\f\r"))


def fold_text(text: Column) -> Column:
    """Spell letters of other alphabets, and accented ones, in ASCII, and lower all."""
    return F.lower(fold_letters(text))


def keep_letters(text: Column) -> Column:
    """Fold ``text`` and delete every character that is neither a-z nor white space.

    What is ASCII goes by exchange of single characters, which costs a fraction of a replacement by
    pattern; a text is searched by pattern only if anything else is left in it.
    """
    plain = F.translate(fold_text(text), _ASCII_REST, "")
    others = f"[^a-z{BLANK_CHARS}]+"
    return once(
        plain,
        lambda row: F.when(F.octet_length(row) == F.char_length(row), row).otherwise(F.regexp_replace(row, others, "")),
    )


def split_words(text: Column) -> Column:
    """Words of ``text`` in order, stopwords included."""
    words = F.split(keep_letters(text), f"[{BLANK_CHARS}]+")
    return F.filter(words, lambda word: word != "")


def drop_stopwords(words: Column) -> Column:
    return F.filter(words, lambda word: ~word.isin(*STOPWORDS))


def normalize_tokens(text: Column) -> Column:
    """Tokens of ``text`` in order: the words without stopwords, repeats kept."""
    words = F.split(keep_letters(text), f"[{BLANK_CHARS}]+")
    return F.filter(words, lambda word: ~word.isin("", *STOPWORDS))


def token_count(tokens: Column) -> Column:
    return F.size(tokens)


def snippet(text: Column) -> Column:
    """The first characters of the raw text."""
    return F.substring(text, 1, SNIPPET_LENGTH)


def encode_positions(positions: Column) -> Column:
    """Position list as comma-separated text, for export."""
    return F.array_join(positions, ",")


def decode_positions(encoded: Column) -> Column:
    """Inverse of :func:`encode_positions`."""
    return F.transform(F.split(encoded, ","), lambda p: p.cast("int"))
