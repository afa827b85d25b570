"""Folding of letters to ASCII, taken from the Unicode transliterator that ships with Spark.

The rule is "to Latin, to ASCII, to lower case".  It is applied to every character of the covered
range once, on the driver, and the spellings travel with the plan as one table indexed by code
point.  Where a neighbour decides about a spelling, the table holds marks, control characters
that the texts have lost before, and a few replacements resolve them once a text is spelled.
Which characters carry marks is found out by asking the transliterator for pairs.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the transliteration rule.
RULE = "Any-Latin; Latin-ASCII; Lower()"

# First and last code point of the covered ranges; Hangul is spelled by its three parts.
RANGES = ((0x80, 0x9FFF), (0xF900, 0xFFEF))
HANGUL = (0xAC00, 0xD7A3)
_MEDIALS, _FINALS = 21, 28

_CALL = 1000  # characters spelled by one call
WIDTH = 8  # letters and marks of a table entry

# Marks; each pair meets where the first character stands directly before the second.
OPTIONAL_A, DROPS_A = "\x0e", "\x0f"  # an Indic consonant and a sign that takes its vowel
NASAL_M, TAKES_N = "\x10", "\x11"  # an Indic nasal and a consonant that makes it n
BEFORE_U, UPSILON = "\x12", "\x13"  # a Greek vowel and the upsilon it makes u
GAMMA, AFTER_GAMMA = "\x14", "\x15"  # a Greek gamma and a letter that makes it n
DOUBLES = "\x16"  # a small tsu doubles the next consonant
SPACED = "\x17"  # a Han character stands apart from a letter before it
MARKS = "".join(map(chr, range(0x0E, 0x18)))

# What becomes of marks, in this order; marks that are left are no letters and go with those.
RESOLVED = (
    (f"{OPTIONAL_A}a{DROPS_A}", ""),
    (f"{NASAL_M}m{TAKES_N}", "n"),
    (f"{BEFORE_U}{UPSILON}y", "u"),
    (f"{GAMMA}g{AFTER_GAMMA}", "n"),
    (f"{DOUBLES}tsu(?=ch)", "t"),
    (f"{DOUBLES}tsu([b-df-hj-mp-tv-z])", "$1$1"),
    (f"(?<=[A-Za-z]){SPACED}", " "),
)

# Blocks with inherent vowels, and the places of ka, anusvara and virama in each.
_INDIC = range(0x900, 0xD80, 0x80)
_KA, _ANUSVARA, _VIRAMA = 0x15, 0x02, 0x4D
_GREEK = [*range(0x370, 0x400), *range(0x1F00, 0x2000)]
_SMALL_TSU = "っッｯ"
# Kana that melt with a small or marking one behind, by code point from the first kana on.
KANA = (0x3041, 0x30FF)
SMALL_KANA = "ぁぃぅぇぉゃゅょァィゥェォャュョ゙゚"
# Thai vowels that are written before their consonant and spoken behind it.
THAI = (0x0E00, 0x0E7F)
_THAI_ORDER = ("([เแโใไ])([ก-ฮ])", "$2$1")

# Two letters with one sound.
_DIGRAPHS = {"ու": "u", "ՈՒ": "u", "ԵՒ": "ev"}


@dataclass(frozen=True)
class Folding:
    """``single`` spells characters by one letter or blank, or none, wherever they stand."""

    single: dict[str, str]
    table: bytes
    pairs: bytes
    long: dict[int, str]
    hangul: tuple[list[str], list[str], list[str]]


def _letters(spelling: str) -> str:
    return re.sub("[^a-z ]", "", spelling)


def _speller() -> Callable[[Iterable[str]], list[str]]:
    rule = SparkContext._active_spark_context._jvm.com.ibm.icu.text.Transliterator.getInstance(RULE)

    def spell(texts: Iterable[str]) -> list[str]:
        texts, out = list(texts), []
        for at in range(0, len(texts), _CALL):  # it edits in place, so short texts are fast
            out += rule.transliterate("\n".join(texts[at : at + _CALL])).split("\n")
        return [_letters(spelling) for spelling in out]

    return spell


def _marked(spell: Callable, alone: dict[str, str]) -> dict[str, str]:
    """Spellings that depend on a neighbour, with their marks."""
    marked = {}

    def pairs(firsts: Iterable[str], seconds: Iterable[str]) -> Iterable[tuple[str, str, str]]:
        both = [(a, b) for a in firsts for b in seconds]
        return [(a, b, got) for (a, b), got in zip(both, spell(a + b for a, b in both), strict=True)]

    for block in _INDIC:
        signs = [chr(code) for code in range(block, block + 0x80)]
        ka, virama, anusvara = (signs[place] for place in (_KA, _VIRAMA, _ANUSVARA))
        for sign, _, got in pairs(signs, [virama]):
            if alone[sign].endswith("a") and got == alone[sign][:-1]:
                marked[sign] = alone[sign][:-1] + OPTIONAL_A + "a"
        stem = alone[ka][:-1]
        for _, sign, got in pairs([ka], signs):
            if sign not in marked and got.startswith(stem) and got != alone[ka] + alone[sign]:
                marked[sign] = DROPS_A + got[len(stem) :]
        if alone[anusvara] == "m":
            marked[anusvara] = NASAL_M + "m"
            for _, sign, got in pairs([anusvara], [s for s in signs if OPTIONAL_A in marked.get(s, "")]):
                if got == "n" + alone[sign]:
                    marked[sign] = TAKES_N + marked[sign]

    greek = [chr(code) for code in _GREEK if alone[chr(code)]]
    for vowel, _, got in pairs(greek, "υ"):
        if got == alone[vowel] + "u":
            marked[vowel] = alone[vowel] + BEFORE_U
    for _, sign, got in pairs("α", greek):
        if alone[sign] == "y" and got == "au":
            marked[sign] = UPSILON + "y"
    for _, sign, got in pairs("γ", greek):
        if got == "n" + alone[sign]:
            marked[sign] = AFTER_GAMMA + alone[sign]
    for sign in "γΓ":
        marked[sign] = AFTER_GAMMA + GAMMA + "g"

    for sign in _SMALL_TSU:
        marked[sign] = DOUBLES + "tsu"
    if spell(["x北"]) == ["x bei"]:
        ideographs = [*range(0x3400, 0xA000), *range(0xF900, 0xFB00)]
        marked |= {chr(code): SPACED + alone[chr(code)] for code in ideographs if alone[chr(code)]}
    return marked


@lru_cache(maxsize=1)
def compositions() -> dict[str, str]:
    """Pairs that are one letter: Indic ones written as two characters, and Armenian digraphs."""
    composed = dict(_DIGRAPHS)
    for code in range(_INDIC.start, _INDIC.stop):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2:
            composed["".join(chr(int(part, 16)) for part in parts)] = chr(code)
    return composed


@lru_cache(maxsize=1)
def folding() -> Folding:
    """The spellings.  Needs a running session."""
    spell = _speller()
    characters = [chr(code) for first, last in RANGES for code in range(first, last + 1)]
    alone = dict(zip(characters, spell(characters), strict=True))
    marked = _marked(spell, alone)

    composed = compositions()
    bound = {*marked, *"".join(composed), *map(chr, range(THAI[0], THAI[1] + 1))}
    single = {char: base for char, base in alone.items() if len(base) < 2 and char not in bound}
    entries = [marked.get(char, base) for char, base in alone.items()]
    long = {ord(char): entry for char, entry in zip(characters, entries, strict=True) if len(entry) > WIDTH}
    table = b"".join(entry[:WIDTH].ljust(WIDTH).encode() for entry in entries)

    kana = [chr(code) for code in range(KANA[0], KANA[1] + 1)]
    melted = [first + second for first in kana for second in SMALL_KANA]
    pairs = b"".join(entry[:WIDTH].ljust(WIDTH).encode() for entry in spell(melted))

    first = HANGUL[0]
    step = _MEDIALS * _FINALS
    vowel = spell([chr(first + 11 * step)])[0]  # the silent consonant and the first vowel
    initials = [s[: -len(vowel)] for s in spell(chr(first + i * step) for i in range(19))]
    medials = spell(chr(first + 11 * step + i * _FINALS) for i in range(_MEDIALS))
    finals = [s[len(vowel) :] for s in spell(chr(first + 11 * step + i) for i in range(_FINALS))]
    # Of characters without a spelling only the frequent ones are deleted at once.
    frequent = [*range(0x80, 0x370), *range(0x2000, 0x2070)]
    single = {char: base for char, base in single.items() if base or ord(char) in frequent}
    return Folding(single, table, pairs, long, (initials, medials, finals))


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _entry(table: bytes, place: Column) -> Column:
    """Entry of a table of fixed width, found without a search."""
    return F.rtrim(F.substring(F.lit(table), place * WIDTH + 1, F.lit(WIDTH)).cast("string"))


def _spelled(char: Column, fold: Folding) -> Column:
    """Spelling of one character, or of a kana with a small one behind."""
    code = F.ascii(char)
    (low, low_end), (high, high_end) = RANGES
    place = F.when(code <= low_end, code - low).when(
        code.between(high, high_end), code - (high - low_end - 1 + low)
    )
    entry = _entry(fold.table, place)
    for point, spelling in fold.long.items():
        entry = F.when(code == point, spelling).otherwise(entry)

    syllable = code - HANGUL[0]
    initials, medials, finals = (F.split(F.lit(",".join(parts)), ",") for parts in fold.hangul)
    korean = F.concat(
        F.get(initials, F.floor(syllable / (_MEDIALS * _FINALS)).cast("int")),
        F.get(medials, F.floor(syllable / _FINALS).cast("int") % _MEDIALS),
        F.get(finals, syllable % _FINALS),
    )
    behind = F.instr(F.lit(SMALL_KANA), F.substring(char, 2, 1)) - 1
    melted = _entry(fold.pairs, (code - KANA[0]) * len(SMALL_KANA) + behind)
    spelling = F.when(code.between(*HANGUL), korean).when(F.char_length(char) > 1, melted).otherwise(entry)
    return F.coalesce(spelling, F.lit(""))


def fold_letters(text: Column) -> Column:
    """``text`` with every covered character spelled in ASCII, in lower case if it was beyond it.

    Rows of ASCII, told by their byte length, stay as they are; those that are ASCII once single
    letters are exchanged need no more; of all others only the characters beyond ASCII are looked
    up.
    """
    fold = folding()
    gone = [char for char, base in fold.single.items() if not base]
    kept = {char: base for char, base in fold.single.items() if base}
    # A character without a counterpart is deleted; the texts' own control characters go too.
    exchanged = F.translate(text, "".join([*kept, *gone, *MARKS]), "".join(kept.values()))

    first, last = map(chr, KANA)
    parts = rf"[{first}-{last}][{SMALL_KANA}]|[^\x00-\x7F]|[\x00-\x7F]+"

    def spell(row: Column) -> Column:
        whole = row
        for pair, char in compositions().items():
            whole = F.replace(whole, F.lit(pair), F.lit(char))
        whole = F.when(row.rlike(f"[{''.join({pair[1] for pair in compositions()})}]"), whole).otherwise(row)
        ordered = F.regexp_replace(whole, *map(F.lit, _THAI_ORDER))
        pieces = F.regexp_extract_all(ordered, F.lit(parts), F.lit(0))
        spelled = F.transform(pieces, lambda piece: F.when(F.ascii(piece) < 128, piece).otherwise(_spelled(piece, fold)))
        joined = F.array_join(spelled, "")

        def resolve(marked: Column) -> Column:
            for pattern, spelling in RESOLVED:
                marked = F.regexp_replace(marked, pattern, spelling)
            return marked

        return once(joined, lambda row: F.when(row.rlike(f"[{MARKS}]"), resolve(row)).otherwise(row))

    ascii_only = F.octet_length(text) == F.char_length(text)
    others = once(
        exchanged, lambda row: F.when(F.octet_length(row) == F.char_length(row), row).otherwise(spell(row))
    )
    return F.when(ascii_only, text).otherwise(others)
