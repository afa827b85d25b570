"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs.  Each paragraph is hashed to a wide vector, and the
fingerprint is the sum of these vectors, each component modulo a power of two.  The order of
paragraphs does not matter, and adding or subtracting a paragraph's vector follows an insertion
or deletion without reading the rest.

The vector has two parts.  Lanes of 32 bits, from salted 64-bit hashes of the paragraph, decide
equality.  Packed counters of 30 bits, more than a text has phrases, count over the paragraph's
phrases (up to eight words of a sentence) how often each bit of two phrase hashes is set; they
are sums too, and the cosine of two counter vectors estimates how much of two texts is shared.

Only built-in columns are used: texts are exploded into paragraphs and phrases, whose vectors are
summed up in columns before anything moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import settle

SALTS = 4  # two lanes of 32 bits each
SEEDS = 2  # phrase hashes; 60 of the bits of each are counted
PHRASE = r"(?:[^\s.!?]+[^\S\n]*){1,8}[.!?]*|[.!?]+"  # never beyond its paragraph

_LANE = (1 << 32) - 1
_COUNTER_BITS = 30
_COUNTER = (1 << _COUNTER_BITS) - 1
_SPREAD = 1 | 1 << _COUNTER_BITS  # two counters share a word
_WORD = (1 << 2 * _COUNTER_BITS) - 1


def with_fingerprint(df: DataFrame, name: str, text: Column, keep: list[str]) -> DataFrame:
    """Columns ``keep``, short ones, and the fingerprint of a text: struct of n (phrases), lanes and
    counters.

    A null text counts as an empty one, whose only paragraph is empty.  If ``df`` is partitioned by
    some of ``keep`` nothing is shuffled, otherwise one sum for each text.
    """
    def items(kind: int, found: Column) -> Column:
        return F.transform(found, lambda item: F.struct(F.lit(kind).alias("_kind"), item.alias("_item")))

    row = F.monotonically_increasing_id().alias("_row")
    texts = df.select(row, *keep, F.coalesce(text, F.lit("")).alias("_text"))
    phrases = F.regexp_extract_all("_text", F.lit(PHRASE), F.lit(0))
    both = F.concat(items(0, F.split("_text", "\n")), items(1, phrases))
    parts = texts.select("_row", *keep, F.inline(both))

    def hashes(kind: int, letter: str, salts: int) -> list[Column]:
        return [
            F.when(F.col("_kind") == kind, F.xxhash64(F.lit(salt), "_item")).alias(f"_{letter}{salt}")
            for salt in range(salts)
        ]

    hashed = parts.select("_row", *keep, *hashes(0, "p", SALTS), *hashes(1, "q", SEEDS))

    def total(value: Column, mask: int) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).bitwiseAND(F.lit(mask))

    halves = [
        total(half, _LANE)
        for salt in range(SALTS)
        for half in (F.col(f"_p{salt}").bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(f"_p{salt}", 32))
    ]
    counters = [
        total(F.shiftrightunsigned(f"_q{salt}", shift).bitwiseAND(F.lit(_SPREAD)), _WORD)
        for salt in range(SEEDS)
        for shift in range(_COUNTER_BITS)
    ]
    summed = hashed.groupBy("_row", *keep).agg(
        F.count("_q0").alias("n"), F.array(*halves).alias("lanes"), F.array(*counters).alias("counters")
    )
    return summed.select(*keep, F.struct("n", "lanes", "counters").alias(name))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of two multisets together, or (sign -1) of the first without the second."""

    def sums(field: str, mask: int) -> Column:
        return F.zip_with(
            a[field], b[field], lambda x, y: (x + y * F.lit(sign)).bitwiseAND(F.lit(mask))
        ).alias(field)

    return F.struct((a["n"] + b["n"] * F.lit(sign)).alias("n"), sums("lanes", _LANE), sums("counters", _WORD))


def as_text(fingerprint: Column) -> Column:
    """Lowercase hex of all parts of a fingerprint."""

    def digits(field: str, width: int) -> Column:
        return F.array_join(F.transform(fingerprint[field], lambda x: F.lpad(F.lower(F.hex(x)), width, "0")), "")

    return F.concat_ws(":", F.lower(F.hex(fingerprint["n"])), digits("lanes", 8), digits("counters", 15))


def _signs(fingerprint: Column) -> Column:
    """Ones less zeros of each counted bit."""
    fields = F.flatten(
        F.transform(
            fingerprint["counters"],
            lambda w: F.array(w.bitwiseAND(F.lit(_COUNTER)), F.shiftrightunsigned(w, _COUNTER_BITS)),
        )
    )
    return F.transform(fields, lambda x: (x * 2 - fingerprint["n"]).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common phrases, from 0 to 1; 1 for equal fingerprints."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, p: total + p)

    x, y = _signs(a), _signs(b)
    length = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    cosine = F.when(length > 0, dot(x, y) / length).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def next_documents(docs: DataFrame) -> DataFrame:
    """(id, version, n_chars, next_id, next_version): the document behind each, in order of id.

    ``docs`` has id, version (a hash of the text, which orders rows of one id) and n_chars.
    Rows equal in both are one document.  The first follows the last.
    """
    order = ["id", "version"]
    distinct = docs.groupBy(*order).agg(F.first("n_chars").alias("n_chars"))
    dealt = distinct.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = settle(dealt, "order")
    within = Window.partitionBy("part").orderBy(*order)
    following = F.lead(F.struct(*order)).over(within)
    # One row per range of documents.
    firsts = dealt.groupBy("part").agg(F.min(F.struct(*order)).alias("own"))
    ranges = Window.orderBy("part")
    begin = F.first("own").over(ranges)
    firsts = firsts.select("part", F.coalesce(F.lead("own").over(ranges), begin).alias("beyond"))
    chain = dealt.withColumn("next", following).join(firsts, "part")
    chain = chain.withColumn("next", F.coalesce("next", "beyond"))
    return chain.select(
        *order, "n_chars", F.col("next.id").alias("next_id"), F.col("next.version").alias("next_version")
    )


def fingerprint_edits(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of the text with its last half replaced by the next one's.

    Of n code points the last floor(n / 2) are replaced by the first as many, or all, of the
    next document's in order of id.  A null text is empty, a null id comes first.  Rows of one
    id follow each other by a hash of their text, rows that repeat both are one document in the
    order and are returned as often as they occur.  An empty table gives no rows.

    Returns doc_id, n_chars, edited, and the structs own, changed and following: fingerprints
    of the text, the edited text and the next text.
    """
    nothing = -(1 << 63)  # stands for a null id
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    texts = docs.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(nothing)).alias("id"), text)
    texts = texts.withColumn("version", F.xxhash64("text"))
    n_chars = F.char_length("text").cast("bigint")
    chain = settle(next_documents(texts.select("id", "version", n_chars.alias("n_chars"))), "chain")

    # Texts move once; all that follows is joined where they are.
    keys = ["id", "version"]
    placed = texts.repartition(*keys)
    prints = settle(with_fingerprint(placed, "own", F.col("text"), keys).dropDuplicates(keys), "prints")
    given = chain.select(
        F.col("next_id").alias("id"), F.col("next_version").alias("version"),
        F.col("id").alias("to_id"), F.col("version").alias("to_version"), "n_chars",
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    passed = placed.join(given, keys).select(
        F.col("to_id").alias("id"), F.col("to_version").alias("version"), F.left("text", half).alias("start")
    )
    passed = passed.groupBy(*keys).agg(F.first("start").alias("start"))
    kept = F.left("text", (n_chars - F.floor(n_chars / 2)).cast("int"))
    edited = placed.join(passed, keys).select(
        *keys, n_chars.alias("n_chars"), F.concat(kept, "start").alias("edited")
    )
    changed = with_fingerprint(edited, "changed", F.col("edited"), keys).dropDuplicates(keys)
    after = prints.select(F.col("id").alias("next_id"), F.col("version").alias("next_version"), F.col("own").alias("following"))
    after = chain.join(after, ["next_id", "next_version"]).select(*keys, "following")
    joined = edited.join(changed, keys).join(prints, keys).join(after, keys)
    return joined.select(
        F.nullif("id", F.lit(nothing)).alias("doc_id"), "n_chars", "edited", "own", "changed", "following"
    )
