"""Work within one long document must grow with its length, not with the square of it."""

import time

from pyspark.sql import functions as F

from termloom.functions.text import BLANK_CHARS, fold_text, keep_letters
from termloom.operators.indexing import frequent_pairs, parse_documents


def test_pairs_of_a_long_text(spark):
    words = [("pan", "vino", "agua", "queso")[i * i % 7 % 4] for i in range(60_000)]
    words[100] = words[2_000] = "raro"
    docs = [(1, "a.txt", " ".join(words)), (2, "b.txt", "pan raro vino"), (3, "c.txt", "pan"), (4, "d.txt", "pan vino pan vino")]
    parsed = parse_documents(spark.createDataFrame(docs, "doc_id bigint, filename string, text string"))
    often = ["pan", "vino", "agua", "queso"]
    want = {}
    for doc_id, _, text in docs:
        tokens = text.split(" ")
        for at, (own, after) in enumerate(zip(tokens, tokens[1:])):
            if own in often and after in often:
                want.setdefault((doc_id, f"{own} {after}"), []).append(at)
    began = time.monotonic()
    got = {(row.doc_id, row.term): row.positions for row in frequent_pairs(parsed, often).collect()}
    assert got == want
    assert time.monotonic() - began < 25  # by the square of its length it takes minutes


def test_letters_that_stay(spark):
    texts = ["".join(map(chr, range(128))), "Pan-de\x0bVino\x85  9", "Ñandú 山 \U0001f600x", "", None]
    rows = spark.createDataFrame([(text,) for text in texts], "t string")
    by_pattern = F.regexp_replace(fold_text(F.col("t")), f"[^a-z{BLANK_CHARS}]+", "")
    for row in rows.select(by_pattern.alias("want"), keep_letters(F.col("t")).alias("got")).collect():
        assert row.got == row.want
