import re
from collections import Counter, defaultdict

import pytest
from messy_texts import messy_texts
from pyspark.sql import functions as F
from termloom.llm import divergence
from termloom.llm.divergence import audit_sources

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(docs, least=10, top=10):
    """(lang, source, part, item, value, rank) rows of (text, lang, source)."""
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text)]
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in held.items()}
    prices, of_lang = {}, {}
    for lang in {g[0] for g in groups}:
        terms = kept.get(lang, [])
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                own = {t: counts[g][t] for t in terms}
                whole.update(own)
                total = sum(own.values())
                prices[g] = {t: 1 + 10**9 * (n + 2) // (total + 2 * len(terms)) for t, n in own.items()}
        total = sum(whole.values())
        of_lang[lang] = {t: 1 + 10**9 * (whole[t] + 2) // (total + 2 * len(terms)) for t in terms}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    rows = []
    for g in groups:
        lang, source = g
        terms = kept.get(lang, [])
        pairs = [
            (-sum(f(prices[g][t], prices[h][t]) for t in terms), h[1].encode(), h[1]) for h in groups if h[0] == lang and h != g
        ]
        dearer = [
            (-f(prices[g][t], of_lang[lang][t]), t.encode(), t)
            for t in terms if counts[g][t] and prices[g][t] > of_lang[lang][t]
        ]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(dearer)[:top])):
            rows += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(rows)


def audited(spark, docs, **options):
    frame = spark.createDataFrame([(t, lang, s, 1, 2) for t, lang, s in docs], "text string, lang string, source string, row int, term int")
    return sorted(tuple(r) for r in audit_sources(frame.repartition(3), **options).collect())


def random_docs(n, sources, words):
    import random

    draw = random.Random(n)
    vocabulary = ["".join(draw.choices("abcéßÄZ", k=draw.randint(1, 3))) for _ in range(words)]
    return [
        (" ".join(draw.choices(vocabulary, k=draw.randint(0, 30))), draw.choice(["en", "en", "fr", None]), f"s{draw.randrange(sources)}")
        for _ in range(n)
    ]


def test_messy_documents(spark):
    docs = [(t, lang, s) for _, t, lang, s in messy_texts()]
    for least in (1, 2, 10):
        assert audited(spark, docs, least_documents=least) == brute_audit(docs, least)


@pytest.mark.parametrize("side", [None, 2])
def test_random_documents(spark, monkeypatch, side):
    if side:  # small tiles: several bands of rows and blocks of columns
        monkeypatch.setattr(divergence, "SIDE_BITS", side)
        monkeypatch.setattr(divergence, "SIDE", 1 << side)
    docs = random_docs(120, 11, 60)
    # Workers import the module anew, so small tiles are traversed in this process.
    if side:
        cells, groups = divergence.price_cells(divergence.count_terms(
            spark.createDataFrame([(t or "", lang or "", s or "") for t, lang, s in docs], "text string, lang string, source string")
        ), 3)
        assert cells.count() and groups.count()
        trees(cells.collect(), side)
        return
    assert audited(spark, docs, least_documents=3) == brute_audit(docs, 3)


def trees(cells, bits):
    """Joint traversal of two trees equals the sum over all columns."""
    import numpy as np

    draw = np.random.default_rng(1)
    side = 1 << bits
    zeros = draw.integers(1, 50, side)
    dense = np.where(draw.random((2, side, side)) < 0.5, draw.integers(51, 900, (2, side, side)), 0)
    made = []
    for matrix in dense:
        rows, cols = np.nonzero(matrix)
        made.append(divergence.QuadTree.of(rows, cols, matrix[rows, cols], zeros))
        again = divergence.QuadTree.unpack(made[-1].pack())
        assert all((a == b).all() for a, b in zip(again.bits, made[-1].bits)) and (again.prices == made[-1].prices).all()

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for a, b, same in ((0, 1, False), (0, 0, True)):
        total = np.zeros((side, side), dtype=np.int64)
        divergence._traverse(made[a], made[b], total, same)
        for i in range(side):
            for j in range(side):
                both = (dense[a][i] > 0) & (dense[b][j] > 0) & (not same or i < j)
                p, q, p0, q0 = dense[a][i][both], dense[b][j][both], zeros[i], zeros[j]
                assert total[i, j] == (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)).sum()


def test_chunks_of_a_traversal_add_up(monkeypatch):
    import numpy as np

    draw = np.random.default_rng(5)
    rows, cols = np.nonzero(draw.random((40, 200)) < 0.4)
    tree = divergence.QuadTree.of(rows, cols, draw.integers(60, 999, len(rows)), draw.integers(1, 50, divergence.SIDE))
    whole, parts = (np.zeros((divergence.SIDE, divergence.SIDE), dtype=np.int64) for _ in range(2))
    divergence._traverse(tree, tree, whole, True)
    monkeypatch.setattr(divergence, "_CHUNK", 7)
    divergence._traverse(tree, tree, parts, True)
    assert (whole == parts).all() and whole.any()


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 3)
    text = b"Aa bb,aa\x00cc\xc3\xa9 dd" * 3
    got = [term for piece in divergence._terms(text) for term in piece]
    assert got == [t.encode() for t in TERM.findall(text.decode().lower())]


def test_audit_of_nothing(spark, no_docs):
    assert audit_sources(no_docs).count() == 0
    alone = spark.createDataFrame([("a b", "en", "s")], "text string, lang string, source string")
    assert audit_sources(alone).count() == 0
    two = [("", "en", "s"), (None, "en", "t")]
    assert audited(spark, two) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_many_sources(spark):
    docs = random_docs(900, 300, 12)
    got = audited(spark, docs)
    assert got == brute_audit(docs)
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    assert audit_sources(frame).filter(F.col("part") == "pair").count() > 10_000
