import hashlib
import math
import random

import numpy as np
import pytest
from termloom.llm.codebooks import compress_vectors, nearest, walsh


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) rows and the digest, with Python numbers."""
    kept = [
        (i, label, [math.floor(256 * float(x)) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], None
    width = max(1, -(-max(len(v) for _, _, v in kept) // parts))
    cut = []
    for _, _, v in kept:
        v = v + [0] * (width * parts - len(v))
        cut.append([v[p * width : (p + 1) * width] for p in range(parts)])
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            for row in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, hit in zip(cut, found) if hit[p][1] == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in hit) for hit in found]
    labels = {}
    for (_, label, _), error in zip(kept, errors):
        labels[label] = labels.get(label, 0) + error
    out = [
        (i, "".join(f"{k:02x}" for _, k in hit), error, labels[label])
        for (i, label, _), hit, error in zip(kept, found, errors)
    ]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def compressed(spark, rows, extra="", **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    if extra:
        df = df.selectExpr("*", *(f"1 AS {name}" for name in extra.split()))
    got = compress_vectors(df, **options).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=order), {r.codebooks_sha256 for r in got}


def check(spark, rows, extra="", **options):
    want, digest = brute_codes(rows, **options)
    got, digests = compressed(spark, rows, extra, **options)
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert digests == ({digest} if want else set())


def test_codes_equal_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(64)], draw.choice([None, 1, 2])) for i in range(300)]
    check(spark, rows)


def test_codes_of_messy_vectors(spark):
    draw = random.Random(6)
    rows = [(i, [float(draw.randint(-1, 1)) for _ in range(20)], None if i % 3 else 7) for i in range(90)]
    rows += [
        (100, None, 1), (101, [1.0, None] * 10, 1), (102, [math.nan] * 20, 1), (103, [math.inf] * 20, 2),
        (104, [], 3), (105, [0.5] * 3, 3), (None, [0.25] * 20, None), (3, [0.5] * 20, 1), (3, [0.5] * 20, 1),
    ]
    check(spark, rows, extra="vector code _n _k0")
    check(spark, rows, parts=3, entries=5, rounds=1)


def test_enormous_components_stay_exact(spark):
    draw = random.Random(8)
    rows = [(i, [draw.uniform(-1, 1) * 2.0**18 for _ in range(32)], i) for i in range(80)]
    check(spark, rows, entries=4)


def test_codes_of_few_and_no_vectors(spark):
    check(spark, [(5, [1.0, 2.0] * 16, 1), (2, [0.0, -2.0] * 16, None)])
    check(spark, [(5, [], 1)])
    check(spark, [(5, None, 1)])
    check(spark, [])


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 16])
def test_nearest_entry_by_transform(width):
    draw = np.random.default_rng(width)
    parts, entries = draw.integers(-3, 4, (200, width)), draw.integers(-3, 4, (64, width))
    distances = ((parts[:, None] - entries) ** 2).sum(axis=2)
    index, distance = nearest(parts, entries)
    assert (index == distances.argmin(axis=1)).all()
    assert (distance == distances.min(axis=1)).all()


def test_waves_are_in_order_of_sequency():
    waves = walsh(np.eye(16, dtype=np.int64)).T
    assert [int((np.diff(wave) != 0).sum()) for wave in waves] == list(range(16))
