"""Vector codes against Python integers, one part at a time."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveylake.llm import vectorcodes


def plain(rows, parts, entries, rounds, scale=256):
    """rows (id, vector, label) -> [(id, code, error, label_error)], digest."""
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(int(x) * scale if abs(x) > 1e15 else x * scale) for x in v]
            if max(map(abs, whole)) < 2 ** 62:
                kept.append((i, whole, label))
    if not kept:
        return [], vectorcodes.digest([])
    order = lambda r: (r[0] is None, r[0] or 0, b"".join(struct.pack("<d", x) for x in r[1]))
    first = sorted(kept, key=order)
    size = len(first[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    first = [r for r in first if len(r[1]) == size][:entries]
    cuts = [size * p // parts for p in range(parts + 1)]
    books = [[r[1][a:b] for r in first] for a, b in zip(cuts, cuts[1:])]

    def nearest(book, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(nearest(books[p], v[a:b])[1], []).append(v[a:b])
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k])] if k in mine else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, label in kept:
        found = [nearest(books[p], v[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        error = min(sum(d for d, _ in found), 2 ** 63 - 1)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    return [(i, c, e, min(sums[x], 2 ** 63 - 1)) for i, c, e, x in out], hashlib.sha256(numbers.encode()).hexdigest()


def check(spark, rows, of="array<float>", parts=4, entries=5, rounds=2, scale=256):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {of}, label int")
    df = df.select("*", *(F.lit("x").alias(c) for c in ("id", "size", "vector", "code", "of", "position"))).repartition(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    coded, books = vectorcodes.compress(df, parts=parts, entries=entries, rounds=rounds, scale=scale)
    got = [(r.id, r.code, r.error, r.label_error) for r in vectorcodes.with_label_error(coded).collect()]
    want, digest = plain(rows, parts, entries, rounds, scale)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert vectorcodes.digest(books) == digest


@pytest.mark.parametrize("size, parts", [(8, 4), (7, 3), (2, 4), (12, 2)])
def test_random_vectors(spark, size, parts):
    rng = random.Random(size)
    rows = [(i * 13 % 997, [rng.randrange(-40, 40) / 256 + rng.choice([0, 0.001]) for _ in range(size)], rng.choice([None, 0, 1, 2]))
            for i in range(150)]
    check(spark, rows + rows[:30], "array<double>", parts)


def test_nasty_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (1, [1.0, 2.0, 3.0, 4.0], 1), (2, None, 1), (3, [], 1), (4, [1.0, None, 1.0, 1.0], None),
            (5, [float("nan")] * 4, 1), (6, [1.0, float("inf"), 0.0, 0.0], 1), (None, [0.5, -0.5, -0.0, 0.0], None),
            (7, [1e9, -1e9, 3.0, 2.0], None), (8, [1e15, 1.0, -1e15, 7.0], 2), (9, [1e300, 0.0, 0.0, 0.0], 2), (10, [1.0, 2.0], 3),
            (11, [1.0, 2.0, 3.0, 4.0], None)]
    check(spark, rows, "array<double>", 2, 3)
    check(spark, rows[:6], "array<double>", 4, 64)
    check(spark, rows[2:6], "array<double>", 4, 64)
    check(spark, [], "array<double>")


def test_the_trie_finds_what_a_table_finds():
    rng = np.random.default_rng(1)
    for shape in ((20_000, 3), (700, 1), (9000, 5)):
        x = np.unique(rng.integers(-9, 9, shape), axis=0)
        entries = rng.integers(-9, 9, (37, shape[1]))
        table = ((x[:, None, :] - entries) ** 2).sum(axis=2)
        index, distance = vectorcodes.nearest(x, entries)
        assert (index == table.argmin(axis=1)).all() and (distance == table.min(axis=1)).all()
