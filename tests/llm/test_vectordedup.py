"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest
from helpers import SF
from pyspark.sql import functions as F

from surveylake.llm import vectordedup


def plain(rows, cosine=0.95):
    """(id, n_links, component_id, kept) by comparing all pairs."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = [set() for _ in rows]
    for i, (_, u) in enumerate(rows):
        for j, (_, v) in enumerate(rows):
            if i != j and ok[i] and ok[j] and len(u) == len(v):
                a, b = (np.array(x, float) / np.abs(x).max() for x in (u, v))
                if a @ b >= cosine * (np.linalg.norm(a) * np.linalg.norm(b)) or list(u) == list(v):
                    near[i].add(j)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for k in group:
            out[k] = (rows[k][0], len(near[k]), least, rows[k][0] is not None and rows[k][0] == least)
    return sorted(out, key=str)


def check(spark, rows, of="array<float>", id_type="long", **options):
    df = spark.createDataFrame(rows, f"vec_id {id_type}, embedding {of}")
    df = df.select("*", *(F.lit("x").alias(c) for c in ("id", "digest", "node", "key", "size", "copies", "label"))).repartition(3)
    got = sorted((tuple(r) for r in vectordedup.near_duplicates(df, **options).collect()), key=str)
    assert got == plain(rows)


def clusters(seed, size=64, groups=12, spread=0.12):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        center = rng.normal(size=size)
        for _ in range(int(rng.integers(1, 25))):
            v = center + rng.normal(size=size) * spread
            rows.append(np.float32(v / np.linalg.norm(v)).tolist())
    return rows


def test_clusters(spark):
    vectors = clusters(1)
    check(spark, [(i * 7 % 1009, v) for i, v in enumerate(vectors)])


def test_large_buckets_are_cut_into_parts(spark):
    vectors = clusters(2, groups=3, spread=0.08)
    rows = [(i, v) for i, v in enumerate(vectors)]
    for tile in (2, 5):
        check(spark, rows, tile=tile)


def test_large_groups_by_products(spark, monkeypatch):
    monkeypatch.setattr(vectordedup, "SMALL", 3)
    check(spark, [(i, v) for i, v in enumerate(clusters(3, groups=4, spread=0.08))])


def test_nasty_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 0.0]),
            (6, [float("inf"), 1.0, 1.0]), (7, v), (7, v), (8, [2.0, 4.0, 6.0]), (None, v), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]),
            (11, [-0.0, 1.0, 0.0]), (12, [0.0, 1.0, -0.0]), (None, None), (None, [5.0, -5.0, 0.0]), (13, [1e300, 2e300, 3e300]),
            (14, [1e-300, 2e-300, 3e-300]), (15, [4.0]), (16, [9.0]), (17, [-2.0]), (7, [9.0, -7.0, 1.0])]
    check(spark, rows, "array<double>")
    check(spark, [(None if i is None else f"k{i}", x) for i, x in rows], "array<double>", "string")
    check(spark, [(i, None if x is None else [None if y is None else int(y) for y in x]) for i, x in rows[6:12]], "array<int>")
    check(spark, [])


def test_recall_at_the_threshold():
    """Two vectors at a cosine of exactly 0.95 share a bucket but once in ten thousand."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=(20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + math.sqrt(1 - 0.95 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    hasher = vectordedup.Hasher(64)
    met = (hasher(a)[:, :, :, None] == hasher(b)[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.9995
    far = (hasher(a)[:, :, :, None] == hasher(np.roll(a, 1, axis=0))[:, :, None, :]).any(axis=(1, 2, 3))
    assert far.mean() <= 0.002  # vectors at right angles hardly ever meet


def test_transform_is_orthogonal():
    x = np.eye(16)
    assert np.allclose(vectordedup.hadamard(x) @ vectordedup.hadamard(x).T, x)


@pytest.mark.parametrize("n", [0, 1])
def test_embeddings(spark, n):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").limit(0 if not n else 10 ** 9)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((tuple(r) for r in vectordedup.near_duplicates(df).collect()), key=str)
    assert got == plain(rows)
