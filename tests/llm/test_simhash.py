"""SimHash near-duplicates against brute force over all pairs."""

import random

import xxhash
from helpers import SF, empty, nasty

from surveylake.llm import simhash


def plain_fingerprint(text, shingle=3):
    import re
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius):
    """fingerprint -> smallest fingerprint reachable."""
    todo, root = set(fps), {}
    for start in sorted(fps):
        if start in todo:
            todo.discard(start)
            stack = [start]
            while stack:
                x = stack.pop()
                root[x] = start
                near = {y for y in todo if (x ^ y).bit_count() <= radius}
                todo -= near
                stack += near
    return root


def check(spark, docs, text="text"):
    rows = [(r.doc_id, r[text]) for r in docs.select("doc_id", text).collect()]
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    root = components({f for _, f in fps}, 3)
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f, least.get(root[f])) for i, f in fps), key=str)
    got = sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == want


def test_documents(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_nasty_rows(spark):
    check(spark, nasty(spark))


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.representatives(empty(spark)).collect() == []


def test_links_hold_all_components(spark):
    """Chains, cliques and pairs just in and out of reach, over many tiles."""
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 30)):
            fps.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for rows in (4, 1024):
        from surveylake.llm.components import connected_components
        edges = simhash.links(df, 3, rows)
        assert all((u % (1 << 64) ^ v % (1 << 64)).bit_count() <= 3 for u, v in edges.collect())
        found = {r.node % (1 << 64): r.root for r in connected_components(edges).collect()}
        by_root = {}
        for x in fps:
            by_root.setdefault(found.get(x, signed(x)), set()).add(x)
        want = {}
        for x, r in components(fps, 3).items():
            want.setdefault(r, set()).add(x)
        assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))


def test_representatives(spark):
    docs = nasty(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 4 stands for its copies (5, 5, null), 1 for all wordless texts
    assert ids.count(4) == 1 and ids.count(1) == 1 and 5 not in ids and None not in ids and 2 not in ids
    assert simhash.near_duplicates(kept).groupBy("root").count().filter("count > 1").count() == 0
