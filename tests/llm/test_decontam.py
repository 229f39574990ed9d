"""Winnowing against a search for every window at every place."""

import random
import re

from helpers import SF, documents, empty, nasty

from surveylake.llm import decontam

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for doc, text in docs:
        words = words_of(text)
        hit, found = set(), set()
        for item, other in items:
            theirs = words_of(other)
            size = min(window, len(theirs))
            grams = {tuple(theirs[i:i + size]) for i in range(len(theirs) - size + 1)} if size else set()
            for i in range(len(words) - size + 1) if size else ():
                if tuple(words[i:i + size]) in grams:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((doc, len(words), len(hit), sorted(found - {"None"})))
    return sorted(out, key=str)


def check(spark, docs, items):
    got = sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in decontam.contamination(docs, items).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == brute(rows, [(r.item_id, r.text) for r in items.collect()])
    kept = sorted(str(r.doc_id) for r in decontam.uncontaminated(docs, items).collect())
    assert kept == sorted(str(i) for i, _, n, _ in got if not n)
    return got


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_documents(spark):
    got = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert any(n for _, _, n, _ in got)


def test_few_words_over_and_over(spark):
    """A tiny vocabulary: windows overlap, repeat and cross everywhere."""
    rng = random.Random(3)
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice("ab") for _ in range(n))
    docs = documents(spark, [(i, text(rng.randrange(0, 60)), None) for i in range(40)])
    items = items_of(spark, [(i, text(rng.randrange(0, 16))) for i in range(12)] + [(3, text(14)), (None, text(12))])
    check(spark, docs, items)


def test_short_and_odd_items(spark):
    docs = nasty(spark)
    check(spark, docs, items_of(spark, [
        (1, "The LAZY dog"), (2, None), (3, ""), (4, "..."), (5, "carte"), (5, "idle"), (10, "é"),
        (11, "quick brown fox jumps over the lazy dog again and again"), (12, " ".join(f"word{i}" for i in range(970, 977)))]))


def test_empty(spark):
    items = items_of(spark, [(1, "a b c")])
    assert decontam.contamination(empty(spark), items).collect() == []
    assert decontam.contamination(nasty(spark), items.limit(0)).filter("n_hit > 0").count() == 0
