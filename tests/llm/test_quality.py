"""Base counts and the log-likelihood ratio against plain Python."""

import bisect
import math
import random
import re
import statistics
import struct
from collections import Counter

import numpy as np
import xxhash
from helpers import SF, documents, empty, nasty
from pyspark.sql import functions as F

from surveylake.llm import quality
from surveylake.llm.queries import op4_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    grams = list(zip(words, words[1:], words[2:]))
    counts = Counter(grams)
    inside = {j for i, g in enumerate(grams) if counts[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(inside))


def hashes_of(text):
    """Hash of each word, and of each pair of adjacent words, as signed 64-bit numbers."""
    h = lambda data, seed: xxhash.xxh64(data, seed=seed).intdigest()
    of_long = lambda x, seed: h(struct.pack("<Q", x), seed)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    words = [h(w.encode(), 42) for w in WORD.findall(text or "")]
    return [signed(w) for w in words], [signed(of_long(b, of_long(a, 42))) for a, b in zip(words, words[1:])]


def plain(rows, labelled, loss=quality.LOSS, n=quality.BUCKETS):
    """Every column by plain Python.  rows: (id, text); labelled: id -> (toxic, held)."""
    raw, good = ({k: Counter() for k in "wp"} for _ in range(2))
    seen, docs, held = {True: Counter(), False: Counter()}, Counter(), Counter()
    hashed = []
    for i, text in rows:
        of = dict(zip("wp", ([x % n for x in side] for side in hashes_of(text))))
        hashed.append(of)
        toxic, is_held = labelled.get(i, (None, True)) if i is not None else (None, True)
        for k in "wp":
            raw[k].update(of[k])
            if toxic is False and not is_held:
                good[k].update(of[k])
        if toxic is not None and not is_held:
            seen[toxic].update(set(of["w"]))
            docs[toxic] += 1
        if toxic is False and is_held:
            held.update(set(of["w"]))
    totals = {k: (sum(good[k].values()) + n, sum(raw[k].values()) + n) for k in "wp"}
    ratio = lambda k, b: round(math.log((good[k][b] + 1) / totals[k][0]) - math.log((raw[k][b] + 1) / totals[k][1]), 4)
    bad = lambda b: round(math.log((seen[True][b] + 1) / (docs[True] + 2)) - math.log((seen[False][b] + 1) / (docs[False] + 2)), 4)
    words = [bad(b) for b, k in held.items() for _ in range(k)]
    for b, k in seen[False].items():  # a learned document's words are judged without it
        alone = math.log((seen[True][b] + 1) / (docs[True] + 2)) - math.log(k / (docs[False] + 1))
        words += [round(alone, 4)] * k
    words.sort()

    def tail(r):
        above = len(words) - bisect.bisect_left(words, r)
        return math.log(above / len(words)) if above else quality.NEVER

    out = []
    for (i, text), of in zip(rows, hashed):
        counts = base(text)
        scores = [statistics.fmean(ratio(k, b) for b in of[k]) if of[k] else None for k in "wp"]
        surprise = None
        if of["w"]:
            rarest = 0.0 if not docs[True] or not docs[False] else min(round(tail(bad(b)), 4) for b in set(of["w"]))
            surprise = 0.0 if rarest >= math.log(loss) else max(0.0, -(rarest + math.log(len(set(of["w"])))))
        out.append([i, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0], *scores, surprise])
    least = [None, None]
    mine = [r for r in out if r[0] is not None and labelled.get(r[0]) == (False, True) and not r[6]]
    if mine:
        least = [round(float(np.percentile([r[k] for r in mine], 100 * loss)), 6) for k in (7, 8)]
    for r in out:
        r.append(not r[6] and r[9] <= -math.log(loss) and all(x is None or r[k] is None or r[k] >= x - 2e-6 for k, x in zip((7, 8), least)))
    return out


def check(spark, docs, good, toxic):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    labelled = {r["__id"]: (r["__toxic"], r["__held"]) for r in quality.labelled_ids(good, toxic, "doc_id").collect()}
    want = plain(rows, labelled)
    found = quality.judge(docs, good, toxic)
    assert found.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                             "score", "pair_score", "toxic_score", "kept"]
    got = found.collect()
    assert len(got) == len(want)
    order = lambda x: (str(x[0]), *x[1:6], str(x[7] is None), x[7] or 0)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert tuple(a[:7]) == tuple(b[:7])
        for x, y in zip(a[7:10], b[7:10]):
            assert x == y if y is None else math.isclose(x, y, abs_tol=3e-4)
        assert a.kept == b[10]
    return got


def ids(spark, values):
    return spark.createDataFrame([(i,) for i in values], "doc_id long")


def test_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), labels.filter("quality = 1 AND toxic = 0"), labels.filter("toxic = 1"))
    assert any(r.kept for r in got) and not all(r.kept for r in got)


def test_made_up_texts(spark):
    rng = random.Random(4)
    common = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(common, k=rng.choice([55, 90, 200]))) for _ in range(150)]
    rows = [(i, t + (" scum" if 100 <= i < 145 else ""), "en") for i, t in enumerate(texts)] + [(300, " ".join(["zap"] * 60), "en")]
    got = {r.doc_id: r for r in check(spark, documents(spark, rows), ids(spark, range(100)), ids(spark, [*range(100, 140), 99]))}
    assert not any(got[i].kept for i in range(100, 145))
    assert sum(got[i].kept for i in range(99)) >= 96


def test_nasty_rows(spark):
    rows = nasty(spark).union(documents(spark, [
        (20, "a b c a b c a b c d\na b c\n\n a b c\nx", None), (21, "| # | <> $%&* a b a b a b a", None)]))
    check(spark, rows, ids(spark, [4, 4, None, 99]), ids(spark, [None, 11]))
    check(spark, rows, ids(spark, []), ids(spark, []))
    assert quality.judge(empty(spark), ids(spark, [1]), ids(spark, [2])).collect() == []


def test_verdicts_agree_with_labels(spark):
    """Only what the labels left out of the counts tell counts here."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    found = op4_quality(spark, sf)
    assert found.count() == docs.count()
    insult = F.col("text").rlike(r"(?i)\b(idiot|trash|clown|worthless|pathetic|disgusting|scum|moron)\b")
    rows = (found.join(labels, "doc_id").join(docs.select("doc_id", insult.alias("insult")), "doc_id")
            .filter("NOT base_failed").collect())
    share = lambda x: sum(r.kept for r in x) / len(x)
    assert share([r for r in rows if r.quality and not r.toxic]) >= 0.97
    assert share([r for r in rows if not r.quality]) <= 0.1
    assert share([r for r in rows if r.quality and r.toxic and r.insult]) <= 0.2


def test_clean_text_is_kept_whatever_its_length(spark):
    """Clean documents joined to longer ones are kept as the single ones are."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    clean = labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    good = quality.labelled_ids(clean, labels.filter("toxic = 1"), "doc_id").filter("__held AND NOT __toxic")
    own = docs.join(good, docs.doc_id == good["__id"]).select("doc_id", "text").collect()
    longer = [(10 ** 6 + k, "\n".join(r.text for r in own[k:k + 20])) for k in range(0, len(own) - 20, 4)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(longer, "doc_id long, text string"))
    found = quality.judge(every, clean, labels.filter("toxic = 1"))
    single, joined = (found.filter(c).filter("NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
                      for c in (F.col("doc_id").isin([r.doc_id for r in own]), F.col("doc_id") >= 10 ** 6))
    assert single >= 0.985 and joined >= single - 0.015


def test_every_label_is_learned_from(spark):
    good, toxic = (spark.range(a, b).select(F.col("id").alias("doc_id")) for a, b in ((0, 25_000), (24_990, 50_000)))
    ids = quality.labelled_ids(good, toxic, "doc_id")
    assert ids.count() == 50_000 and ids.filter("__toxic").count() == 25_010


def test_few_and_many_repeated_windows(spark, monkeypatch):
    """Windows that repeat are looked up one by one or found by sorting, with the same counts."""
    rng = random.Random(7)
    texts = [" ".join(rng.choices("abcdefgh"[:k], k=n)) for k in (1, 2, 4, 8) for n in (3, 4, 30, 300)] + ["a b\x0bc $% a  b c", None]
    rows = documents(spark, [(i, t, "en") for i, t in enumerate(texts)])
    want = {i: base(t) for i, t in enumerate(texts)}
    for few in (0, quality.FEW, 1000):
        monkeypatch.setattr(quality, "FEW", few)
        got = {r.doc_id: tuple(r)[1:6] for r in quality.judge(rows, ids(spark, []), ids(spark, [])).collect()}
        assert got == want
