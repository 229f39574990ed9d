"""Language identification: held-out accuracy, backoff and odd texts."""

import collections
import random
import zlib

import numpy as np
from helpers import LONG, SF, documents, empty, nasty

from surveylake.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 150 and sum(r.lang == r.lang_pred for r in found) >= 0.99 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_folds_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count() and list(rows[0].asDict()) == ["doc_id", "held_out", "lang_pred", "score"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_counts_are_whole(spark):
    docs = spark.createDataFrame([("a b, a", "x"), ("A c", "x"), ("a", "y"), (None, "y"), ("q", None)], "text string, lang string")
    got = {(r.lang, r.word): r.n for r in langid.word_counts(docs).collect()}
    assert got == {("x", "a"): 3, ("x", "b"): 1, ("x", "c"): 1, ("y", "a"): 1}
    grams = {(r.lang, r.word, r.order): r.n for r in langid.gram_counts(langid.word_counts(docs)).collect()}
    assert grams["x", "a", 1] == 3 and grams["x", "_a", 2] == 3 and grams["x", "_a_", 3] == 3


def classify(spark, learned, texts):
    """(lang, score) of each text, learned from (text, lang) pairs."""
    rows = [(-1 - i, t, lang) for i, (t, lang) in enumerate(learned)] + [(i, t, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.id: (r.lang_pred, r.score) for r in langid.classify(docs, docs.doc_id < 0).collect()}
    return [found[i] for i in range(len(texts))]


def plain_classify(learned, texts):
    """The same by plain Python: every learned word and gram."""
    langs = sorted({x for _, x in learned})
    counts = {order: collections.defaultdict(collections.Counter) for order in (0, 4, 3, 2, 1)}
    for text, lang in learned:
        for w in langid.WORD.findall(text.lower()):
            counts[0][w][lang] += 1
            for order in langid.ORDERS:
                for g in langid.grams_of(w, order):
                    counts[order][g][lang] += 1
    totals = {o: {x: sum(c[x] for c in counts[o].values()) for x in langs} for o in counts}

    def logs(order, w):
        shares = np.array([counts[order][w][x] / totals[order][x] if totals[order][x] else 0.0 for x in langs])
        return np.log((1 - langid.BACKGROUND) * shares + langid.BACKGROUND * shares.mean())

    out = []
    for text in texts:
        words, found = langid.WORD.findall((text or "").lower()), []
        for w in words:
            if w in counts[0]:
                found.append(logs(0, w))
                continue
            for order in langid.ORDERS:
                known = [g for g in langid.grams_of(w, order) if g in counts[order]]
                if known:
                    found.append(np.mean([logs(order, g) for g in known], axis=0))
                    break
        if not words:
            out.append(("und", 0.0))
        elif not found:
            out.append((langs[0], 1 / len(langs)))
        else:
            mean = np.mean(found, axis=0)
            best = int(mean.argmax())
            out.append((langs[best], float(1 / np.exp(mean - mean[best]).sum())))
    return out


def check(spark, learned, texts):
    got, want = classify(spark, learned, texts), plain_classify(learned, texts)
    assert [x for x, _ in got] == [x for x, _ in want]
    assert max(abs(a - b) for (_, a), (_, b) in zip(got, want)) < 1e-5
    return got


def test_word_first_then_shorter_grams(spark):
    learned = [("thing nothing", "en"), ("chose rien", "fr")]
    got = check(spark, learned, ["nothing", "xxthing", "rien", "riexx", "zzz", "Zzz.", None, "", "1 2 ²", " \t", "RIEN riexx, 1 rien.", "écho"])
    assert [x for x, _ in got[:4]] == ["en", "en", "fr", "fr"]
    assert got[4:6] == [("en", 0.5)] * 2  # letters, none known: a tie
    assert got[6:10] == [("und", 0.0)] * 4


def test_rare_words_count(spark):
    """A word learned once among a hundred thousand others is known all the same."""
    rows = [(" ".join(f"common{i} and" for i in range(40)), lang) for lang in ("de", "en")] * 3
    rows += [(" ".join(f"w{lang}{i}x{k}" for i in range(500)), lang) for lang in ("de", "en") for k in range(20)]
    rows += [("seldom", "en"), ("selten", "de")]
    assert [x for x, _ in check(spark, rows, ["seldom", "selten", "selden"])][:2] == ["en", "de"]


def test_random_texts(spark, monkeypatch):
    rng = random.Random(6)
    letters = "abcdeéßñ漢字"
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(1, 7)))
    text = lambda: "".join(word() + rng.choice([" ", ", ", ".\n", "-", " 12 ", "\u0301 "]) for _ in range(rng.randrange(0, 30)))
    learned = [(text(), rng.choice(["a", "b", "c"])) for _ in range(60)]
    check(spark, learned, [text() for _ in range(60)])


def test_documents_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = lambda d: zlib.crc32(str(d.doc_id).encode()) % 5 == 0
    want = plain_classify([(d.text, d.lang) for d in docs if not held(d) and d.lang is not None], [d.text for d in docs])
    got = {r.doc_id: r for r in langid.identify(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert [got[d.doc_id].lang_pred for d in docs] == [x for x, _ in want]
    assert max(abs(got[d.doc_id].score - x) for d, (_, x) in zip(docs, want)) < 1e-5


def test_nasty_rows(spark):
    got = {}
    for r in langid.identify(nasty(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
    assert sum(map(len, got.values())) == 15
    assert all(got[i][0][:2] == ("und", 0.0) for i in (1, 2, 3, 7)) and all(held for _, _, held in got[None])
    assert got[4][0][0] == "en"
    assert langid.identify(empty(spark)).collect() == []


def test_several_blocks_of_one_batch(spark):
    """Long texts, with and without a language, fill more than one block."""
    rows = [(i, LONG + f" own{i}", ("en", None, "fr")[i % 3]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = {r.id: r for r in langid.classify(docs, docs.doc_id < 30).collect()}
    assert len(found) == 40 and all(r.lang_pred == "en" and 0 < r.score < 1 for r in found.values())  # a tie
    got = {(r.lang, r.word): r.n for r in langid.word_counts(docs).collect()}
    assert got["en", "own"] == 14 and got["fr", "own"] == 13


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.identify(docs).collect()] == [("und", 0.0)]


def test_recognised_rejects_only_und(spark):
    """A text of words that three languages share has a third of the posterior each."""
    rows = [(i, f"shared words {lang}a {lang}b", lang) for i, lang in enumerate(["de", "en", "fr"] * 40)]
    docs = documents(spark, [*rows, (200, "shared words", "en"), (201, "1 2 ...", "en"), (202, None, "en")])
    found = langid.identify(docs).filter("doc_id = 200").first()
    assert found.lang_pred != langid.UNKNOWN and found.score < 0.5
    kept = {r.doc_id for r in langid.recognised(docs).collect()}
    assert kept == {*range(120), 200}


def test_words_travel_packed(spark):
    """A block leaves a row for each shard of its words, not one for each word; all come out again."""
    rows = [(i, " ".join(f"w{chr(97 + i % 10)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(600)), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = langid._blocks(docs, docs.doc_id < 10, "doc_id", "text", "lang")
    assert found.count() <= 20 + langid.LEAST_SHARDS
    assert {r.n for r in langid.word_counts(docs).collect()} == {2} and langid.word_counts(docs).count() == 6000


def test_the_number_of_shards_makes_no_difference(spark, monkeypatch):
    learned = [("thing nothing écho 漢字", "en"), ("chose rien écho", "fr")]
    texts = ["nothing xxthing", "riexx écho", "zzz", None, "漢字 thing rien"]
    want = check(spark, learned, texts)
    for shards in (1, 200):
        monkeypatch.setattr(langid, "LEAST_SHARDS", shards)
        assert check(spark, learned, texts) == want


def test_only_words_without_a_learned_4_gram_are_cut_shorter(spark):
    logs = spark.createDataFrame([(4, "_thi", [-1.0]), (1, "t", [-9.0]), (2, "_q", [-2.0]), (1, "q", [-3.0])], "order int, word string, logs array<double>")
    words = spark.createDataFrame([("this",), ("qu",), ("zz",)], "word string")
    assert {r.word: r.logs for r in langid._by_grams(words, logs, 1).collect()} == {"this": [-1.0], "qu": [-2.0]}
