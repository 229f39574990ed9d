"""Quality rules and hashed n-gram log-likelihood ratios, in DataFrame
expressions only.

Words, and pairs of adjacent words, are hashed into buckets of their own.  For
each, two smoothed multinomials over the buckets are estimated, one from trusted
documents, one from the whole raw corpus; a document's score is the mean, over
its words (pairs), of the log ratio of the two, and every document is kept or
not by thresholds that are set once, from trusted documents left out of the
counts.

Toxic documents are told by single words, so their test looks at the word with
the largest log ratio of toxic over trusted documents, and is normalised by
length in another way: how likely is it that as many distinct words of
trusted text hold one like it?
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

BUCKETS = 1 << 17  # of each of words and pairs
SMOOTHING = 1.0
#: So many labelled ids may be sent to every task (about 40 MB); beyond, Spark joins them as it sees fit.
BROADCAST_IDS = 1_000_000
#: Every FOLDS-th labelled document is left out of the counts; each of the three
#: tests may lose the share LOSS of trusted documents.
FOLDS, LOSS = 5, 0.01 / 3
NEVER = -100.0  # log share of trusted words like none that was seen
MIN_WORDS, MAX_REPEATED = 50, 50  # words; per cent of the words in repeated 3-word windows
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FEW = 32  # repeated windows of a document that are looked up one by one


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def _steps(size: Column, span: int) -> Column:
    """0, 1, ... for each run of ``span`` of ``size`` elements."""
    return F.when(size >= span, F.sequence(F.lit(0), size - span)).otherwise(F.array().cast("array<int>"))


def with_hashes(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds __n (words), __w (a hash of each word)."""
    return docs.withColumn("__w", F.transform(words_of(F.col(text_col)), lambda w: F.xxhash64(w))).withColumn("__n", F.size("__w"))


def labelled_ids(trusted: DataFrame, toxic: DataFrame, id_col: str, folds: int = FOLDS) -> DataFrame:
    """(__id, __toxic, __held): every labelled id, written; one in both is toxic."""
    def some(rows: DataFrame, is_toxic: bool) -> DataFrame:
        return rows.select(F.col(id_col).alias("__id"), F.lit(is_toxic).alias("__toxic")).dropna()

    held = F.pmod(F.xxhash64(F.lit("held out"), "__id"), F.lit(folds).cast("long")) == 0
    both = some(trusted, False).unionByName(some(toxic, True))
    ids = materialise(both.groupBy("__id").agg(F.max("__toxic").alias("__toxic")).withColumn("__held", held), "quality-labelled")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets).cast("long")).cast("int")


def word_buckets(buckets: int) -> Column:
    return F.transform("__w", lambda h: _bucket(h, buckets))


def pair_buckets(buckets: int, first: int = 0) -> Column:
    """The bucket of each pair of adjacent words, counted from ``first``."""
    return F.transform(_steps(F.size("__w"), 2),
                       lambda i: _bucket(F.xxhash64(F.get("__w", i), F.get("__w", i + 1)), buckets) + first)


def log_tails(ratios: np.ndarray, values: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Per bucket, the log of the share of trusted words (``often`` of them have
    the ratio ``values``) whose ratio is at least the bucket's; NEVER if none is."""
    order = np.argsort(values, kind="stable")
    upto = np.concatenate([[0], np.cumsum(often[order])])
    above = upto[-1] - upto[np.searchsorted(values[order], ratios, "left")]
    return np.where(above > 0, np.log(np.maximum(above, 1) / max(upto[-1], 1)), NEVER)


def learn(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS,
          smoothing: float = SMOOTHING) -> tuple[list[float], list[float], list[float] | None]:
    """Per bucket (to four decimals), the log ratios of words, and of pairs,
    trusted over raw; and, for the toxic test, the log share of trusted words
    with a ratio, toxic over trusted documents, as large as the bucket's (None
    without learned toxic and trusted documents).  For a word of a document that was learned from,
    that is the ratio without this document.  Held-out documents
    count as raw only.  The driver gets four rows a bucket."""
    hashed = with_hashes(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__t").join(ids, "__id", "left")
    learned, none = F.coalesce(~F.col("__held"), F.lit(False)), F.array().cast("array<int>")
    # after the words come the pairs, after them the distinct words of each learned document, those of each
    # held-out trusted one and, last, the learned documents themselves
    once = F.array_distinct(word_buckets(buckets))
    once = (F.when(learned, F.concat(F.transform(once, lambda b: b + 2 * buckets), F.array(F.lit(4 * buckets))))
            .when(F.col("__held") & ~F.col("__toxic"), F.transform(once, lambda b: b + 3 * buckets)).otherwise(none))
    pairs = pair_buckets(buckets, buckets)
    rows = hashed.select(F.when(learned, F.col("__toxic")).alias("__toxic"),
                         F.explode(F.concat(word_buckets(buckets), pairs, once)).alias("__b"))
    counts = rows.groupBy("__b").agg(F.count("*").alias("raw"), F.count_if(~F.col("__toxic")).alias("good"),
                                     F.count_if("__toxic").alias("bad")).toPandas()
    raw, good, bad = (np.zeros(4 * buckets + 1) for _ in range(3))
    at = counts["__b"].to_numpy()
    raw[at], good[at], bad[at] = counts["raw"], counts["good"], counts["bad"]

    def share(n: np.ndarray, total: float) -> np.ndarray:
        return np.log((n + smoothing) / total)

    words, pairs, once, held = (slice(i * buckets, (i + 1) * buckets) for i in range(4))
    found = [(share(good[x], good[x].sum() + smoothing * buckets) - share(raw[x], raw[x].sum() + smoothing * buckets))
             .round(4).tolist() for x in (words, pairs)]
    if not bad[-1] or not good[-1]:
        return *found, None
    toxic = share(bad[once], bad[-1] + 2 * smoothing)
    ratios = (toxic - share(good[once], good[-1] + 2 * smoothing)).round(4)
    without = (toxic - share(np.maximum(good[once] - 1, 0), good[-1] - 1 + 2 * smoothing)).round(4)
    tails = log_tails(ratios, np.concatenate([ratios, without]), np.concatenate([raw[held], good[once]]))
    return *found, tails.round(4).tolist()


def n_repeated() -> Column:
    """Words inside 3-word windows that occur twice or more.  __g has the windows'
    hashes and __d those that repeat (null if none does).  Up to FEW of these are
    looked up for every window.  Of more, __s has the windows' hashes and places,
    sorted: those equal to a neighbour are put back in order.  Then the words that
    the places cover are counted.
    """
    place = lambda k: F.get("__s", k)
    twin = lambda x, k: (place(k - 1).g == x.g) | (place(k + 1).g == x.g)
    there = lambda places: F.filter(places, lambda i: i.isNotNull())
    places = (F.when(F.col("__s").isNotNull(), F.sort_array(there(F.transform("__s", lambda x, k: F.when(twin(x, k), x.i)))))
              .when(F.col("__d").isNotNull(), there(F.transform("__g", lambda g, i: F.when(F.array_contains("__d", g), i)))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.coalesce(places, F.array().cast("array<int>")), start,
        lambda a, i: F.struct((a.n + i + 3 - F.greatest(a.end, i)).alias("n"), (i + 3).alias("end")), lambda a: a.n)


def _judged(docs: DataFrame, id_col: str, text_col: str, hashed: list[list[Column]], scores: dict[str, Column],
            min_words: int, max_repeated: int) -> DataFrame:
    """The base counts and ``scores`` of every document, written; the steps of
    ``hashed`` (columns of __n, __w and of steps before) are there for the scores."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = docs.select(F.col(id_col), text.alias("__t")).select("*", words_of(F.col("__t")).alias("__x"))
    base = words.select(
        id_col, F.size("__x").alias("__n"), F.transform("__x", lambda w: F.xxhash64(w)).alias("__w"),
        F.length(F.array_join("__x", "")).alias("word_chars"),
        F.length(F.regexp_replace("__t", f"[^{SYMBOLS}]+", "")).alias("n_symbols"), lines.alias("__l"))
    grams = F.transform(_steps(F.size("__w"), 3),
                        lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    for step in hashed:
        base = base.select("*", *step)
    scored = base.select(
        id_col, "__n", "word_chars", "n_symbols", (F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        grams.alias("__g"), *(x.alias(name) for name, x in scores.items()))
    repeats = F.size(F.array_distinct("__g")) < F.size("__g")
    windows = F.transform("__g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    counted = scored.select("*", F.when(repeats, F.sort_array("__g")).alias("__o"))
    counted = counted.select("*", F.array_distinct(F.filter("__o", lambda g, k: g == F.get("__o", k - 1))).alias("__d"))
    counted = counted.select("*", F.when(F.size("__d") > FEW, F.sort_array(windows)).alias("__s"))
    counted = counted.withColumn("n_repeat_words", n_repeated())
    failed = (F.col("__n") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("__n"))
    # written: a filter on the result must not be pushed into the expressions above
    return materialise(counted.select(
        id_col, F.col("__n").cast("long").alias("n_words"),
        *(F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"), *scores), "quality")


def judge(docs: DataFrame, trusted: DataFrame, toxic: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, loss: float = LOSS, min_words: int = MIN_WORDS,
          max_repeated: int = MAX_REPEATED) -> DataFrame:
    """One row per document: (id_col, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, pair_score, toxic_score,
    kept).

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeated`` per cent of them in 3-word windows that repeat.  ``score``
    and ``pair_score`` are the mean log ratios, trusted over raw, of the
    document's words and pairs, in ``buckets`` buckets each (null without any).
    ``toxic_score``: minus the log of the number of trusted words one expects,
    among as many distinct words as the document has, with a log ratio, toxic
    over trusted documents, as large as its largest (0 at least, and where a
    document of that one word would pass; null without words; 0 if nothing is
    labelled toxic, or nothing trusted).

    ``kept``: not base_failed, and no test failed.  The thresholds of the first
    two (six decimals) leave out the share ``loss`` of the trusted documents
    that pass the base rules and are not in the counts (every FOLDS-th; without
    such documents all that pass are kept); a document fails the third if fewer
    than ``loss`` such words are expected.  A null or empty text has no words.
    Repeated rows stay, and null ids, which are neither trusted nor toxic.  An
    empty table gives an empty one; other columns are not read.
    """
    ids = labelled_ids(trusted, toxic, id_col)
    words, pairs, tails = (x and F.from_json(F.lit(json.dumps(x)), "array<double>")
                           for x in learn(docs, ids, id_col, text_col, buckets))
    mean = lambda of, ratios: F.when(F.size(of) > 0, F.aggregate(
        of, F.lit(0.0), lambda a, b: a + F.get(ratios, b)) / F.size(of))
    rarest = F.lit(0.0) if tails is None else F.array_min(F.transform("__b", lambda b: F.get(tails, b)))
    # a word that is no surprise in a document of one word is none in any
    surprise = F.when(F.size("__b") == 0, F.lit(None)).when(F.col("__r") >= math.log(loss), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), -(F.col("__r") + F.log(F.size(F.array_distinct("__b"))))))
    judged = _judged(docs, id_col, text_col, [[word_buckets(buckets).alias("__b"), pair_buckets(buckets).alias("__p")],
                                              [rarest.alias("__r")]], {
        "score": mean(F.col("__b"), words), "pair_score": mean(F.col("__p"), pairs), "toxic_score": surprise},
        min_words, max_repeated)
    least = (judged.filter(~F.col("base_failed")).join(ids.filter("__held AND NOT __toxic"), judged[id_col] == ids["__id"])
             .agg(F.percentile("score", F.lit(loss)), F.percentile("pair_score", F.lit(loss))).first())
    kept = ~F.col("base_failed") & (F.col("toxic_score") <= -math.log(loss))
    for name, at in zip(("score", "pair_score"), least):
        if at is not None:  # a document of one word (min_words = 1) has no pair to be judged by
            kept = kept & F.coalesce(F.col(name) >= round(at, 6), F.lit(True))
    return judged.withColumn("kept", F.coalesce(kept, F.lit(False)))
