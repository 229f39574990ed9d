"""Language identification: whole words first, shorter character n-grams for
words never learned.

A word is a letter followed by letters and marks, lower-cased.  A word that was
learned, however rare, scores its log frequency per language; an unknown one
falls back to its 4-grams, then 3-, 2- and 1-grams (edges marked by ``_``), at
the first length of which any gram was learned, by their mean log frequency.

Texts are read once.  Each block of documents leaves its distinct words in
packed rows, one for each shard of the words; a shard adds its words' counts up
and answers every block with those of its words.  Words never learned are scored
by a join with the grams.  No model is held anywhere, and nothing that was
learned is cut off.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, blocks_of, chunked, map_batches, materialise, packed_row, release, strings, unpacked

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_WORD_OR_END = regex.compile(WORD.pattern + r"|\n")
UNKNOWN = "und"
ORDERS = (4, 3, 2, 1)
BACKGROUND = 0.01  # weight of the mean over all languages in each language's share
#: A shard of the words for so many bytes of text, but LEAST_SHARDS at least.
SHARD_BYTES, LEAST_SHARDS = 32 << 20, 32


def words_of_each(chunks: pa.Array) -> tuple[np.ndarray, pa.Array, list[list[str]]]:
    """Lower-cased words of chunks that hold no newline: (which chunks are one
    Latin-1 word, that word of each of these, the words of each of the rest)."""
    plain = pc.match_substring_regex(chunks, PLAIN)
    rest, found = [], []
    for word in _WORD_OR_END.findall("\n".join(strings(chunks.filter(pc.invert(plain)))).lower() + "\n"):
        if word == "\n":
            found.append(rest)
            rest = []
        else:
            rest.append(word)
    is_plain = plain.to_numpy(zero_copy_only=False)
    return is_plain, pc.utf8_lower(pc.utf8_rtrim(chunks.filter(plain), ".,")), found[:len(chunks) - int(is_plain.sum())]


def grams_of(word: str, n: int) -> list[str]:
    padded = f"_{word}_" if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _words_of_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(index of every word among the distinct ones, where each text's words
    begin and the last one's end, the distinct words)."""
    each, distinct, cuts = chunked(texts)
    is_plain, plain, rest = words_of_each(distinct)
    # the words of every distinct chunk, one after another
    counts = np.ones(len(distinct), np.int64)
    counts[~is_plain] = np.fromiter(map(len, rest), np.int64, len(rest))
    ends = np.cumsum(counts)
    coded = pa.concat_arrays([plain, pa.array(itertools.chain.from_iterable(rest), pa.string())]).dictionary_encode()
    of = coded.indices.to_numpy()
    found = np.empty(int(counts.sum()), np.int64)
    single = np.repeat(is_plain, counts)
    found[single], found[~single] = of[:len(plain)], of[len(plain):]
    # and of every chunk that there is
    sizes = counts[each]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    begins = (ends - counts)[each]
    flat = found[np.arange(upto[-1]) + np.repeat(begins - upto[:-1], sizes)]
    return flat, upto[cuts], coded.dictionary


def _pack(*columns: np.ndarray) -> bytes:
    """Numbers below 2^64, compressed; byte by byte, as the high ones are mostly 0."""
    raw = b"".join(np.asarray(c, "<u8").view("u1").reshape(-1, 8).T.tobytes() for c in columns)
    return pa.compress(raw, "zstd", asbytes=True) if raw else b""


def _unpack(packed: bytes, *sizes: int) -> list[np.ndarray]:
    """The columns of ``_pack``, of which ``sizes`` tells the lengths."""
    raw = np.frombuffer(pa.decompress(packed, 8 * sum(sizes), "zstd", asbytes=True) if packed else b"", "u1")
    cuts = np.cumsum([0, *sizes]) * 8
    return [np.ascontiguousarray(raw[a:b].reshape(8, -1).T).view("<i8").ravel() for a, b in zip(cuts, cuts[1:])]


#: A block's documents, each with the places of its distinct words and how often they stand there;
_DOCS = [("words", pa.binary()), ("n_distinct", pa.int64()), ("n_words", pa.int64())]
#: and its distinct words, by shard: the first one's place, the words, the learned counts (place, language, count).
_WORDS = [("shard", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("text", pa.binary()),
          ("langs", pa.list_(pa.string())), ("n_counts", pa.int64()), ("counts", pa.binary())]


def _block(texts: pa.Array, langs: list[str | None], shards: int) -> tuple[list[list], list[list]]:
    """Columns of the block's documents and of its distinct words; a language
    of None is not learned from."""
    flat, bounds, words = _words_of_texts(texts)
    shard = np.fromiter((zlib.crc32(w) % shards for w in words.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.int64, len(words))
    order = pc.array_sort_indices(words).to_numpy()
    order = order[np.argsort(shard[order], kind="stable")]
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    flat, words, shard = place[flat], words.take(pa.array(order)), shard[order]
    names = sorted({x for x in langs if x is not None})
    at = {x: i for i, x in enumerate(names)}
    rows: list[list] = [[] for _ in _DOCS]
    learned = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b, lang in zip(bounds.tolist(), bounds[1:].tolist(), langs):
        own, often = np.unique(flat[a:b], return_counts=True)
        if lang is not None:
            learned[0].append(own * len(names) + at[lang])
            learned[1].append(often)
        for column, value in zip(rows, (_pack(np.diff(own, prepend=0), often), len(own), b - a)):
            column.append(value)
    keys, of = np.unique(np.concatenate(learned[0]), return_inverse=True)
    n = np.bincount(of, np.concatenate(learned[1]), len(keys)).astype(np.int64)
    who = keys // max(len(names), 1)
    columns: list[list] = [[] for _ in _WORDS]
    for x in np.unique(shard).tolist():
        a, b = np.searchsorted(shard, [x, x + 1]).tolist()
        c, d = np.searchsorted(who, [a, b]).tolist()
        text = "\n".join(strings(words.slice(a, b - a))).encode()
        for column, value in zip(columns, (
                x, a, b - a, len(text), pa.compress(text, "zstd", asbytes=True), names, d - c,
                _pack(who[c:d] - a, keys[c:d] % max(len(names), 1), n[c:d]))):
            column.append(value)
    return rows, columns


def _blocks(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """One row per document (shard null) and one per block and shard of its words."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["block", "id", "learn", *(n for n, _ in _DOCS + _WORDS)]
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    shards = max(LEAST_SHARDS, size // SHARD_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end in blocks_of(batch.column(2)):
                ids, learned, texts, langs = (batch.column(c).slice(begin, end - begin) for c in range(4))
                rows, words = _block(texts, [x if own and there else None for x, own, there in zip(
                    langs.to_pylist(), learned.to_pylist(), texts.is_valid().to_pylist())], shards)
                n, m = len(ids), len(words[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), ids, learned, *(pa.array(c, t) for c, (_, t) in zip(rows, _DOCS)),
                     *(pa.nulls(n, t) for _, t in _WORDS)], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), pa.nulls(m, ids.type), pa.nulls(m, pa.bool_()),
                     *(pa.nulls(m, t) for _, t in _DOCS), *(pa.array(c, t) for c, (_, t) in zip(words, _WORDS))], names)
                block += 1
            release()

    text = F.when(F.is_valid_utf8(F.col(text_col)), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), text.alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(
        run, f"block long, id {id_type}, learn boolean, words binary, n_distinct long, n_words long, shard long, first long, n long, "
             "chars long, text binary, langs array<string>, n_counts long, counts binary")


_TOLD = [("block", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("langs", pa.list_(pa.string())), ("n_counts", pa.int64()),
         ("counts", pa.binary()), ("lang", pa.string()), ("word", pa.string()), ("place", pa.int64())]


def _added_up(shard: pa.Table) -> pa.Table:
    """Of one shard of the words, of all blocks: the count of each word in each
    language; the counts of all of a block's words, packed, for each block; and
    each block's words that were never learned, with their places."""
    parts = [pc.split_pattern(pa.array([pa.decompress(x, n, "zstd", asbytes=True).decode()]), "\n").flatten()
             for x, n in zip(shard.column("text").to_pylist(), shard.column("chars").to_pylist())]
    coded = pa.concat_arrays(parts).dictionary_encode()
    del parts
    of, words = coded.indices.to_numpy(), coded.dictionary
    sizes = shard.column("n").to_numpy()
    begins = np.concatenate([[0], np.cumsum(sizes)])
    per_block = shard.column("langs").to_pylist()
    langs = sorted({x for names in per_block for x in names})
    at = {x: i for i, x in enumerate(langs)}
    keys, ns = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin, packed, m, names in zip(begins.tolist(), shard.column("counts").to_pylist(), shard.column("n_counts").to_pylist(), per_block):
        if m:
            place, lang, n = _unpack(packed, m, m, m)
            keys.append(of[begin + place].astype(np.int64) * len(langs) + np.array([at[x] for x in names], np.int64)[lang])
            ns.append(n)
    keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(inverse, np.concatenate(ns), len(keys)).astype(np.int64)
    who, lang = np.divmod(keys, max(len(langs), 1))
    starts = np.searchsorted(who, np.arange(len(words) + 1))

    def some(rows: int, **columns) -> pa.Table:
        return pa.table([columns[c] if c in columns else pa.nulls(rows, t) for c, t in _TOLD], schema=pa.schema(_TOLD))

    blocks, firsts = shard.column("block").to_numpy(), shard.column("first").to_numpy()
    n_counts, counts = [], []
    for a, b in zip(begins.tolist(), begins[1:].tolist()):
        mine = of[a:b]
        often = np.diff(starts)[mine]
        total = int(often.sum())
        each = np.arange(total) + np.repeat(starts[mine] - np.cumsum(often) + often, often)
        n_counts.append(total)
        counts.append(_pack(often, lang[each], n[each]))
    unseen = np.flatnonzero((np.diff(starts) == 0)[of])
    block_of = np.searchsorted(begins, unseen, "right") - 1
    return pa.concat_tables([
        some(len(keys), lang=pa.array(langs, pa.string()).take(pa.array(lang)), word=words.take(pa.array(who)), n=pa.array(n)),
        some(len(sizes), block=pa.array(blocks), first=pa.array(firsts), n=pa.array(sizes),
             langs=pa.array([langs] * len(sizes), pa.list_(pa.string())), n_counts=pa.array(n_counts, pa.int64()),
             counts=pa.array(counts, pa.binary())),
        some(len(unseen), block=pa.array(blocks[block_of]), word=words.take(pa.array(of[unseen])),
             place=pa.array(firsts[block_of] + unseen - begins[block_of]))])


def _told(found: DataFrame) -> DataFrame:
    """Rows of ``_added_up``: learned (lang), packed (counts) and unseen words (place)."""

    def run(shard: pa.Table) -> pa.Table:
        told = _added_up(shard)
        release()
        return told

    return found.filter("shard IS NOT NULL").select("block", *(c for c, _ in _WORDS)).groupBy("shard").applyInArrow(
        run, "block long, first long, n long, langs array<string>, n_counts long, counts binary, lang string, word string, place long")


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, n) over all texts with a language, counted in each block before the shuffle."""
    return _told(_blocks(docs, F.lit(True), lang_col, text_col, lang_col)).filter("lang IS NOT NULL").select("lang", "word", "n")


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, word: the gram, order, n) from the word counts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[tuple[str, int], dict[str, int]] = {}
        for lang, word, n in zip(*(batch.column(i).to_numpy(zero_copy_only=False).tolist() for i in range(3))):
            for order in ORDERS:
                here = counts.setdefault((lang, order), {})
                for gram in grams_of(word, order):
                    here[gram] = here.get(gram, 0) + n
        flat = [(lang, gram, order, n) for (lang, order), here in counts.items() for gram, n in here.items()]
        langs, grams, orders, ns = zip(*flat) if flat else ((),) * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(orders, pa.int32()),
             pa.array(ns, pa.int64())], ["lang", "word", "order", "n"])

    return (map_batches(words.select("lang", "word", "n"), run, "lang string, word string, order int, n long")
            .groupBy("lang", "word", "order").agg(F.sum("n").alias("n")))


def log_shares(counts: DataFrame, langs: list[str]) -> DataFrame:
    """(order, word, logs): of every gram, the log of its share in each
    language, mixed with a little of the mean over languages."""
    totals = counts.groupBy("lang", "order").agg(F.sum("n").alias("total"))  # four rows a language
    shares = counts.join(F.broadcast(totals), ["lang", "order"]).groupBy("order", "word").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", F.col("n") / F.col("total")))).alias("by_lang"))
    shares = shares.select("order", "word", F.array(*(F.coalesce(F.col("by_lang")[x], F.lit(0.0)) for x in langs)).alias("shares"))
    mean = F.aggregate("shares", F.lit(0.0), lambda a, x: a + x) / len(langs)
    return shares.withColumn("mean", mean).select("order", "word", F.transform(
        "shares", lambda x: F.log((1 - BACKGROUND) * x + BACKGROUND * F.col("mean"))).alias("logs"))


def _means(words: DataFrame, logs: DataFrame, n_langs: int, orders: tuple[int, ...]) -> DataFrame:
    """(word, logs) of the words of which a gram of one of the ``orders`` was
    learned, from the longest such."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(w, order, g) for w in strings(batch.column(0)) for order in orders for g in grams_of(w, order)]
        out, of, grams = zip(*rows) if rows else ((),) * 3
        return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(of, pa.int32()), pa.array(grams, pa.string())],
                                          ["unseen", "order", "word"])

    grams = map_batches(words.select("word"), run, "unseen string, order int, word string")
    means = grams.join(logs.filter(F.col("order").isin(*orders)), ["order", "word"]).groupBy("unseen", "order").agg(
        F.array(*(F.avg(F.get("logs", F.lit(i))) for i in range(n_langs))).alias("logs"))
    return means.groupBy(F.col("unseen").alias("word")).agg(F.max_by("logs", "order").alias("logs"))


def _by_grams(words: DataFrame, logs: DataFrame, n_langs: int) -> DataFrame:
    """(word, logs), written, of words never learned, from the longest grams of
    which any was; words without such a gram are left out.  Most have a learned
    one of the longest grams, so only the rest are cut into shorter ones."""
    words = materialise(words, "langid-unseen")
    longest = materialise(_means(words, logs, n_langs, ORDERS[:1]), "langid-longest")
    rest = words.join(longest, "word", "left_anti")
    return longest.unionByName(materialise(_means(rest, logs, n_langs, ORDERS[1:]), "langid-shorter"))


def classify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(id, learn, lang_pred, score) of every row, learned from the rows with
    ``learn``, a text and a language."""
    id_type = docs.schema[id_col].dataType.simpleString()
    found = materialise(_blocks(docs, learn, id_col, text_col, lang_col), "langid-blocks")
    told = materialise(_told(found), "langid-words")
    counts = told.filter("lang IS NOT NULL").select("lang", "word", "n")
    totals = {r.lang: float(r.n) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row per language
    langs = sorted(totals)
    rows = found.filter("shard IS NULL").select("block", "id", "learn", "words", "n_distinct", "n_words")
    if not langs:
        return rows.select("id", "learn", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    logs = materialise(log_shares(gram_counts(counts), langs), "langid-logs")
    places = told.filter("place IS NOT NULL").select("block", "place", "word")
    scored = _by_grams(places.select("word").distinct(), logs, len(langs))
    # written rows on both sides, so AQE may split a word that many blocks have
    looked_up = places.join(scored, "word").select(F.col("block").alias("of"), F.col("place").alias("first"), F.col("logs").cast("array<float>").alias("logs"))
    packed = told.filter("counts IS NOT NULL").select(F.col("block").alias("of"), "first", "n", "langs", "n_counts", "counts")
    answers = packed.unionByName(looked_up, allowMissingColumns=True)

    def logs_of(words: pa.Table, size: int) -> np.ndarray:
        # a row per place of the block: the logs and 1, or zeros for a word of which not even a letter was learned
        table = np.zeros((size, len(langs) + 1))
        is_packed = words.column("counts").is_valid()
        seen, unseen = words.filter(is_packed), words.filter(pc.invert(is_packed))
        for first, n, names, m, counts in zip(*(seen.column(c).to_pylist() for c in ("first", "n", "langs", "n_counts", "counts"))):
            if not m:
                continue
            often, lang, count = _unpack(counts, n, m, m)
            lang = np.array([langs.index(x) for x in names], np.int64)[lang]
            shares = np.zeros((n, len(langs)))
            shares[np.repeat(np.arange(n), often), lang] = count / np.array([totals[x] for x in langs])[lang]
            known = np.flatnonzero(often)
            mixed = (1 - BACKGROUND) * shares[known] + BACKGROUND * shares[known].sum(1, keepdims=True) / len(langs)
            table[first + known, :-1] = np.log(mixed).astype(np.float32)
            table[first + known, -1] = 1
        if len(unseen):
            place = unseen.column("first").to_numpy()
            table[place, :-1] = unseen.column("logs").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
            table[place, -1] = 1
        return table

    def score(key, docs: pa.Table, words: pa.Table) -> pa.Table:
        # one block: its documents and what is known of its words
        counts = [_unpack(p, n, n) for p, n in zip(docs.column("words").to_pylist(), docs.column("n_distinct").to_pylist())]
        own = [np.cumsum(gaps) for gaps, _ in counts]
        table = logs_of(words, max((int(x[-1]) + 1 for x in own if len(x)), default=0))
        preds, scores = [], []
        for (_, often), mine, n_words in zip(counts, own, docs.column("n_words").to_pylist()):
            total = often @ table[mine]
            if not n_words:
                preds.append(UNKNOWN)
                scores.append(0.0)
            elif not total[-1]:  # letters, but none that was ever learned: all languages alike
                preds.append(langs[0])
                scores.append(1 / len(langs))
            else:
                mean = total[:-1] / total[-1]
                best = int(mean.argmax())
                preds.append(langs[best])
                scores.append(float(1 / np.exp(mean - mean[best]).sum()))
        scored = pa.table([docs.column("id"), docs.column("learn"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                          ["id", "learn", "lang_pred", "score"])
        release()
        return scored

    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        score, f"id {id_type}, learn boolean, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for the fold that is never learned from; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: (id_col, held_out, lang_pred, score).

    The frequencies are learned from the documents that are not held out and
    have a text and a language.  score is the posterior of lang_pred from the
    mean log frequency of a word; words of which not even a letter was learned
    count for nothing.  lang_pred is ``und`` with score 0 for a null or empty
    text, one without a letter or that is not valid UTF-8, or if nothing could
    be learned.  The order of documents, repeated rows and other columns make no
    difference to a row's prediction; ties go to the language that sorts first.
    An empty table gives an empty one.
    """
    found = classify(docs, ~held_out(id_col), id_col, text_col, lang_col)
    return found.select(F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, however low its
    score; all columns, whatever their names.  Only what is ``und`` goes: a null
    or letterless text, or every one if nothing could be learned.  (A text's
    prediction depends on the text alone, so rejected texts are looked up by
    their hash.)"""
    text = F.coalesce(F.md5(F.col(f"`{text_col}`")), F.lit("none"))
    keyed = docs.select(text.alias("id"), F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").alias("text"),
                        F.col(f"`{lang_col}`").alias("lang"))
    found = classify(keyed, ~held_out("own"), "id", "text", "lang")
    gone = materialise(found.filter(F.col("lang_pred") == UNKNOWN).select("id").distinct(), "langid-rejected")
    return docs.select(packed_row(docs).alias("row"), text.alias("id")).join(gone, "id", "left_anti").select(*unpacked("row", docs))
