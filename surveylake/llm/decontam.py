"""Benchmark decontamination by winnowing.

Both sides are reduced to fingerprints: the smallest k-gram hash of every
sliding window of ``window - k + 1`` k-grams.  Two texts that share ``window``
consecutive words share a whole such window of k-grams, hence its minimum.
Training and benchmark fingerprints are joined and every match is extended
word by word both ways, at most ``window - k`` words, on the words themselves:
a shared run of ``window`` words or more marks its words as hit.

An item of fewer words than a window is one window of its own length n; for
these the fingerprints are all n-grams (a window of one n-gram).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, map_batches, materialise, packed_row, release, unpacked

WINDOW, GRAM = 10, 5
#: Words are runs of anything but ASCII other than digits and letters, A-Z lower-cased.
_WORDS = bytes(b if b >= 0x80 or chr(b) in LOWER + "0123456789" else ord(chr(b).lower()) if chr(b) in UPPER else 0x20
               for b in range(256))
_FILTER_BITS = 24  # the filter below has 2^24 bits (2 MB), whatever the benchmark
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

_CONTEXT = "struct<hash:bigint,gram:int,at:int,words:array<string>,pos:array<int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def gram_hashes(words: list[bytes], gram: int, every: bool) -> np.ndarray:
    """A 64-bit hash of each ``gram`` consecutive words."""
    n = len(words) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    total = np.full(n, 2 * gram + every, np.uint64)
    for i in range(gram):
        total = total * _FACTOR + each[i:i + n]
    total ^= total >> np.uint64(32)
    return total * _MIX


def selected(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the (first) minimum of every ``span`` consecutive hashes."""
    if span == 1 or len(hashes) < span:
        return np.arange(len(hashes) if span == 1 else 0)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, span)
    found = windows.argmin(axis=1) + np.arange(len(windows))
    return np.unique(found)


def fingerprints(words: list[bytes], kinds: list[tuple[int, int]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(gram, reach, positions, hashes) for each kind (gram, span of k-grams);
    a match may have to be extended by ``reach`` words either way."""
    for gram, span in kinds:
        hashes = gram_hashes(words, gram, span == 1)
        at = selected(hashes, span)
        yield gram, span - 1, at, hashes[at]


def _kinds(n_words: int, window: int, gram: int) -> list[tuple[int, int]]:
    return [(gram, window - gram + 1)] if n_words >= window else [(n_words, 1)] if n_words else []


def _context(words: list[bytes], at: int, gram: int, reach: int) -> tuple[int, tuple[bytes, ...]]:
    first = max(0, at - reach)
    return at - first, tuple(words[first:at + gram + reach])


def item_fingerprints(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(item, need, hash, gram, at, words): benchmark fingerprints with the
    words around, as far as a match may be extended."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, out = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = words_of(text)
            for size, reach, at, hashes in fingerprints(words, _kinds(len(words), window, gram)):
                for p, h in zip(at.tolist(), hashes.view(np.int64).tolist()):
                    first, around = _context(words, p, size, reach)
                    rows.append(i)
                    out.append((min(window, len(words)), h, size, first, around))
        need, hashes, sizes, first, around = zip(*out) if out else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(need, pa.int32()), pa.array(hashes, pa.int64()),
             pa.array(sizes, pa.int32()), pa.array(first, pa.int32()),
             pa.array(around, pa.list_(pa.binary())).cast(pa.list_(pa.string()))],
            ["item", "need", "hash", "gram", "at", "words"])

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(rows, run, "item string, need int, hash long, gram int, at int, words array<string>")


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << _FILTER_BITS) - 1)
    return hashes & mask, hashes >> np.uint64(64 - _FILTER_BITS)


def _filter(prints: DataFrame) -> np.ndarray:
    """Fixed-size Bloom filter of the benchmark's hashes.  It only spares the
    shuffle rows that cannot match; a saturated filter lets all through."""
    halves = F.explode(F.array(F.col("hash").bitwiseAND(F.lit((1 << _FILTER_BITS) - 1)),
                               F.shiftrightunsigned("hash", 64 - _FILTER_BITS))).alias("bit")
    found = (prints.select(halves).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS INT))")).alias("bits")).toArrow())
    out = np.zeros(1 << _FILTER_BITS - 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def text_key(text_col: str) -> Column:
    """128 bits of a text: equal texts are matched once."""
    return F.unhex(F.md5(text_col))


def _scan(docs: DataFrame, id_col: str, text_col: str, kinds: list[tuple[int, int]],
          bits: np.ndarray) -> DataFrame:
    """(id, text_key, n_words, found): one pass over the texts; ``found`` has
    the fingerprints that pass the filter, with the words around."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    id_type = docs.schema[id_col].dataType.simpleString()
    found_type = pa.list_(pa.struct([("hash", pa.int64()), ("gram", pa.int32()), ("at", pa.int32()),
                                     ("words", pa.list_(pa.string())), ("pos", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                sizes.append(len(words))
                here: dict[tuple, list[int]] = {}
                for gram, reach, at, hashes in fingerprints(words, kinds):
                    low, high = _bits(hashes)
                    hit = known[low] & known[high]
                    for p, h in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist()):
                        first, around = _context(words, p, gram, reach)
                        here.setdefault((h, gram, first, around), []).append(p)
                found.append([{"hash": h, "gram": g, "at": a, "words": [w.decode() for w in ws], "pos": pos}
                              for (h, g, a, ws), pos in here.items()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(found, found_type)],
                ["id", "text_key", "n_words", "found"])
            release()

    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, text_key binary, n_words long, found array<{_CONTEXT}>")


def _extend(pairs: DataFrame) -> DataFrame:
    """(text_key, context, first, last): each matched pair of contexts extended
    both ways; kept if the run has the words needed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, contexts, begins, ends = [], [], [], []
        for row in batch.to_pylist():
            a, i, b, j, gram = row["words"], row["at"], row["item_words"], row["item_at"], row["gram"]
            if a[i:i + gram] != b[j:j + gram]:
                continue  # equal hashes, other words
            left = right = 0
            while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
                left += 1
            i, j = i + gram, j + gram
            while right < min(len(a) - i, len(b) - j) and a[i + right] == b[j + right]:
                right += 1
            if left + gram + right >= row["need"]:
                for p in row["pos"]:
                    keys.append(row["text_key"])
                    contexts.append(row["context"])
                    begins.append(p - left)
                    ends.append(p + gram + right)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(contexts, pa.string()),
                                           pa.array(begins, pa.int64()), pa.array(ends, pa.int64())],
                                          ["text_key", "context", "first", "last"])

    return map_batches(pairs, run, "text_key binary, context string, first long, last long")


def _covered(runs: DataFrame) -> DataFrame:
    """(text_key, n_hit): words inside any run.  A text's runs are at most its
    words, and texts are distinct here."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = []
        for spans in batch.column(1).to_pylist():
            total, end = 0, 0
            for span in sorted(spans, key=lambda s: s["first"]):
                total += max(0, span["last"] - max(end, span["first"]))
                end = max(end, span["last"])
            counts.append(total)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["text_key", "n_hit"])

    spans = runs.groupBy("text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return map_batches(spans, run, "text_key binary, n_hit long")


def _runs(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, window: int,
          gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scanned rows, benchmark fingerprints with their context's name, runs)."""
    prints = materialise(item_fingerprints(items, item_id, item_text, window, gram), "decontam-items")
    # at most `window` rows: each kind of fingerprint that the benchmark needs
    kinds = sorted((r.gram, 1 if r.need < window else window - gram + 1)
                   for r in prints.select("gram", "need").distinct().collect())
    rows = materialise(_scan(docs, id_col, text_col, kinds, _filter(prints)), "decontam-scan")
    named = prints.withColumn("context", F.md5(F.to_json(F.struct("hash", "at", "words", "need"))))
    contexts = materialise(named.select("context", "need", "hash", "gram", F.col("at").alias("item_at"), F.col(
        "words").alias("item_words")).dropDuplicates(["context"]), "decontam-contexts")
    found = rows.filter(F.size("found") > 0).select("text_key", F.explode("found").alias("f")).select(
        "text_key", "f.*").distinct()
    return rows, named, materialise(_extend(found.join(contexts, ["hash", "gram"])), "decontam-runs")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """One row per document: (id, n_words, n_hit, items).

    ``items`` lists, as sorted strings, the ids of items of which a window
    occurs in the document; ``n_hit`` counts the document's words inside any
    such occurrence.  A null, empty or wordless text has no words and no hits;
    a null item id hits but is not listed; repeated ids of either side keep
    their rows (documents) or count once (items).  Equal texts are matched once
    and joined back.  Empty tables give no rows, or rows without hits.
    """
    rows, named, runs = _runs(docs, items, id_col, text_col, item_id, item_text, window, gram)
    listed = (runs.select("text_key", "context").distinct()
              .join(named.select("context", "item").distinct(), "context")
              .groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items")))
    # written, so that the join below is of two plain exchanges and AQE may split a text with many copies
    hits = materialise(_covered(runs).join(listed, "text_key"), "decontam-hits")
    return rows.select("id", "text_key", "n_words").join(hits, "text_key", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def uncontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, all columns,
    whatever their names; rows with a null text stay."""
    _, _, runs = _runs(docs, items, id_col, text_col, item_id, item_text, window, gram)
    # written, so that its size is known: a small one is sent to every task and no text shuffled
    hit = materialise(runs.select("text_key").distinct(), "decontam-hit")
    keyed = docs.select(packed_row(docs).alias("row"), text_key(text_col).alias("text_key"))
    return keyed.join(hit, "text_key", "left_anti").select(*unpacked("row", docs))
