"""Packing token sequences by minimum bin slack.

Documents are tokenised inside Arrow tasks and cut into full windows and one
remainder each.  Only the histogram of piece lengths (at most ``capacity``
rows, whatever the corpus) reaches the planner: for each window it takes the
longest length left and finds, by a bitset subset-sum dynamic programme over
the multiset of remaining lengths, the fill closest to capacity; backtracking
gives the counts, and the pattern is repeated as often as the counts allow.
Pieces then look up their place by their rank within their length.
"""

from __future__ import annotations

import itertools
import math
import os
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PLAIN, chunked, materialise, release, strings

CAPACITY = 2048
END_ID = 1
#: Token ids kept of chunks met before; chunks to a string; texts at a time.
_MEMO_IDS, _JOINED, _SLICE = 1_500_000, 100, 128


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers.

    The tokenizer's pre-tokens and added tokens never hold or cross a space or
    newline, and neither normalisation looks across one, so a text's ids are
    those of its space- or newline-separated chunks, joined.  A chunk of Latin-1
    letters, with a full stop or comma or not, is the lower-case word and the
    mark: normalising and splitting it is skipped.  Only distinct chunks are
    looked at, only new ones encoded, many to a string and told apart by their
    offsets.  ``tests/llm`` compares with encoding whole texts.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(tokenizer_path)
        self.word = Tokenizer(self.whole.model)
        self.word.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, vocabulary = self.whole.model.end_of_word_suffix, self.whole.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.closes[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        # entry e has self.ids[self.ends[e]:self.ends[e + 1]]; both arrays have room to grow
        self.words: dict[str, int] = {}
        self.others: dict[str, int] = {}
        self.ids, self.ends = np.zeros(1024, "<u4"), np.zeros(1024, np.int64)
        self.entries = self.used = 0

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        if (need := self.used + len(ids)) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(need, "<u4")])
        if (want := self.entries + len(sizes) + 1) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(want, np.int64)])
        self.ids[self.used:need] = ids
        self.ends[self.entries + 1:want] = self.used + np.cumsum(sizes)
        self.used, self.entries = need, want - 1

    def _entries(self, known: dict[str, int], tokenizer, chunks: list[str]) -> np.ndarray:
        """The entry of each (distinct) chunk; new ones are encoded, many to a
        string.  A word ends at an id that closes a word, any other chunk where
        the next one begins in the string."""
        new = [c for c in chunks if c not in known]
        known.update(zip(new, range(self.entries, self.entries + len(new))))
        groups = [new[i:i + _JOINED] for i in range(0, len(new), _JOINED)]
        words = tokenizer is self.word
        encode = tokenizer.encode_batch_fast if words else tokenizer.encode_batch
        for group, coded in zip(groups, encode([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(coded.ids, "<u4")
            if words:
                cuts = np.flatnonzero(self.closes[ids]) + 1
                if len(cuts) != len(group):
                    raise ValueError("the tokenizer's words do not end in ids that close a word")
            else:
                begins = np.fromiter(itertools.chain.from_iterable(coded.offsets), np.int64, 2 * len(coded))[::2]
                cuts = np.searchsorted(begins, np.cumsum(np.fromiter(map(len, group), np.int64, len(group)) + 1) - 1)
            self._keep(ids, np.diff(cuts, prepend=0))
        return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))

    def _gather(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if self.used > _MEMO_IDS:
            self._forget()
        each, distinct, cuts = chunked(texts)
        plain = pc.match_substring_regex(distinct, PLAIN)
        is_plain = plain.to_numpy(zero_copy_only=False)
        entry = np.zeros(len(distinct), np.int64)
        marked = distinct.filter(plain)
        words = pc.utf8_rtrim(marked, ".,")
        lower = pc.utf8_lower(words).dictionary_encode()
        entry[is_plain] = self._entries(self.words, self.word, strings(lower.dictionary))[lower.indices.to_numpy()]
        entry[~is_plain] = self._entries(self.others, self.whole, strings(distinct.filter(pc.invert(plain))))
        # the mark of a plain chunk follows its word
        stop, comma = self._entries(self.others, self.whole, [".", ","])
        last = np.full(len(distinct), -1)
        last[is_plain] = np.where(pc.ends_with(marked, ".").to_numpy(zero_copy_only=False), stop, np.where(
            pc.ends_with(marked, ",").to_numpy(zero_copy_only=False), comma, -1))
        begins = self.ends[:self.entries + 1]
        size, more = begins[entry + 1] - begins[entry], np.where(last < 0, 0, begins[last + 1] - begins[last])
        pair = lambda x, y: np.stack([x, y], axis=1).ravel()
        ids = self._gather(self.ids, pair(begins[entry], begins[last]), pair(size, more))
        sizes = size + more
        starts = np.cumsum(sizes) - sizes
        found = self._gather(ids, starts[each], sizes[each])
        ends = np.concatenate([[0], np.cumsum(sizes[each])])[cuts]
        yield from (found[a:b] for a, b in zip(ends, ends[1:]))

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), _SLICE):
            yield from self._slice(texts.slice(at, _SLICE))


def worker_encoder(tokenizer_path: str) -> Encoder:
    """The encoder of this Python worker.  Spark reuses workers, so a task
    starts with the words that earlier tasks have met."""
    kept = sys.modules.setdefault("_surveylake_llm_worker", types.ModuleType("_surveylake_llm_worker"))
    encoders = vars(kept).setdefault("encoders", {})
    if tokenizer_path not in encoders:
        encoders[tokenizer_path] = Encoder(tokenizer_path)
    return encoders[tokenizer_path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's ids and
    ``end_id``, cut into windows of ``capacity`` and one remainder."""
    end = np.array([end_id], "<u4")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer_path)
        for batch in batches:
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column(1))):
                ids = np.append(ids, end)
                n = len(ids)
                for start in range(0, n, capacity):
                    cut = ids[start:start + capacity]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(cut))
                    crcs.append(zlib.crc32(cut))
                    totals.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (
                    starts, lengths, crcs, totals))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            release()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of ``counts`` that holds the longest length and fills
    ``capacity`` closest: length -> count.

    Bit s of ``reach`` says that some choice adds up to s.  Lengths are tried
    from long to short, each in bundles of 1, 2, 4, ... pieces; the search ends
    at an exact fill."""
    first = max(counts)
    reach, mask, steps = 1 << first, (1 << capacity + 1) - 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), (capacity - first) // length)
        bundle = 1
        while left > 0 and not reach >> capacity & 1:
            bundle = min(bundle, left)
            steps.append((length, bundle, reach))
            reach |= reach << length * bundle & mask
            left -= bundle
            bundle *= 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {first: 1}
    for length, bundle, before in reversed(steps):
        if not before >> at & 1:
            at -= length * bundle
            chosen[length] = chosen.get(length, 0) + bundle
    return chosen


@dataclass
class Plan:
    """Where the pieces of a length go: from rank ``rank`` on, ``count`` pieces
    to a sequence, the first sequence being ``sequence``, from ``offset`` on."""
    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    count: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = np.searchsorted(self.length, length, "left")
        hi = np.searchsorted(self.length, length, "right")
        row = np.empty(len(length), np.int64)
        for i, (a, b, r) in enumerate(zip(lo, hi, rank)):
            row[i] = a + np.searchsorted(self.rank[a:b], r, "right") - 1
        k = rank - self.rank[row]
        return self.sequence[row] + k // self.count[row], self.offset[row] + k % self.count[row] * length


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Patterns until nothing is left.  Each round uses up some length down to
    less than the pattern's count of it, so the number of rounds is bounded by
    the capacity (about 1.5 * capacity), not by the number of pieces."""
    left, used = dict(histogram), dict.fromkeys(histogram, 0)
    rows, sequence = [], 0
    while left:
        pattern = closest_fill(left, capacity)
        times, offset = min(left[x] // c for x, c in pattern.items()), 0
        for length, count in pattern.items():
            rows.append((length, used[length], sequence, count, offset))
            offset += length * count
            used[length] += times * count
            left[length] -= times * count
            if not left[length]:
                del left[length]
        sequence += times
    rows.sort()
    return Plan(*np.array(rows, np.int64).reshape(-1, 5).T.copy())


def _ranked(cuts: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``cuts`` with ``rank``, 0, 1, ... within each length.  A length's rows are
    salted into groups of about the root of their number, ranked there, and
    shifted by the sizes of the groups before."""
    salts = [math.ceil(c / max(256, math.isqrt(c))) for c in map(histogram.get, range(max(histogram, default=0) + 1),
                                                                 itertools.repeat(1))]
    count = F.lit(salts)[F.col("length").cast("int")]
    order = [c for c in cuts.columns if c != "length"]
    salted = cuts.withColumn("__salt", F.pmod(F.xxhash64(*order), count))
    sizes = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = sizes.select("length", "__salt", (F.sum("__n").over(
        Window.partitionBy("length").orderBy("__salt")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*order)) - 1
    return (salted.withColumn("__own", own).join(before, ["length", "__salt"])
            .withColumn("rank", F.col("__before") + F.col("__own")).drop("__salt", "__own", "__before"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset).

    A null or empty text is one piece holding ``end_id`` alone.  Repeated rows
    are packed each for itself, null ids like any other; equal rows may swap
    places, which changes nothing.  An empty table gives an empty one; other
    columns are not read.  Sequences are full but for the last few, when no
    short pieces are left to fill up with.
    """
    cuts = materialise(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "packing-pieces")
    # at most `capacity` rows, whatever the input
    histogram = {r.length: r.n for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(plan(histogram, capacity)).values()))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"]
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Plan(*shared.value)
        for batch in batches:
            sequence, offset = places.place(batch.column(2).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], out)

    schema = ", ".join(f"{c} {cuts.schema[c].dataType.simpleString()}" for c in names[:5])
    return _ranked(cuts, histogram).select(*names).mapInArrow(run, f"{schema}, sequence_id long, offset long")
