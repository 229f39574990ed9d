"""Alignment of two tokenizers' tokens over the same text.

Tokenizer A is a byte-level BPE (``tokenizers``), B a byte-fallback one
(``sentencepiece``).  A's character offsets and the spans of B's proto are the
coarse cuts; where a token is not a whole number of characters (a split
multi-byte character, a byte-fallback token), its decoded bytes refine them.
Both token sequences then cut the same bytes, space + text; where both cut, a
group ends, and any A and B token that overlap are linked.

Tokens of neither cross a space between two plain characters, so a text falls
into chunks, of which only the distinct ones are encoded and aligned, many
together, once per Python worker.  Each block of documents leaves one row per distinct id pair; the pairs are counted over the
corpus, and each block gets its own pairs' counts back.
"""

from __future__ import annotations

import itertools
import operator
import os
import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, materialise, release, strings

#: A chunk may begin and end with these; none is white space to either tokenizer.
_BEGINS, _ENDS = r"^[!-~\pL\pN]", r"[!-~\pL\pN]$"
_BLOCK_BYTES = 4 << 20  # of texts to a block (a longer text is a block of its own)
_MEMO_LINKS, _MEMO_CHARS = 2_000_000, 200
_JOINED, _TOGETHER = 64, 32  # chunks to a text, texts encoded at a time
_ID, _END = operator.attrgetter("id"), operator.attrgetter("end")


def byte_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if
    it is a visible Latin-1 one, otherwise the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


class Vocabulary:
    """What a tokenizer's ids decode to, and how they are written in groups."""

    def __init__(self, decoded: dict[int, bytes]):
        size = max(decoded) + 1
        self.bytes = [decoded.get(i, b"") for i in range(size)]
        self.sizes = np.array([len(x) for x in self.bytes])
        self.names = np.array([str(i) for i in range(size)], object)

    def ends(self, text: bytes, ids: list[int], begins: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Byte position of every token's end in ``text``: that of its span, or,
        if the span is not as long as the token, that of the decoded bytes.  None
        if the tokens' bytes are not the text."""
        if b"".join(map(self.bytes.__getitem__, ids)) != text:
            return None
        sizes = self.sizes[ids]
        return np.where(ends - begins == sizes, ends, np.cumsum(sizes))


class Aligner:
    """Tokens, groups and links of chunks, each looked at once."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        self.of_a = Vocabulary({i: bytes(map(alphabet.__getitem__, t)) if all(c in alphabet for c in t) else t.encode()
                                for t, i in self.a.get_vocab(with_added_tokens=True).items()})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.of_b = Vocabulary({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)})
        #: whether no piece of B crosses a space (runs of spaces apart)
        self.cuts_at_spaces = not any(re.search("[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        # of entry e: tokens of A, of B, groups, and whether the bytes are the text's; its links (a << 32 | b) are
        # links[ends[e]:ends[e + 1]]; the arrays have room to grow
        self.sizes, self.ends = np.zeros((1024, 4), np.int64), np.zeros(1024, np.int64)
        self.links = np.zeros(4096, np.int64)
        self.entries = self.held = 0

    def _keep(self, groups: list[str], links: np.ndarray, n_links: np.ndarray, sizes: np.ndarray) -> None:
        if (need := self.held + len(links)) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros(need, np.int64)])
        if (want := self.entries + len(groups)) >= len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros((want, 4), np.int64)])
            self.ends = np.concatenate([self.ends, np.zeros(want, np.int64)])
        self.links[self.held:need] = links
        self.ends[self.entries + 1:want + 1] = self.held + np.cumsum(n_links)
        self.sizes[self.entries:want] = sizes
        self.groups += groups
        self.held, self.entries = need, want

    def _tokens(self, text: str, coded_a, coded_b) -> tuple | None:
        """(ids and byte ends of A's tokens, of B's) of a text that begins with a
        space, or None if either's bytes are not the text's."""
        raw, a = text.encode(), coded_a.ids
        spans = np.fromiter(itertools.chain.from_iterable(coded_a.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        if len(raw) != len(text):  # character offsets become byte offsets
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            place = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
            spans = place[spans]
        a_ends = self.of_a.ends(raw, a, spans[:, 0], spans[:, 1])
        if a_ends is None:
            return None
        # B's spans are of the text without the space that it adds, and lie one after another
        pieces = list(coded_b.pieces)
        b = list(map(_ID, pieces))
        ends = np.fromiter(map(_END, pieces), np.int64, len(b)) + 1
        b_ends = self.of_b.ends(raw, b, np.concatenate([[0], ends[:-1]]), ends)
        if b_ends is None:
            return None
        return np.array(a, np.int64), a_ends, np.array(b, np.int64), b_ends

    def _add(self, texts: list[str], cuts: list[np.ndarray]) -> None:
        """One entry per chunk; each text is chunks one after another, which end
        at ``cuts`` (bytes), the last one at the text's end."""
        coded_a = self.a.encode_batch(texts, add_special_tokens=False)
        coded_b = self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1)
        found, at, chunk_ends = [], 0, []
        for text, cut, x, y in zip(texts, cuts, coded_a, coded_b):
            tokens = self._tokens(text, x, y)
            if tokens is None:
                self._flush(found, chunk_ends)
                found, chunk_ends, at = [], [], 0
                if len(cut) == 1:
                    self._keep([""], np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros((1, 4), np.int64))
                else:  # one of the chunks decodes to other bytes
                    raw = text.encode()
                    alone = [raw[a:b].decode() for a, b in zip([0, *cut.tolist()], cut.tolist())]
                    self._add(alone, [np.array([len(c.encode())]) for c in alone])
                continue
            a, a_ends, b, b_ends = tokens
            found.append((a, a_ends + at, b, b_ends + at))
            chunk_ends.append(cut + at)
            at += int(cut[-1])
        self._flush(found, chunk_ends)

    def _flush(self, found: list[tuple], chunk_ends: list[np.ndarray]) -> None:
        """Aligns texts laid one after another: both tokenizers cut at every chunk's end."""
        if not found:
            return
        a, a_ends, b, b_ends = (np.concatenate(x) for x in zip(*found))
        cuts = np.concatenate(chunk_ends)
        every = np.union1d(a_ends, b_ends)  # each is the end of one overlap
        i, j = np.searchsorted(a_ends, every), np.searchsorted(b_ends, every)
        links = a[i] << 32 | b[j]
        both = (a_ends[i] == every) & (b_ends[j] == every)
        group_ends = every[both]
        # each group is written as its A tokens and its B tokens, with a mark after every token
        last_a, last_b = np.isin(a_ends, group_ends), np.isin(b_ends, group_ends)
        group_a, group_b = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
        upto_a, upto_b = np.cumsum(np.bincount(group_a, minlength=len(group_ends))), np.cumsum(np.bincount(group_b, minlength=len(group_ends)))
        written = np.empty(len(a) + len(b), object)
        written[np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]] = self.of_a.names[a] + np.where(last_a, "|", ",").astype(object)
        written[np.arange(len(b)) + upto_a[group_b]] = self.of_b.names[b] + np.where(last_b, ";", ",").astype(object)
        n_a, n_b, n_groups, n_links = (np.bincount(np.searchsorted(cuts, x), minlength=len(cuts))
                                       for x in (a_ends, b_ends, group_ends, every))
        flat, upto = written.tolist(), np.cumsum(n_a + n_b).tolist()
        groups = ["".join(flat[x:y])[:-1] for x, y in zip([0, *upto], upto)]
        self._keep(groups, links, n_links, np.stack([n_a, n_b, n_groups, np.ones(len(cuts), np.int64)], axis=1))

    def chunk_entries(self, chunks: list[str]) -> list[int]:
        """The entry of each chunk (distinct ones, without their space)."""
        new = [c for c in chunks if c not in self.known]
        plain = lambda x: "!" <= x <= "~" or x.isalpha()
        joined = [c for c in new if c and len(c) <= _MEMO_CHARS and plain(c[0]) and plain(c[-1])]
        alone = sorted(set(new).difference(joined))
        found: dict[str, int] = {}
        for i in range(0, len(joined), _JOINED * _TOGETHER):
            some = joined[i:i + _JOINED * _TOGETHER]
            found.update(zip(some, range(self.entries, self.entries + len(some))))
            parts = [some[k:k + _JOINED] for k in range(0, len(some), _JOINED)]
            self._add(["".join(" " + c for c in part) for part in parts],
                      [np.cumsum([len(c.encode()) + 1 for c in part]) for part in parts])
        for i in range(0, len(alone), _TOGETHER):
            some = alone[i:i + _TOGETHER]
            found.update(zip(some, range(self.entries, self.entries + len(some))))
            self._add([" " + c for c in some], [np.array([len(c.encode()) + 1]) for c in some])
        self.known.update((c, e) for c, e in found.items() if len(c) <= _MEMO_CHARS)
        return [self.known[c] if c in self.known else found[c] for c in chunks]

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(entry of every chunk, where each text's chunks begin and the last one's end)."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        each, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        begins, ends = (pc.match_substring_regex(coded.dictionary, p).to_numpy(zero_copy_only=False) for p in (_BEGINS, _ENDS))
        cut = np.zeros(len(each), bool)
        cut[1:] = begins[each[1:]] & ends[each[:-1]] & self.cuts_at_spaces
        cut[bounds[:-1]] = True  # a text is never empty here, so each has a first chunk
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(each)))
        words = strings(coded.dictionary)
        alone = sizes == 1
        used = np.unique(each[starts[alone]])
        longer = [" ".join([words[w] for w in each[s:s + n].tolist()]) for s, n in zip(starts[~alone].tolist(), sizes[~alone].tolist())]
        names = list(dict.fromkeys(longer).keys() - {words[w] for w in used.tolist()})
        of = self.chunk_entries([*(words[w] for w in used.tolist()), *names])
        entry = np.empty(len(starts), np.int64)
        by_word = np.zeros(len(words), np.int64)
        by_word[used] = of[:len(used)]
        entry[alone] = by_word[each[starts[alone]]]
        by_name = dict(zip(names, of[len(used):])) | {words[w]: e for w, e in zip(used.tolist(), of)}
        entry[~alone] = [by_name[x] for x in longer]
        return entry, np.searchsorted(starts, bounds)

    def whole(self, text: str) -> tuple[int, int, int, str, np.ndarray]:
        """(tokens of A, of B, groups, the groups' text, links) of a text by itself."""
        self._add([" " + text], [np.array([len(text.encode()) + 1])])
        e = self.entries - 1
        return (*self.sizes[e, :3].tolist(), self.groups[e], self.links[self.ends[e]:self.ends[e + 1]])


def worker_aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker, which outlives the task."""
    kept = sys.modules.setdefault("_surveylake_llm_worker", types.ModuleType("_surveylake_llm_worker"))
    aligners = vars(kept).setdefault("aligners", {})
    if (a_path, b_path) not in aligners:
        aligners[a_path, b_path] = Aligner(a_path, b_path)
    return aligners[a_path, b_path]


def _block(aligner: Aligner, texts: pa.Array) -> tuple[list[list], np.ndarray, np.ndarray]:
    """Columns of the block's rows (tokens of A, of B, groups, links, the groups'
    text, indexes of its distinct id pairs, how often each), the block's
    distinct id pairs in order, and how often each occurs."""
    if aligner.held > _MEMO_LINKS:
        aligner.forget()
    full = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    rows = np.flatnonzero(full.to_numpy(zero_copy_only=False))
    none = np.empty(0, np.int64)
    found: list[tuple] = [(0, 0, 0, "", none, none)] * len(texts)
    if len(rows):
        some = texts.filter(full)
        entry, bounds = aligner.split(some)
        for k, row in enumerate(rows.tolist()):
            own = entry[bounds[k]:bounds[k + 1]]
            sizes = aligner.sizes[own].sum(axis=0).tolist()
            if sizes[3] == len(own):
                of, often = np.unique(own, return_counts=True)
                n = aligner.ends[of + 1] - aligner.ends[of]
                found[row] = (*sizes[:3], ";".join([aligner.groups[e] for e in own.tolist()]),
                              _gather(aligner.links, aligner.ends[of], n), np.repeat(often, n))
            else:  # some chunk decodes to other bytes: judge the text as a whole
                *sizes, text, pairs = aligner.whole(some[k].as_py())
                found[row] = (*sizes, text, pairs.copy(), np.ones(len(pairs), np.int64))
    counts = np.array([len(f[4]) for f in found], np.int64)
    pairs, index = np.unique(np.concatenate([f[4] for f in found]), return_inverse=True)
    times = np.concatenate([f[5] for f in found])
    total = np.bincount(index, times, len(pairs)).astype(np.int64)
    columns: list[list] = [[] for _ in range(7)]
    for f, end, n in zip(found, np.cumsum(counts).tolist(), counts.tolist()):
        often = np.bincount(index[end - n:end], times[end - n:end]) if n else none
        own = np.flatnonzero(often)
        for column, value in zip(columns, (f[0], f[1], f[2], int(times[end - n:end].sum()), f[3],
                                           own.astype("<i4").tobytes(), often[own].astype("<i4").tobytes())):
            column.append(value)
    return columns, pairs, total


_DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
        ("pairs", pa.binary()), ("often", pa.binary())]
_PAIR = [("a", pa.int64()), ("b", pa.int64()), ("place", pa.int64()), ("n", pa.int64())]


def _tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row per document (place null) and one per block and distinct id pair."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["block", "id", *(n for n, _ in _DOC + _PAIR)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = worker_aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, end in blocks_of(batch.column(1), _BLOCK_BYTES):
                ids, texts = (batch.column(c).slice(begin, end - begin) for c in range(2))
                columns, pairs, total = _block(aligner, texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), block)), ids, *(pa.array(c, t) for c, (_, t) in zip(columns, _DOC)),
                     *(pa.nulls(len(ids), t) for _, t in _PAIR)], names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), block)), pa.nulls(len(pairs), ids.type),
                     *(pa.nulls(len(pairs), t) for _, t in _DOC), pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF),
                     pa.array(np.arange(len(pairs))), pa.array(total)], names)
                block += 1
            release()

    # a text that is no valid UTF-8 cannot be read by either tokenizer
    text = F.when(F.is_valid_utf8(F.col(text_col)), F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(
        run, f"block long, id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, "
             "often binary, a long, b long, place long, n long")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          keep: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """One row per row of ``docs``: (id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups).

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: A's and B's ids up to each byte where
    both end a token; ``keep`` says what is kept of it (its digest, say).
    n_links counts the pairs of an A and a B token that share bytes; a pair of
    ids counts as often as it is linked in all documents; count_sum adds that
    over the links, n_best are the links whose count no other A id reaches for
    that B id (ties all count).  Special tokens' strings are plain text.  A text
    that is null, empty, not valid UTF-8, or that either tokenizer's bytes do not give back as
    space + text (one that holds U+2581, say) has no tokens: zeros, and groups
    is empty.  Long texts are taken whole; repeated rows count each; an empty
    table gives an empty one; other columns are not read.
    """
    found = _tokens(docs, a_path, b_path, id_col, text_col).withColumn("groups", keep(F.col("groups")))
    found = materialise(found, "tokens-blocks")
    pairs = found.filter("place IS NOT NULL").select("block", "place", "a", "b", "n")
    counts = materialise(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "tokens-counts")
    most = materialise(counts.groupBy("b").agg(F.max("count").alias("most")), "tokens-most")
    ranked = materialise(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")),
                         "tokens-ranked")
    # written rows on both sides, so AQE may split a hot pair
    known = pairs.select("block", "place", "a", "b").join(ranked, ["a", "b"]).select(
        F.col("block").alias("of"), "place", "count", "best")
    rows = found.filter("place IS NULL").drop("a", "b", "place", "n")
    id_type = found.schema["id"].dataType.simpleString()

    def score(key, docs: pa.Table, pairs: pa.Table) -> pa.Table:
        # one block: its documents and its distinct pairs
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        place = pairs.column("place").to_numpy()
        count[place], best[place] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
        sums, bests = [], []
        for own, often in zip(docs.column("pairs").to_pylist(), docs.column("often").to_pylist()):
            own, often = np.frombuffer(own, "<i4"), np.frombuffer(often, "<i4").astype(np.int64)
            sums.append(int(count[own] @ often))
            bests.append(int(best[own] @ often))
        return pa.table([*(docs.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")), pa.array(bests, pa.int64()),
                         pa.array(sums, pa.int64()), docs.column("groups")],
                        ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        score, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
