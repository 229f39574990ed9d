"""Token ids, places and fill of packed sequences."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from helpers import SF, documents, empty, nasty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from surveylake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE, ENCODER = Tokenizer.from_file(PATH), packing.Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAéÉßſKİıΣσς'sdl.,!1 \n\t\r\x0b\x1c\x85\xa0\u0301\u1e9e\u2028ªµ×÷Ǆ中\U0001f600"
                                                      "<|endoftx>")), max_size=40)
                | st.sampled_from(["<|endoftext|>x", "don't they're", "É" * 90, "ab." * 40, "Hello,World."]), max_size=6))
def test_ids_are_those_of_whole_texts(texts):
    want = [e.ids for e in WHOLE.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ENCODER(pa.array(texts, pa.string()))] == want


def check(spark, docs, capacity=2048):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = Counter()
    for (i, _), e in zip(rows, WHOLE.encode_batch([t for _, t in rows], add_special_tokens=False)):
        ids = e.ids + [1]
        for start in range(0, len(ids), capacity):
            cut = ids[start:start + capacity]
            want[i, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), len(ids)] += 1
    got = packing.pack(docs, PATH, capacity=capacity).collect()
    assert Counter(tuple(r[:5]) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return sum(r.length for r in got) / (capacity * max(1, len(by_sequence)))


def test_documents(spark):
    assert check(spark, spark.read.parquet(f"{SF}/documents.parquet")) > 0.98


def test_nasty_rows(spark):
    check(spark, nasty(spark), capacity=64)
    assert packing.pack(empty(spark), PATH).collect() == []


def test_one_length_holds_most_rows(spark):
    """Ranks within a length are dense over its salted groups."""
    docs = documents(spark, [(i, "a b c" if i % 3 else "a " * (i % 50), None) for i in range(2000)])
    assert check(spark, docs, capacity=32) > 0.9


def test_closest_fill():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        capacity, first = rng.randrange(30, 60), max(counts)
        items = list(itertools.chain.from_iterable([n] * c for n, c in counts.items()))
        items.remove(first)
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k)
                   if (s := first + sum(c)) <= capacity)
        chosen = packing.closest_fill(counts, capacity)
        assert sum(n * c for n, c in chosen.items()) == best and chosen[first] >= 1
        assert all(c <= counts[n] for n, c in chosen.items())


def test_plan_does_not_grow_with_counts():
    rng = random.Random(4)
    histogram = {n: rng.randrange(1, 9) for n in range(1, 2049)}
    small, large = (packing.plan({n: c * k for n, c in histogram.items()}) for k in (1, 1_000_003))
    assert len(large.length) < 3 * len(small.length)
    tokens = sum(n * c for n, c in histogram.items()) * 1_000_003
    assert tokens / 2048 / (int((large.sequence).max()) + 1) > 0.99
