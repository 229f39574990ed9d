"""Token alignment against encoding whole texts and aligning byte by byte."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
from helpers import SF, empty, nasty

from surveylake.llm import queries, tokenspans

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(tokenizers, text):
    """(ids and bytes of A's tokens, of B's) of a whole text, or none."""
    a, b = tokenizers
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in shown]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(rest)}
    if not text:
        return [], []
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
        return [], []
    return left, right


def plain(tokenizers, texts):
    """Each text's (n_a, n_b, n_groups, links, groups), from a map of bytes to tokens."""
    for text in texts:
        left, right = plain_tokens(tokenizers, text)
        own = [[k for k, (_, t) in enumerate(side) for _ in t] for side in (left, right)]
        links = sorted({(x, y) for x, y in zip(*own)})
        ends = [set(), set()]
        for e, side in zip(ends, (left, right)):
            at = 0
            for _, t in side:
                at += len(t)
                e.add(at)
        groups, begin = [], 0
        for cut in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(side[k][0]) for k in sorted(set(o[begin:cut]))) for side, o in zip((left, right), own)))
            begin = cut
        yield len(left), len(right), len(groups), [(left[x][0], right[y][0]) for x, y in links], ";".join(groups)


def check(spark, tokenizers, rows):
    texts = [t for _, t in rows]
    found = list(plain(tokenizers, texts))
    count = collections.Counter(p for f in found for p in f[3])
    most = collections.Counter()
    for (a, b), n in count.items():
        most[b] = max(most[b], n)
    want = sorted(((i, f[0], f[1], f[2], len(f[3]), sum(count[p] == most[p[1]] for p in f[3]), sum(count[p] for p in f[3]), f[4])
                   for (i, _), f in zip(rows, found)), key=str)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in tokenspans.align(df, A, B).collect()), key=str)
    assert got == want


WORDS = ["the", "fox", "jumps.", "over", "Über", "naïve", "\U0001f600", "①②", "漢字かな", "<s>", "<|endoftext|>", "x\ny", "\t", "", "",
         "don't", "123456", " ", " ", "é", "\x00", "ﬁ", "<0x41>", "a" * 300, "...", "\r\n", "​q", "_"]


def test_random_texts(spark, tokenizers):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 30))) for _ in range(400)]
    texts += [t + t for t in texts[:20]] + ["a▁b", "one ▁ two three", "▁"]
    check(spark, tokenizers, list(enumerate(texts)))


def test_nasty_rows(spark, tokenizers):
    check(spark, tokenizers, [(r.doc_id, r.text) for r in nasty(spark).collect()])
    assert tokenspans.align(empty(spark), A, B).collect() == []


def test_blocks_and_memo_make_no_difference(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(tokenspans, "_BLOCK_BYTES", 500)
    monkeypatch.setattr(tokenspans, "_MEMO_LINKS", 300)
    monkeypatch.setattr(tokenspans, "_MEMO_CHARS", 4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    check(spark, tokenizers, rows)


def test_text_that_is_no_utf8(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61ff62' AS string) AS text UNION ALL SELECT 2L, 'ab cd'")
    got = {r.id: r for r in tokenspans.align(df, A, B).collect()}
    assert got[1].n_a == 0 and got[1].groups == "" and got[2].n_a == 2


def test_query(spark, tokenizers):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = list(plain(tokenizers, [d.text for d in docs]))
    got = {r.doc_id: r for r in queries.op12_tokenspans(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, f in zip(docs, found):
        r = got[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (*f[:3], len(f[3]))
        assert r.groups_sha256 == (hashlib.sha256(f[4].encode()).hexdigest() if f[4] else "")
