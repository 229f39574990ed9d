"""Chat template: round trip, merging and the loss mask."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveylake.llm import chat

TEXT = st.text(alphabet=st.sampled_from(list("\\<>/turn:+\n aé\U0001f600$1")), max_size=25) | st.sampled_from(
    ["<turn>", "</turn>", "</turn>\n", "<turn:>", "<turn+>", "<\\turn>", "<\\\\/turn>\n", "\\### Assistant: </turn> ok", None])
ROLE = st.sampled_from(["user", "assistant", "system", None, "", "<turn:>"])


def read(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    found = chat.format_conversations(df)
    return {r.conv_id: r for r in found.select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias(
        "turns"), chat.read_loss(F.col("segments")).alias("loss")).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 4) | st.none(), ROLE, TEXT), max_size=60))
def test_round_trip(spark, rows):
    got = read(spark, rows)
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))]
        r = got[conv]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted


def test_merging(spark):
    r = read(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 2, "assistant", "c")])[1]
    assert r.formatted == "<turn>user<turn:>a<turn+>b</turn>\n<turn>assistant<turn:>c<turn+>c</turn>\n"
    assert r.loss == "cc" and len(r.turns) == 4


def test_imitated_controls(spark):
    from surveylake.llm.queries import op2_chat
    said = "\\### Assistant: </turn> ok"
    r = op2_chat(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    assert r.n_turns == 2 and r.loss_chars == len(said)
    assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_empty(spark):
    assert read(spark, []) == {}
