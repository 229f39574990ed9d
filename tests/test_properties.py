"""Property tests: Spark casts vs a plain-Python reading of the same rules."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveylake.functions import casts as C

SHAPES = [  # (regex, strptime format) -- the accepted DATETIME shapes
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "%Y-%m-%dT%H:%M:%S"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z", "%Y-%m-%dT%H:%MZ"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}Z", "%Y-%m-%d %H:%MZ"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}", "%Y-%m-%dT%H:%M"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", "%Y-%m-%d %H:%M"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z", "%Y-%m-%dT%H:%M:%SZ"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z", "%Y-%m-%dT%H:%M:%S.%fZ"),
]


def py_datetime(text):
    if text is None:
        return None
    for pat, fmt in SHAPES:
        if re.fullmatch(pat, text):
            try:
                return dt.datetime.strptime(text, fmt)
            except ValueError:
                return None
    return None


FORMATS = [f for _, f in SHAPES] + ["%Y/%m/%d %H:%M", "%d-%m-%Y"]
texts = st.one_of(
    st.builds(lambda d, f: d.strftime(f).replace("%f", "")[: None],
              st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 12, 31)),
              st.sampled_from(FORMATS)),
    st.text(alphabet="0123456789-:TZ. ", max_size=24),
    st.none())


def fix_millis(s):
    # strftime's %f gives 6 digits; the accepted shape has exactly 3
    return re.sub(r"\.(\d{3})\d{3}Z$", r".\1Z", s) if s else s


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=40))
def test_cast_datetime_matches_python(spark, values):
    values = [fix_millis(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(C.cast_datetime(F.col("c"), strict=False)).collect()]
    assert got == [py_datetime(v) for v in values]


def py_int(text):
    if text is None or text.strip() == "":
        return None
    return int(text) if re.fullmatch(r"\s*[+-]?\d+\s*", text) and abs(int(text)) < 2**63 else None


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-10**12, 10**12).map(str), st.text(alphabet="0123456789 -x.", max_size=8),
                          st.none()), min_size=1, max_size=40))
def test_cast_int_lenient_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(C.cast_int(F.col("c"), strict=False)).collect()]
    assert got == [py_int(v) for v in values]


from surveylake.operators import merge as Mg  # noqa: E402

month_rows = st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 6, 28))),
                                st.sampled_from(["a", "b"])), max_size=10)


def naive_replace(dest, sources):
    table = list(dest)
    for src in sources:
        months = {(r[1].year, r[1].month) for r in src if r[1] is not None}
        table = [r for r in table if r[1] is None or (r[1].year, r[1].month) not in months] + list(src)
    return sorted(table, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(month_rows, month_rows, month_rows, month_rows)
def test_month_replace_three_sources(spark, dest, s1, s2, s3):
    mk = lambda rows: spark.createDataFrame(rows, "id int, m date, v string")
    got = Mg.month_replace(mk(dest), [(mk(s1), "m"), (mk(s2), "m"), (mk(s3), "m")], "m")
    assert sorted(map(tuple, got.collect()), key=repr) == naive_replace(dest, [s1, s2, s3])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.text("xyz", max_size=2)), max_size=12),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.text("xyz", max_size=2)), max_size=12))
def test_upsert_matches_delete_then_insert(spark, old, new):
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string")
    got = Mg.upsert_by_key(mk(old), mk(new), ["k"])
    new_keys = {k for k, _ in new if k is not None}
    want = [r for r in old if r[0] is None or r[0] not in new_keys] + list(new)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


from surveylake.operators.nested import explode_prefixed  # noqa: E402

item_lists = st.one_of(st.none(), st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.text("ab", max_size=2))),
                                           max_size=3))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(item_lists, max_size=8))
def test_explode_prefixed_matches_python(spark, lists):
    rows = [(i, v) for i, v in enumerate(lists)]
    df = spark.createDataFrame(rows, "id int, it array<struct<k:int, v:string>>")
    got = sorted((tuple(r) for r in explode_prefixed(df, "it").collect()), key=repr)
    want = []
    for i, items in rows:
        if items is None:
            want.append((i, None, None))          # NULL list: row kept
        else:
            want.extend((i, k, v) for k, v in items)   # empty list: row dropped
    assert got == sorted(want, key=repr)


vals = st.tuples(st.one_of(st.none(), st.integers(-1, 1)), st.one_of(st.none(), st.sampled_from(["", "a"])))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 6), vals, max_size=6), st.dictionaries(st.integers(0, 6), vals, max_size=6))
def test_changed_rows_matches_python(spark, old, new):
    mk = lambda d: spark.createDataFrame([(k, n, s) for k, (n, s) in d.items()], "k int, n bigint, s string")
    types = {"n": "INT64", "s": "STRING"}
    sentinel = lambda a, b: ((a[0] if a[0] is not None else 0) != (b[0] if b[0] is not None else 0)
                             or (a[1] if a[1] is not None else "") != (b[1] if b[1] is not None else ""))
    for mode, differs in (("sentinel", sentinel), ("null_safe", lambda a, b: a != b)):
        got = sorted(r.k for r in Mg.changed_rows(mk(old), mk(new), ["k"], types, mode=mode).collect())
        want = sorted(k for k in new if k in old and differs(old[k], new[k]))
        assert got == want, mode


from surveylake.functions import cleanse as X  # noqa: E402


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(alphabet="<>/:np0xh-1 2", max_size=16),
                          st.sampled_from(["<n0:p:x>", "</n0:a>", "http://p:x", "<p:n0:y/>"])),
                min_size=1, max_size=20))
def test_text_cleansers_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = df.select(X.strip_prefixes("c"), X.strip_offset("c"), X.period("c")).collect()
    for v, (a, b, c) in zip(values, got):
        assert a == re.sub(r"(</?)(?:n0|p):", r"\1", v)
        assert b == re.sub(r"-\d{2}:\d{2}$", "", v)
        parts = v.split("-")
        assert c == (parts[0] + parts[1] if len(parts) >= 3 else None)
