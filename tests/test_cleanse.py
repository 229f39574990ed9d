import datetime as dt

from pyspark.sql import functions as F

from surveylake.functions import cleanse as X


def col(spark, values, fn, ddl="c string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_sentinels(spark):
    assert col(spark, ["None", "nan", "x", None], X.nz) == [None, "nan", "x", None]
    assert col(spark, ["None", "nan", "x"], X.nan) == ["None", None, "x"]
    assert col(spark, ["None", "nan", "x"], lambda c: X.null_if_text(c, "None", "nan")) == [None, None, "x"]


def test_recode_table_driven(spark):
    assert col(spark, ["A", "B", None], lambda c: X.recode(c, {"A": "2000"})) == ["2000", None, None]


def test_composite_key_null_propagates(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9), "C1", "S1"), (dt.date(2024, 3, 9), None, "S1")],
                               "m date, c string, s string")
    got = [r[0] for r in df.select(X.composite_key("m", "c", "s")).collect()]
    assert got == ["3-C1-S1", None]


def test_period_and_day_text(spark):
    assert col(spark, ["2024-03-09", "bad", None], X.period) == ["202403", None, None]
    assert col(spark, [dt.date(2024, 3, 9)], X.day_text, "c date") == ["2024-03-09"]


def test_strip_offset_only_negative(spark):
    assert col(spark, ["2024-01-01T10:00:00-05:00", "2024-01-01T10:00:00+02:00"], X.strip_offset) == \
        ["2024-01-01T10:00:00", "2024-01-01T10:00:00+02:00"]


def test_strip_prefixes_keeps_text(spark):
    xml = '<n0:Root><p:A>http://host/p:x</p:A></n0:Root>'
    assert col(spark, [xml], X.strip_prefixes) == ['<Root><A>http://host/p:x</A></Root>']


def test_base64_roundtrip_and_bad_input(spark):
    long_text = "<a>" + "x" * 200 + "</a>"
    enc = col(spark, [long_text], X.encode_base64_text)[0]
    assert "\n" not in enc
    assert col(spark, [enc, "%%%not base64"], X.decode_base64_text) == [long_text, None]


def test_camel_and_upper(spark):
    assert X.camel_name("a.bC") == "ABC"
    assert X.camel_name("ITEM.SEQ") == "ITEMSEQ"
    df = spark.createDataFrame([(1,)], "a_b int")
    assert X.upper_columns(df).columns == ["A_B"]


def test_stringify_frame(spark):
    df = spark.createDataFrame([(1, "None", "nan")], "a int, b string, c string")
    assert tuple(X.stringify_frame(df).first()) == ("1", None, "nan")


def test_base64_with_mime_line_breaks(spark):
    import base64 as b64
    text = "<doc>" + "é" * 120 + "</doc>"
    mime = b64.encodebytes(text.encode()).decode()      # 76-char lines with \n
    assert "\n" in mime.strip()
    assert col(spark, [mime, mime.replace("\n", "\r\n")], X.decode_base64_text) == [text, text]
