import datetime as dt

import pytest
from pyspark.sql import functions as F

from surveylake.functions import casts as C
from surveylake.schema import Field, SchemaDocument


def one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_cast_int_blank_and_values(spark):
    assert one(spark, ["12", "", "   ", None, "-7"], C.cast_int) == [12, None, None, None, -7]


def test_cast_int_strict_raises(spark):
    with pytest.raises(Exception):
        one(spark, ["x1"], C.cast_int)


def test_cast_int_lenient(spark):
    assert one(spark, ["x1", "1.5", "3"], lambda c: C.cast_int(c, strict=False)) == [None, None, 3]


def test_cast_float_is_safe(spark):
    assert one(spark, ["1.5", "abc", "", None], C.cast_float) == [1.5, None, None, None]


def test_cast_date(spark):
    assert one(spark, ["2023-01-05", ""], C.cast_date) == [dt.date(2023, 1, 5), None]
    assert one(spark, ["2023-1-5", "05/01/2023"], lambda c: C.cast_date(c, strict=False)) == [dt.date(2023, 1, 5), None]
    with pytest.raises(Exception):
        one(spark, ["2023-13-5"], C.cast_date)


def test_white_space_cells_are_blank(spark):
    """A tab or no-break space alone is no malformed value in a strict load."""
    for fn in (C.cast_int, C.cast_float, C.cast_date, C.cast_bool):
        assert one(spark, ["\t", "\u00a0", " \n\u2007"], fn) == [None, None, None]


def test_float_takes_no_java_suffixes(spark):
    assert one(spark, ["1.5d", "2f", "0x1p3", "1e3", " -.5 ", "5."], C.cast_float) == [None, None, None, 1000.0, -0.5, 5.0]


def test_key_columns_are_required(spark):
    doc = SchemaDocument("T", [Field("id", "STRING", True), Field("mes", "DATE", True), Field("v", "INT64")])
    with pytest.raises(KeyError):
        C.apply_schema(spark.createDataFrame([("a", "1")], "id string, v string"), doc)
    assert C.apply_schema(spark.createDataFrame([("a", "2024-1-5")], "ID string, MES string"), doc).collect()[0].v is None


def test_cast_datetime_all_shapes(spark):
    vals = ["2024-01-02T03:04:05", "2024-01-02T03:04Z", "2024-01-02 03:04Z", "2024-01-02T03:04",
            "2024-01-02 03:04", "2024-01-02 03:04:05", "2024-01-02T03:04:05Z",
            "2024-01-02T03:04:05.123Z", "2024/01/02 03:04", "", " 2024-01-02 03:04"]
    got = one(spark, vals, C.cast_datetime)
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] == got[2] == got[3] == got[4] == dt.datetime(2024, 1, 2, 3, 4)
    assert got[5] == got[6] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[7] == dt.datetime(2024, 1, 2, 3, 4, 5, 123000)
    assert got[8:] == [None, None, None]


def test_cast_datetime_impossible_value(spark):
    assert one(spark, ["2024-13-02 03:04"], lambda c: C.cast_datetime(c, strict=False)) == [None]
    with pytest.raises(Exception):
        one(spark, ["2024-13-02 03:04"], C.cast_datetime)


def test_cast_bool(spark):
    assert one(spark, ["true", "FALSE", "", "True"], C.cast_bool) == [True, False, None, True]
    assert one(spark, ["yes", "1"], lambda c: C.cast_bool(c, strict=False)) == [None, None]
    with pytest.raises(Exception):
        one(spark, ["yes"], C.cast_bool)


def test_apply_schema_by_name_case_insensitive(spark):
    df = spark.createDataFrame([("7", "2024-01-31", "x", "1.25")], "id string, MES_ENCUESTA string, name string, Score string")
    doc = SchemaDocument("T", [Field("ID", "INT64", True), Field("Mes_Encuesta", "DATE", True),
                               Field("score", "FLOAT64"), Field("missing", "DATE"), Field("Name", "STRING")])
    out = C.apply_schema(df, doc)
    assert out.columns == ["ID", "Mes_Encuesta", "score", "missing", "Name"]
    assert tuple(out.first()) == (7, dt.date(2024, 1, 31), 1.25, None, "x")
    assert dict(out.dtypes)["missing"] == "date"


def test_reject_count(spark):
    df = spark.createDataFrame([("x", "2024-01-01"), ("1", "bad")], "a string, d string")
    doc = [Field("a", "INT64"), Field("d", "DATE")]
    got = [r[0] for r in df.select(C.reject_count_column(df, doc)).collect()]
    assert got == [1, 1]
