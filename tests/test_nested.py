import base64

import pytest
from pyspark.sql import types as T

from surveylake.operators.nested import (DocumentLayout, conform_to_schema, decode_children, decode_documents,
                                         explode_prefixed, flatten_struct, read_xml_children, rejected_documents)
from surveylake.schema import Field

S = T.StringType()
LAYOUT = DocumentLayout(
    "Root", "Sub", ["H1", "H2"], ["B"], ["SB"],
    T.StructType([
        T.StructField("H1", T.StructType([T.StructField(n, S) for n in
                                          ["TRANSMITDATE", "INVOICEDATE", "WORKORDERNUMBER", "URL", "X"]])),
        T.StructField("H2", T.StructType([T.StructField("X", S), T.StructField("Y", S)])),
        T.StructField("B", T.ArrayType(T.StructType([
            T.StructField("N", S), T.StructField("X", S), T.StructField("WORKORDERNUMBER", S),
            T.StructField("SB", T.ArrayType(T.StructType([T.StructField("V", S), T.StructField("N", S)])))]))),
    ]))

DOC = """<n0:Root xmlns:n0="urn:x">
<n0:Sub><H1><TRANSMITDATE>2024-01-02T10:00:00-05:00</TRANSMITDATE><WORKORDERNUMBER>W1</WORKORDERNUMBER>
<URL>http://a/p:b</URL><X>h1</X></H1><H2><X>h2</X><Y>y</Y></H2>
<B><N>1</N><X>bx</X><SB><V>a</V></SB><SB><V>b</V></SB></B>
<B><N>2</N><WORKORDERNUMBER>W9</WORKORDERNUMBER></B></n0:Sub>
<n0:Sub><H1><TRANSMITDATE>2024-01-03T10:00:00+01:00</TRANSMITDATE><INVOICEDATE>2024-01-04T00:00:00-05:00</INVOICEDATE></H1>
<B><N>3</N><SB><V>c</V></SB></B></n0:Sub>
</n0:Root>"""


def b64(s):
    return base64.b64encode(s.encode()).decode()


def decoded(spark):
    docs = spark.createDataFrame([("d1", b64(DOC)), ("bad", "%%%")], "doc_key string, payload string")
    return decode_documents(docs, LAYOUT)


def test_header_rows(spark):
    h = decoded(spark)["H1"].orderBy("TRANSMITDATE").collect()
    assert len(h) == 2
    assert h[0]["TRANSMITDATE"] == "2024-01-02T10:00:00" and h[0]["TRANSMITDATE_CT"].endswith("-05:00")
    assert h[1]["TRANSMITDATE"] == "2024-01-03T10:00:00+01:00"
    assert h[1]["INVOICEDATE"] == "2024-01-04T00:00:00" and h[0]["INVOICEDATE"] is None
    assert h[0]["X"] == "h2"          # later header element wins a clash
    assert h[0]["URL"] == "http://a/p:b"
    assert h[0]["WORKORDERNUMBER_HEADER"] == h[0]["WORKORDERNUMBER"] == "W1"


TWO = DocumentLayout("R", "S", ["H"], ["B1", "B2"], ["I"], T.StructType([
    T.StructField("H", T.StructType([T.StructField("ID", T.StringType())])),
    *(T.StructField(b, T.ArrayType(T.StructType([
        T.StructField("V", T.StringType()),
        T.StructField("I", T.ArrayType(T.StructType([T.StructField("C", T.StringType())])))]))) for b in ("B1", "B2"))]))
TWO_DOC = ("<R><S><H><ID>1</ID></H><B1><V>a</V><I><C>x</C></I></B1>"
           "<B2><V>b</V><I><C>y</C></I><I><C>z</C></I></B2></S></R>")


def test_two_body_tables_share_a_sub_body(spark):
    """Rows of every body table come in, each linked to its own body row."""
    d = decode_documents(spark.createDataFrame([("d", b64(TWO_DOC))], "doc_key string, payload string"), TWO)
    bodies = {r["UUID"]: r["V"] for b in ("B1", "B2") for r in d[b].collect()}
    assert sorted(bodies.values()) == ["a", "b"]
    items = d["I"].collect()
    assert sorted((bodies[r["UUID_BODY"]], r["C"]) for r in items) == [("a", "x"), ("b", "y"), ("b", "z")]
    assert len({r["UUID"] for r in items}) == 3


def test_rejected_documents(spark):
    rows = [("good", b64(TWO_DOC)), ("cut", b64(TWO_DOC[:60])), ("base64", "%%%"), ("root", b64("<Q><Z>1</Z></Q>")),
            ("null", None)]
    docs = spark.createDataFrame(rows, "doc_key string, payload string")
    assert {r.doc_key: r.reason for r in rejected_documents(docs, TWO).collect()} == {
        "cut": "xml", "base64": "base64", "root": "xml", "null": "base64"}
    assert decode_documents(docs, TWO)["H"].count() == 1
    with pytest.raises(Exception, match="does not decode"):
        decode_documents(docs, TWO, strict=True)["H"].collect()


def test_equal_children_have_their_own_ids(spark, tmp):
    with open(f"{tmp}/a.xml", "w") as f:
        f.write("<R>" + TWO_DOC[3:-4] * 3 + "</R>")
    d = decode_children(read_xml_children(spark, tmp, TWO), TWO)
    assert len({r["UUID"] for r in d["H"].collect()}) == 3
    assert d["B1"].join(d["H"].withColumnRenamed("UUID", "UUID_HEAD"), "UUID_HEAD").count() == 3


def test_body_rows_header_wins_and_work_order(spark):
    d = decoded(spark)
    b = d["B"].orderBy("N").collect()
    assert [r["N"] for r in b] == ["1", "2", "3"]
    assert b[0]["X"] == "h2"                       # header wins over body X
    assert b[0]["WORKORDERNUMBER"] == "W1" and b[1]["WORKORDERNUMBER"] == "W9"
    assert b[1]["WORKORDERNUMBER_HEADER"] == "W1"
    assert b[0]["SBV"] == "a" and b[1]["SBV"] is None   # first sub-body element flattened
    heads = {r["UUID"] for r in d["H1"].collect()}
    assert {r["UUID_HEAD"] for r in b} <= heads


def test_sub_body_rows(spark):
    d = decoded(spark)
    s = d["SB"].orderBy("V").collect()
    assert [r["V"] for r in s] == ["a", "b", "c"]
    assert s[0]["N"] == "1"            # body wins over the sub-body's own N
    assert s[0]["SB"] == ""
    bodies = {r["UUID"] for r in d["B"].collect()}
    assert {r["UUID_BODY"] for r in s} <= bodies


def test_ids_are_deterministic(spark):
    a = sorted(r["UUID"] for r in decoded(spark)["SB"].collect())
    b = sorted(r["UUID"] for r in decoded(spark)["SB"].collect())
    assert a == b and len(set(a)) == 3


def test_explode_prefixed_null_keeps_empty_drops(spark):
    df = spark.createDataFrame([(1, [(1, "a"), (2, "b")]), (2, None), (3, [])],
                               "id int, items array<struct<k:int, v:string>>")
    out = explode_prefixed(df, "items")
    assert out.columns == ["id", "items.k", "items.v"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, 1, "a"), (1, 2, "b"), (2, None, None)], key=repr)


def test_flatten_struct_first_of_list(spark):
    df = spark.createDataFrame([(1, (("x", [("p",), ("q",)]),))],
                               "id int, s struct<a: struct<b: string, c: array<struct<d: string>>>>")
    out = flatten_struct(df, "s")
    assert out.columns == ["id", "AB", "ACD"]
    assert tuple(out.first()) == (1, "x", "p")


def test_conform_to_schema(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "K int, PK string, V double")
    out = conform_to_schema(df, [Field("K"), Field("PK", primary_key=True, default="X0"), Field("V"), Field("M")])
    assert tuple(out.first()) == ("1", "X0", "2.5", None)


def test_rowtag_reader_path(spark, tmp):
    import os
    from surveylake.operators.nested import decode_children, read_xml_children
    with open(os.path.join(tmp, "d.xml"), "w") as f:
        f.write(DOC)
    d = decode_children(read_xml_children(spark, tmp, LAYOUT), LAYOUT)
    h = d["H1"].collect()
    b = d["B"].collect()
    s = d["SB"].collect()
    assert len(h) == 2 and len(b) == 3 and len(s) == 3
    assert {r["UUID_HEAD"] for r in b} <= {r["UUID"] for r in h}
    assert {r["UUID_BODY"] for r in s} <= {r["UUID"] for r in b}
    assert sorted(r["TRANSMITDATE"] for r in h) == ["2024-01-02T10:00:00", "2024-01-03T10:00:00+01:00"]
    assert {r["URL"] for r in h} == {"http://a/p:b", None}
