from surveylake.operators.audit import counts_by_source, dedup, observed, total_rows
from surveylake.operators.union import union_sources
from surveylake.schema import Field, SchemaDocument, union_documents


def test_union_sources_case_insensitive(spark):
    a = spark.createDataFrame([(1, "x")], "ID bigint, Name string")
    b = spark.createDataFrame([("y", 2, "z")], "name string, id int, extra string")
    out = union_sources([a, b], tag="src", tags=["a", "b"])
    assert out.columns == ["ID", "Name", "extra", "src"]
    assert dict(out.dtypes)["ID"] == "bigint"
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, "x", None, "a"), (2, "y", "z", "b")], key=repr)


def test_union_documents_first_type_wins():
    a = SchemaDocument("a", [Field("X", "INT64"), Field("y", "STRING")])
    b = SchemaDocument("b", [Field("x", "STRING"), Field("Z", "DATE")])
    u = union_documents(a, b)
    assert [(f.name, f.master_type) for f in u.fields] == [("X", "INT64"), ("y", "STRING"), ("Z", "DATE")]


def test_counts_and_dedup(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    assert total_rows([a, b]).first()[0] == 4
    assert dedup(a).count() == 2
    assert {r[0]: r[1] for r in counts_by_source({"a": a, "b": b}).collect()} == {"a": 3, "b": 1}
    c, obs = observed(a)
    c.collect()
    assert obs.get["rows"] == 3
