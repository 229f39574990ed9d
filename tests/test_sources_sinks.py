import base64
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from surveylake.schema import Field, SchemaDocument, dictionary_to_fields, documents_from_dictionary, load_schema
from surveylake.sinks import writers as W
from surveylake.sources.documents import read_envelope, read_xml_folder
from surveylake.sources.sheets import read_sheet_export


def test_read_sheet_export_blank_cells(spark, tmp):
    p = os.path.join(tmp, "sheet.csv")
    with open(p, "w") as f:
        f.write('identificador_unico,Mes_Encuesta,Comentario\n1,2024-01-05,"hola, ""mundo"""\n2,,\n')
    df = read_sheet_export(spark, tmp)
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("1", "2024-01-05", 'hola, "mundo"'), ("2", "", "")]
    assert all(t == "string" for _, t in df.dtypes)


def test_schema_document_roundtrip(spark, tmp):
    doc = SchemaDocument("BD_X", [Field("identificador_unico", "STRING", True, "X0"),
                                  Field("Mes_Encuesta", "DATE", True, "0001-01-01"),
                                  Field("Score", "INT64", False, "0")], {"load_period": "daily"})
    p = os.path.join(tmp, "BD_X.input.schema")
    with open(p, "w") as f:
        f.write(doc.dumps())
    got = load_schema(spark, os.path.join(tmp, "missing.schema"), fallback=p)
    assert [(x.name, x.master_type, x.primary_key, x.default) for x in got.fields] == \
        [("identificador_unico", "STRING", True, "X0"), ("Mes_Encuesta", "DATE", True, "0001-01-01"),
         ("Score", "INT64", False, "0")]
    assert got.config == {"load_period": "daily"}
    assert got.name == "BD_X"


def test_dictionary_to_documents(spark):
    d = spark.createDataFrame([("STRING", "identificador_unico", "ID"), ("DATE", "Mes_Encuesta", None),
                               ("INT64", "", "n")], "DATA_TYPE string, A string, B string")
    rows = {(r.table, r.column): (r.master_type, r.primary_key, r.default)
            for r in dictionary_to_fields(d).collect()}
    assert rows == {("A", "identificador_unico"): ("STRING", True, "X0"),
                    ("A", "Mes_Encuesta"): ("DATE", True, "0001-01-01"),
                    ("B", "ID"): ("STRING", False, "X0"), ("B", "n"): ("INT64", False, "0")}
    docs = {d.name: [f.name for f in d.fields] for d in documents_from_dictionary(d)}
    assert docs == {"A": ["identificador_unico", "Mes_Encuesta"], "B": ["ID", "n"]}


def test_xml_folder_and_envelope(spark, tmp):
    xml_dir = os.path.join(tmp, "xml")
    os.makedirs(os.path.join(xml_dir, "sub"))
    for i, d in enumerate(["<R><S><A>1</A></S></R>", "<R><S><A>2</A></S></R>"]):
        with open(os.path.join(xml_dir, "sub" if i else "", f"d{i}.xml"), "w") as f:
            f.write(d)
    with open(os.path.join(xml_dir, "skip.txt"), "w") as f:
        f.write("x")
    docs = read_xml_folder(spark, xml_dir)
    assert sorted(r.payload for r in docs.collect()) == ["<R><S><A>1</A></S></R>", "<R><S><A>2</A></S></R>"]
    env_dir = os.path.join(tmp, "env")
    os.makedirs(env_dir)
    body = {"data": [{"interfaceValue": base64.b64encode(b"<R/>").decode()}, {"interfaceValue": "QQ=="}]}
    with open(os.path.join(env_dir, "r1.json"), "w") as f:
        json.dump(body, f, indent=2)
    env = read_envelope(spark, env_dir).collect()
    assert len(env) == 2 and len({r.doc_key for r in env}) == 2


def test_envelope_keys_do_not_depend_on_splits(spark, tmp):
    """JSON lines, equal responses among them: one key per document, the same
    however the file is split."""
    with open(os.path.join(tmp, "r.json"), "w") as f:
        for i in range(600):
            data = [{"interfaceValue": f"doc{i % 200}-{j}" + "x" * 50} for j in range(3)]
            f.write(json.dumps({"data": data}) + "\n")
    keys = []
    for size in ("1m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = read_envelope(spark, tmp, multi_line=False).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        keys.append(sorted((r.doc_key, r.payload) for r in rows))
    assert keys[0] == keys[1] and len({k for k, _ in keys[0]}) == 1800


def test_replace_months_partition_overwrite(spark, tmp):
    dest = os.path.join(tmp, "processed")
    mk = lambda rows: spark.createDataFrame(rows, "id int, m date, src string")
    W.replace_months(dest, [(mk([(1, dt.date(2024, 1, 5), "a"), (2, dt.date(2024, 2, 5), "a"),
                                 (3, None, "a")]), "m")])
    W.replace_months(dest, [(mk([(4, dt.date(2024, 2, 9), "raw"), (5, dt.date(2024, 3, 9), "raw")]), "m"),
                            (mk([(6, dt.date(2024, 3, 1), "sql"), (7, None, "sql")]), "m")])
    got = sorted((r.id, r.src) for r in spark.read.parquet(dest).collect())
    assert got == [(1, "a"), (3, "a"), (4, "raw"), (6, "sql"), (7, "sql")]


def test_replace_months_retry_and_files(spark, tmp):
    """A retried load adds nothing; a month is not one file per task."""
    dest = os.path.join(tmp, "processed")
    df = spark.range(4000).selectExpr("id", "if(id % 40 = 0, null, add_months(date'2024-01-01', int(id % 12))) AS m")
    for ts in (dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2), dt.datetime(2024, 5, 2)):
        W.replace_months(dest, [(df.repartition(16), "m")], ts)
    out = spark.read.parquet(dest)
    assert out.where("m IS NOT NULL").count() == 3900 and out.where("m IS NULL").count() == 200
    assert len(out.inputFiles()) <= 2 * 14


def test_history_retry_counts_once(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for ts in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2)):
        W.append_audited(df, f"{tmp}/h", "u", ts)
    assert spark.read.parquet(f"{tmp}/h").count() == 2




def test_exports_archives_log(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "None")], "k int, v string")
    W.write_raw(df, os.path.join(tmp, "raw"))
    raw = spark.read.parquet(os.path.join(tmp, "raw"))
    assert sorted(map(tuple, raw.collect()), key=repr) == sorted([("1", "a"), ("1", "a"), ("2", None)], key=repr)
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert W.export_history(df, tmp, "T", ts).endswith("T_HISTORY_20240102_030405")
    p = W.export_csv(df, tmp, "T", ts)
    assert spark.read.option("header", True).csv(p).count() == 2
    docs = spark.createDataFrame([("k1", "<a/>")], "doc_key string, xml string")
    xp = W.archive_xml(docs, tmp, "Sub")
    assert spark.read.parquet(xp).where(F.col("table_name") == "Sub").count() == 1
    W.log_load(spark, os.path.join(tmp, "log"), "D", "T", "T_RawToProcessed", 3, "u", ts)
    W.log_load(spark, os.path.join(tmp, "log"), "D", "T", "T_RawToProcessed", 4, "u", ts)
    assert sorted(r.CANT_REGISTROS for r in spark.read.parquet(os.path.join(tmp, "log")).collect()) == [3, 4]


def test_ensure_table_and_append(spark, tmp):
    from surveylake.plans.models import REASON_V1_SCHEMA
    name = "surveylake_test_reason_" + os.path.basename(tmp).replace("-", "_")
    W.ensure_table(spark, name, REASON_V1_SCHEMA, ["Domain"], location=f"{tmp}/tbl")
    W.ensure_table(spark, name, REASON_V1_SCHEMA, ["Domain"], location=f"{tmp}/tbl")   # idempotent
    cols = [c.name for c in spark.catalog.listColumns(name)]
    assert set(cols) == set(REASON_V1_SCHEMA.fieldNames())
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["Domain"]
    spark.sql(f"DROP TABLE {name}")


def test_ingest_all_and_parquet_snapshot(spark, tmp):
    from surveylake.sources.sheets import ingest_all, read_parquet
    for name, rows in {"BD_A": "k,Mes_Encuesta\n1,2024-01-01\n", "BD_A_SQL": "K,MES_ENCUESTA\n2,\n"}.items():
        os.makedirs(os.path.join(tmp, name))
        with open(os.path.join(tmp, name, "export.csv"), "w") as f:
            f.write(rows)
    frames = ingest_all(spark, {n: os.path.join(tmp, n) for n in ("BD_A", "BD_A_SQL")})
    assert {n: [tuple(r) for r in df.collect()] for n, df in frames.items()} == \
        {"BD_A": [("1", "2024-01-01")], "BD_A_SQL": [("2", "")]}
    frames["BD_A"].write.parquet(os.path.join(tmp, "snap"))
    assert read_parquet(spark, os.path.join(tmp, "snap")).count() == 1
    typed = read_sheet_export(spark, os.path.join(tmp, "snap"), fmt="parquet")
    assert all(t == "string" for _, t in typed.dtypes)


def test_split_sheets_have_the_rows_of_whole_ones(spark, tmp):
    """Cells with line breaks, doubled quotes and commas, cut at every 40 bytes or so."""
    import os
    import random

    from surveylake.sources.sheets import read_sheet_export
    rng = random.Random(3)
    os.makedirs(f"{tmp}/s")
    cell = lambda: "".join(rng.choice(["a", "b c", ",", "\n", '""', "\r\n", "é", "long " * 30, ""]) for _ in range(rng.randrange(0, 6)))
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\n")):
        rows = ['id,"two\nlines",c']
        for i in range(120):
            rows.append(f'{name}{i},"{cell()}",' + rng.choice(["", "plain", f'"{cell()}"']))
        with open(f"{tmp}/s/{name}", "w", newline="") as f:
            f.write(end.join(rows) + rng.choice(["", end]))
    # multiLine leaves the carriage return of a line end in the last cell
    want = sorted((a, b, c.removesuffix("\r")) for a, b, c in read_sheet_export(spark, f"{tmp}/s").collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (40, 700, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = read_sheet_export(spark, f"{tmp}/s", split=True)
            got = sorted(map(tuple, df.collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert df.columns == ["id", "two\nlines", "c"] and len(got) == 360
        assert got == want
