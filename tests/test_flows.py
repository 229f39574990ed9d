import base64
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.operators.nested import DocumentLayout
from surveylake.plans import flows
from surveylake.plans import models as M
from surveylake.plans.incremental import (advance_watermark, incremental_window, load_watermark,
                                          request_window, save_watermark)
from surveylake.schema import Field, SchemaDocument
from surveylake.streaming.landing import consume_landing

SF = "/root/testdata/sf0.001"

RAW_DOC = SchemaDocument("BD_T", [Field("identificador_unico", "STRING", True, "X0"),
                                  Field("Mes_Encuesta", "DATE", True, "0001-01-01"),
                                  Field("Score", "INT64")])
SQL_DOC = SchemaDocument("BD_T_SQL", [Field("IDENTIFICADOR_UNICO", "STRING", True, "X0"),
                                      Field("MES_ENCUESTA", "DATE", True, "0001-01-01"),
                                      Field("SCORE", "INT64"), Field("PERIODO_CARGA", "STRING")])


def test_ingest_sheet_and_process_table(spark, tmp):
    sheet = spark.createDataFrame([("a", "2024-01-05", "3"), ("b", "2024-02-05", ""), ("c", "", "1")],
                                  "identificador_unico string, Mes_Encuesta string, Score string")
    n = flows.ingest_sheet(sheet, f"{tmp}/raw/BD_T", f"{tmp}/exp", "BD_T", dt.datetime(2024, 3, 1))
    assert n == 3
    raw = spark.read.parquet(f"{tmp}/raw/BD_T")
    assert sorted(r.Period for r in raw.collect() if r.Period) == ["202401", "202402"]
    sql = spark.createDataFrame([("d", "2024-02-20", "5", "202402")],
                                "IDENTIFICADOR_UNICO string, MES_ENCUESTA string, SCORE string, PERIODO_CARGA string")
    sql.write.parquet(f"{tmp}/raw/BD_T_SQL")
    cfg = flows.TableConfig("BD_T", f"{tmp}/raw/BD_T", f"{tmp}/raw/BD_T_SQL", RAW_DOC, SQL_DOC,
                            f"{tmp}/prc/BD_T", f"{tmp}/prc/BD_T_HISTORY", f"{tmp}/exp", f"{tmp}/log", "SURVEY")
    ts = dt.datetime(2024, 3, 1, 9, 0, 0)
    out = flows.process_table(spark, cfg, "tester", ts)
    assert out["rows_read"] == 4
    prc = spark.read.parquet(f"{tmp}/prc/BD_T")
    # February: the SQL export replaces the sheet; the blank-month row is kept.
    assert sorted(r.identificador_unico for r in prc.collect()) == ["a", "c", "d"]
    assert set(prc.columns) >= {"USUARIO", "FECHA_CARGA", "PERIODO_CARGA", "month_key"}
    # a retry of the load changes nothing; a later load replaces the months again,
    # and a blank-month row, which is never deleted, comes in once more
    flows.process_table(spark, cfg, "tester", ts)
    assert sorted(r.identificador_unico for r in spark.read.parquet(f"{tmp}/prc/BD_T").collect()) == ["a", "c", "d"]
    flows.process_table(spark, cfg, "tester", ts + dt.timedelta(hours=1))
    prc2 = spark.read.parquet(f"{tmp}/prc/BD_T")
    assert sorted(r.identificador_unico for r in prc2.collect()) == ["a", "c", "c", "d"]
    assert spark.read.parquet(f"{tmp}/prc/BD_T_HISTORY").count() == 8
    assert spark.read.parquet(f"{tmp}/log").count() == 6


def test_document_etl(spark, tmp):
    layout = DocumentLayout("R", "S", ["H"], ["B"], [], T.StructType([
        T.StructField("H", T.StructType([T.StructField("ID", T.StringType())])),
        T.StructField("B", T.ArrayType(T.StructType([T.StructField("V", T.StringType())])))]))
    xml = "<n0:R><n0:S><H><ID>1</ID></H><B><V>a</V></B><B><V>a</V></B></n0:S></n0:R>"
    docs = spark.createDataFrame([("k", base64.b64encode(xml.encode()).decode())], "doc_key string, payload string")
    tables = {"H": SchemaDocument("T_HEAD", [Field("ID", primary_key=True, default="X0"), Field("UUID")]),
              "B": SchemaDocument("T_BODY", [Field("ID"), Field("V"), Field("UUID_HEAD")])}
    counts = flows.run_document_etl(docs, layout, tables, f"{tmp}/raw", f"{tmp}/exp", "API", dt.datetime(2024, 1, 1))
    assert counts == {"T_HEAD": 1, "T_BODY": 2, "__rejected": 0}
    # the two identical bodies differ in nothing the RAW table keeps -> one row
    assert spark.read.parquet(f"{tmp}/raw/T_BODY").count() == 1
    assert spark.read.parquet(f"{tmp}/exp/XML").count() == 1


def test_publish_models_idempotent(spark, tmp):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    from surveylake.plans.q_models import ORG_CODES, model_sources
    srcs = model_sources(spark, SF, "ReasonDissatisfaction")
    flows.publish_models(srcs, "ReasonDissatisfaction", f"{tmp}/model", ORG_CODES)
    flows.publish_models(srcs, "ReasonDissatisfaction", f"{tmp}/model", ORG_CODES)
    assert spark.read.parquet(f"{tmp}/model").count() == o.count()


def test_incremental_publish_keeps_undated_rows(spark, tmp):
    from surveylake.plans.q_models import ORG_CODES, model_sources
    every = model_sources(spark, SF, "ReasonDissatisfaction")
    key = next(iter(every))
    undated = every[key].select(*(F.lit(None).cast(t).alias(c) if t == "date" or c.upper().startswith("PERIOD") else c
                                  for c, t in every[key].dtypes)).cache()
    n = undated.count()
    cut = undated.where(F.xxhash64(*undated.columns) % 2 == 0)
    half = [cut, undated.where(F.xxhash64(*undated.columns) % 2 != 0)]
    for part in (half[0], half[1], half[1], every[key]):
        flows.publish_models({key: part}, "ReasonDissatisfaction", f"{tmp}/model", ORG_CODES)
    out = spark.read.parquet(f"{tmp}/model")
    assert out.where("survey_month IS NULL").count() == n > 0
    assert out.where("survey_month IS NOT NULL").count() == every[key].count()


def test_mapping_shapes():
    counts = {(d, o): len(M.survey_mapping(d, o)) for d in M.DOMAINS for o in M.ORIGINS}
    assert counts[("PRIME", "sheet")] == 59 and counts[("SERVICE", "sql")] == 79
    assert len(M.reason_v2_mapping("SERVICE", "sql")) == 60
    assert len(M.reason_v2_mapping("SERVICE", "sheet")) == 79
    assert "Period" not in dict(M.reason_v2_mapping("SERVICE", "sheet"))
    assert len(M.SURVEY_COLUMNS) == 102 and len(M.V2_COLUMNS) == 103


def test_incremental_window_rules():
    today = dt.date(2024, 5, 10)
    w = request_window({"fecinicio_query": "20240510", "fecfin_query": "20240511", "interfaz_query": "I"}, today)
    assert w.start == dt.datetime(2024, 5, 9) and w.end == dt.datetime(2024, 5, 11)
    w = request_window({}, today)
    assert w.start == dt.datetime(2024, 4, 10) and w.end == dt.datetime(2024, 5, 10)
    saved = advance_watermark({"fecinicio_query": "x", "fecfin_query": "20240511", "interfaz_query": "I"}, w, today)
    assert saved["fecinicio_query"] == "20240510"
    # the next window starts where this one ended, whatever end is configured
    for day in (12, 13):
        nxt = request_window(saved, dt.date(2024, 5, day))
        assert nxt.start == w.end and nxt.end == dt.datetime(2024, 5, day)
        saved, w = advance_watermark(saved, nxt), nxt
    assert request_window(saved, dt.date(2024, 5, 13)).start == dt.datetime(2024, 5, 12)


def test_watermark_state(spark, tmp):
    save_watermark(spark, f"{tmp}/wm", "api", {"fecinicio_query": "20240101"})
    save_watermark(spark, f"{tmp}/wm", "api", {"fecinicio_query": "20240102"})
    assert load_watermark(spark, f"{tmp}/wm", "api") == {"fecinicio_query": "20240102"}
    assert load_watermark(spark, f"{tmp}/wm", "other") == {} and load_watermark(spark, f"{tmp}/none", "api") == {}


def test_unreadable_state_is_an_error_and_stays(spark, tmp):
    import os
    save_watermark(spark, f"{tmp}/wm", "api", {"fecinicio_query": "20240101"})
    with open(f"{tmp}/wm/bad.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        load_watermark(spark, f"{tmp}/wm", "api")
    os.rename(f"{tmp}/wm/bad.parquet", f"{tmp}/wm/_bad")
    assert load_watermark(spark, f"{tmp}/wm", "api") == {"fecinicio_query": "20240101"}


def test_incremental_window_pushdown(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    w = request_window({}, dt.date(2024, 1, 20))
    plan = incremental_window(e, "ts", w)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan


def test_consume_landing_once(spark, tmp):
    land = f"{tmp}/landing"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.write.parquet(land)
    n1 = consume_landing(spark, land, df.schema, f"{tmp}/sink", f"{tmp}/ckpt")
    n2 = consume_landing(spark, land, df.schema, f"{tmp}/sink", f"{tmp}/ckpt")
    assert (n1, n2) == (2, 0)
    assert spark.read.parquet(f"{tmp}/sink").count() == 2


def test_consume_landing_counts_every_batch(spark, tmp):
    """More batches than the query keeps progress of."""
    land = f"{tmp}/landing"
    spark.range(120).repartition(120).write.parquet(land)
    n = consume_landing(spark, land, spark.range(1).schema, f"{tmp}/sink", f"{tmp}/ckpt", max_files_per_trigger=1)
    assert n == spark.read.parquet(f"{tmp}/sink").count() == 120


def test_process_domain_config_loop(spark, tmp):
    for doc in (RAW_DOC, SQL_DOC):
        with open(f"{tmp}/{doc.name}.input.schema", "w") as f:
            f.write(doc.dumps())
    spark.createDataFrame([("a", "2024-01-05", "3")], "identificador_unico string, Mes_Encuesta string, Score string") \
        .write.parquet(f"{tmp}/raw_ds/BD_T")
    spark.createDataFrame([("d", "2024-02-20", "5", "202402")],
                          "IDENTIFICADOR_UNICO string, MES_ENCUESTA string, SCORE string, PERIODO_CARGA string") \
        .write.parquet(f"{tmp}/raw_ds/BD_T_SQL")
    config = spark.createDataFrame([("SURVEY", "T;BD_T;BD_T_SQL", "raw_ds", "prc_ds"),
                                    ("OTHER", "X;BD_X;BD_X_SQL", "raw_ds", "prc_ds")],
                                   "DOMINIO string, TABLA string, DATASET_STAGE string, DATASET_DESTINO string")
    res = flows.process_domain(spark, config, "SURVEY", tmp, tmp, "tester", dt.datetime(2024, 3, 1),
                               export_snapshots=False)
    assert res == [{"table": "T", "rows_read": 2}]
    assert sorted(r.identificador_unico for r in spark.read.parquet(f"{tmp}/prc_ds/T").collect()) == ["a", "d"]


def test_stream_documents_runs_etl_once(spark, tmp):
    from surveylake.streaming.landing import stream_documents
    import os
    os.makedirs(f"{tmp}/landing")
    for i in range(3):
        with open(f"{tmp}/landing/d{i}.xml", "w") as f:
            f.write(f"<n0:R><n0:S><H><ID>{i}</ID></H><B><V>a{i}</V></B></n0:S></n0:R>")
    layout = DocumentLayout("R", "S", ["H"], ["B"], [], T.StructType([
        T.StructField("H", T.StructType([T.StructField("ID", T.StringType())])),
        T.StructField("B", T.ArrayType(T.StructType([T.StructField("V", T.StringType())])))]))
    tables = {"B": SchemaDocument("T_BODY", [Field("ID"), Field("V")])}
    seen = []

    def handle(batch, batch_id):
        seen.append(flows.run_document_etl(batch, layout, tables, f"{tmp}/raw", f"{tmp}/exp", "MANUAL",
                                           dt.datetime(2024, 1, 1, 0, 0, batch_id)))

    n1 = stream_documents(spark, f"{tmp}/landing", f"{tmp}/ckpt", handle)
    n2 = stream_documents(spark, f"{tmp}/landing", f"{tmp}/ckpt", handle)
    assert (n1, n2) == (3, 0)
    assert sorted(r.V for r in spark.read.parquet(f"{tmp}/raw/T_BODY").collect()) == ["a0", "a1", "a2"]
    # one batch per file: batches add up, exports too, and the count is whole
    run = lambda: flows.stream_document_etl(spark, f"{tmp}/landing", f"{tmp}/ckpt2", layout, tables, f"{tmp}/raw2",
                                            f"{tmp}/exp2", "MANUAL", max_files_per_trigger=1)
    assert (run(), run()) == (3, 0)
    assert sorted(r.V for r in spark.read.parquet(f"{tmp}/raw2/T_BODY").collect()) == ["a0", "a1", "a2"]
    assert spark.read.option("recursiveFileLookup", True).option("header", True).csv(f"{tmp}/exp2/CSV").count() == 3
    assert spark.read.parquet(f"{tmp}/exp2/XML").count() == 3


def test_ingest_workbooks(spark, tmp):
    import os
    for name, body in {"BD_P": "identificador_unico,Mes_Encuesta\n1,2024-01-05\n2,2024-02-05\n",
                       "BD_P_SQL": "IDENTIFICADOR_UNICO,MES_ENCUESTA\n3,2024-03-01\n"}.items():
        os.makedirs(f"{tmp}/in/{name}")
        with open(f"{tmp}/in/{name}/x.csv", "w") as f:
            f.write(body)
    counts = flows.ingest_workbooks(spark, {n: f"{tmp}/in/{n}" for n in ("BD_P", "BD_P_SQL")},
                                    f"{tmp}/raw", f"{tmp}/exp", dt.datetime(2024, 4, 1))
    assert counts == {"BD_P": 2, "BD_P_SQL": 1}
    assert [r.Period for r in spark.read.parquet(f"{tmp}/raw/BD_P_SQL").collect()] == ["202403"]


def test_malformed_months_are_counted(spark, tmp):
    sheet = spark.createDataFrame([("a", "2024-01-05"), ("b", "enero"), ("c", ""), ("d", None), ("e", "2024-02")],
                                  "id string, Mes_Encuesta string")
    rejects = []
    assert flows.ingest_sheet(sheet, f"{tmp}/raw", f"{tmp}/exp", "S", dt.datetime(2024, 4, 1), rejects) == 5
    assert rejects == [2]
    cells = {r.id: r.Mes_Encuesta for r in spark.read.parquet(f"{tmp}/raw").collect()}
    assert cells["b"] == "enero" and cells["c"] == ""


def test_api_documents_window_and_cursor(spark, tmp):
    import base64
    import json
    import os
    import time as _time
    os.makedirs(f"{tmp}/landing")
    layout = DocumentLayout("R", "S", ["H"], [], [], T.StructType([
        T.StructField("H", T.StructType([T.StructField("ID", T.StringType())]))]))
    for name, ids, day in [("old", [1, 2], dt.datetime(2024, 1, 2, 12)), ("new", [3], dt.datetime(2024, 1, 20, 12))]:
        p = f"{tmp}/landing/{name}.json"
        with open(p, "w") as f:
            json.dump({"data": [{"interfaceValue": base64.b64encode(f"<R><S><H><ID>{i}</ID></H></S></R>".encode()).decode()}
                                for i in ids]}, f)
        ts = _time.mktime(day.timetuple())
        os.utime(p, (ts, ts))
    tables = {"H": SchemaDocument("T_HEAD", [Field("ID")])}
    defaults = {"fecinicio_query": "20240115", "fecfin_query": "20240125", "interfaz_query": "I"}
    counts = flows.run_api_documents(spark, f"{tmp}/landing", layout, tables, f"{tmp}/raw", f"{tmp}/exp",
                                     f"{tmp}/state", "API", defaults, today=dt.date(2024, 1, 26))
    assert counts == {"T_HEAD": 1, "__rejected": 0}                       # only the response in the window
    assert [r.ID for r in spark.read.parquet(f"{tmp}/raw/T_HEAD").collect()] == ["3"]
    assert load_watermark(spark, f"{tmp}/state", "API")["fecinicio_query"] == "20240125"
    # a file at the edge is in the window that starts there, and in no other
    edge = _time.mktime(dt.datetime(2024, 1, 25).timetuple())
    os.utime(f"{tmp}/landing/old.json", (edge, edge))
    ids = []
    for day in (26, 27):
        flows.run_api_documents(spark, f"{tmp}/landing", layout, tables, f"{tmp}/raw", f"{tmp}/exp", f"{tmp}/state", "API",
                                defaults, today=dt.date(2024, 1, day))
        ids.append(sorted(r.ID for r in spark.read.parquet(f"{tmp}/raw/T_HEAD").collect()))
    # RAW holds every load; a window without new files adds none
    assert ids == [["1", "2", "3"]] * 2


def test_lenient_load_counts_rejects(spark, tmp):
    spark.createDataFrame([("a", "2024-01-05", "x3"), ("b", "2024-13-01", "4")],
                          "identificador_unico string, Mes_Encuesta string, Score string").write.parquet(f"{tmp}/r")
    spark.createDataFrame([("c", "2024-02-01", "5", "202402")],
                          "IDENTIFICADOR_UNICO string, MES_ENCUESTA string, SCORE string, PERIODO_CARGA string") \
        .write.parquet(f"{tmp}/s")
    cfg = flows.TableConfig("T", f"{tmp}/r", f"{tmp}/s", RAW_DOC, SQL_DOC, f"{tmp}/p", f"{tmp}/h", f"{tmp}/e",
                            f"{tmp}/l", "D")
    res = flows.process_table(spark, cfg, "u", dt.datetime(2024, 3, 1), strict=False, export_snapshots=False)
    assert res["rows_read"] == 3 and res["rejected_cells"] == 2     # 'x3' and month 13
    prc = {r.identificador_unico: (r.Mes_Encuesta, r.Score) for r in spark.read.parquet(f"{tmp}/p").collect()}
    assert prc["a"] == (dt.date(2024, 1, 5), None) and prc["b"] == (None, 4)
