"""Driver queries for whole loads and for what they leave behind.

Each writes with the flow or writer it is named for and reads the result
back: streaming and API document loads, rejects, decodes with shared ids,
incremental publishing, the state table, snapshots, history, logs, exports,
archives and schema documents.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleanse import encode_base64_text
from ..operators.audit import counts_by_source
from ..operators.nested import (DocumentLayout, conform_to_schema, decode_documents, decode_children, pruned,
                                read_xml_children, rejected_documents)
from ..schema import Field, SchemaDocument
from ..session import scratch_path
from ..sinks import writers as W
from ..sources.documents import BROADCAST_ROWS
from . import flows
from .catalog import register, table
from .q_documents import _DOCS_SQL, HEADER_SPEC, ORDER_LAYOUT, order_documents, responses
from .q_models import ORG_CODES, model_sources, oracle_for
from .q_sources import _ENVELOPE_SQL, _land_order_xml

TS = [dt.datetime(2024, 2, d, 8, 30) for d in (1, 2)]
_HEADER_COLUMNS = [f.name for f in HEADER_SPEC.fields if f.name not in ("DOCUMENTE_XML_ID", "UUID", "WORKORDERNUMBER_HEADER")]


# ---- document loads ---------------------------------------------------------

@register("stream_documents", f"""
WITH f AS (SELECT count(DISTINCT o_orderkey // 1024) AS n FROM orders)
SELECT h.*, TRUE AS own_id, CAST(ceil(n / ceil(n / 3)) AS INTEGER) AS batches FROM ({_ENVELOPE_SQL}) h, f""")
def q_stream_documents(spark, sf_dir):
    """K12 + C6 + K1: the landed XML files go through the document ETL in three
    micro-batches (RAW holds all of them, one partition each); a second run
    finds nothing new.  Every header row has an id of its own."""
    landing, base = _land_order_xml(spark, sf_dir, "gzip"), scratch_path(spark, "streamed")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.txt.gz").load(landing).select("path").count()
    for _ in range(2):
        flows.stream_document_etl(spark, landing, f"{base}/checkpoint", ORDER_LAYOUT, {"HEADER": HEADER_SPEC},
                                  f"{base}/raw", f"{base}/export", "MANUAL", glob="*.txt.gz",
                                  max_files_per_trigger=math.ceil(files / 3))
    raw = spark.read.parquet(f"{base}/raw/{HEADER_SPEC.name}")
    batches = raw.agg(F.countDistinct(W.LOAD_ID_PARTITION).cast("int").alias("batches"))
    return _with_own_id(raw).crossJoin(F.broadcast(batches)).select(*_HEADER_COLUMNS, "own_id", "batches")   # one row


def _with_own_id(rows):
    """``rows`` with ``own_id``: whether a row's UUID is that of no other row.

    Hashes of the ids are counted, then the ids whose hash comes twice or more;
    while these are few they are sent to every task and no row is shuffled."""
    spark = rows.sparkSession

    def written(df, name):
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df

    ids = rows.where(F.col("UUID").isNotNull()).select("UUID", F.xxhash64("UUID").alias("h"))
    hashes = written(ids.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-hashes")
    twice = ids.join(hashes, "h", "left_semi").groupBy("UUID").agg(F.count("*").alias("n")).where("n > 1")
    twice = written(twice.select("UUID", F.lit(False).alias("alone")), "repeated-ids")
    return (rows.where(F.col("UUID").isNotNull()).join(twice, "UUID", "left")
            .withColumn("own_id", F.coalesce("alone", F.lit(True))).drop("alone"))


def _set_modified(spark, path: str, when: dt.datetime) -> None:
    """Modification time of every file below ``path`` (a fixture for windows)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(root, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), int(when.replace(tzinfo=dt.timezone.utc).timestamp() * 1000), -1)


@register("api_incremental", f"""
SELECT *, TRUE AS own_id,
       CASE WHEN STATUS IN ('F', 'REV') THEN 1 WHEN STATUS = 'O' THEN 2 ELSE 3 END AS run FROM ({_ENVELOPE_SQL})""")
def q_api_incremental(spark, sf_dir):
    """C8 + C6 + C9: responses landed as JSON lines on three days, one of them
    stamped exactly at the edge of two windows, loaded by three daily runs; each
    window starts where the one before ended."""
    base, loaded = scratch_path(spark, "api"), []
    stamps = {"F": dt.datetime(2024, 1, 24, 12), "O": dt.datetime(2024, 1, 25), "P": dt.datetime(2024, 1, 26, 23, 59, 59)}
    for status, stamp in stamps.items():
        (responses(spark, sf_dir, status).select("data").write.mode("overwrite").option("compression", "gzip")
         .json(f"{base}/landing/{status}"))
        _set_modified(spark, f"{base}/landing/{status}", stamp)
    first = {"fecinicio_query": "20240101", "fecfin_query": "20240125", "interfaz_query": "ORDERS"}
    for run, day in enumerate((25, 26, 27), 1):
        flows.run_api_documents(spark, f"{base}/landing", ORDER_LAYOUT, {"HEADER": HEADER_SPEC}, f"{base}/raw{run}",
                                f"{base}/export", f"{base}/state", "ORDERS", first, dt.date(2024, 1, day), multi_line=False,
                                glob="*.json.gz")
        loaded.append(spark.read.parquet(f"{base}/raw{run}/{HEADER_SPEC.name}").withColumn("run", F.lit(run)))
    every = loaded[0].unionByName(loaded[1]).unionByName(loaded[2])
    return _with_own_id(every).select(*_HEADER_COLUMNS, "own_id", "run")


@register("rejects", """
SELECT 'order-' || o_orderkey AS doc_key, CASE o_orderstatus WHEN 'P' THEN 'base64' ELSE 'xml' END AS reason
FROM orders WHERE o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderkey % 3 < 2)""")
def q_rejects(spark, sf_dir):
    """Documents of status P are no base64, two thirds of status O are cut
    off or have another root; all of them are listed with the step that failed."""
    docs = order_documents(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                                               "o_orderkey")
    third = F.col("o_orderkey") % 3
    broken = (F.when(F.col("o_orderstatus") == "P", F.lit("%%%"))
              .when((F.col("o_orderstatus") == "O") & (third == 0), encode_base64_text(F.lit("<n0:Orders><n0:Order><HEADER>")))
              .when((F.col("o_orderstatus") == "O") & (third == 1), encode_base64_text(F.lit("<Other><Q>1</Q></Other>")))
              .otherwise(F.col("payload")))
    return rejected_documents(docs.select("doc_key", broken.alias("payload")), ORDER_LAYOUT).select("doc_key", "reason")


_S = T.StringType()
_ITEMS = T.ArrayType(T.StructType([T.StructField("SEQ", _S)]))
TWO_BODIES = DocumentLayout("Orders", "Order", ["HEADER"], ["SALE", "BACK"], ["ITEM"], T.StructType([
    T.StructField("HEADER", T.StructType([T.StructField("ORDERKEY", _S)])),
    T.StructField("SALE", T.ArrayType(T.StructType([T.StructField("NO", _S), T.StructField("ITEM", _ITEMS)]))),
    T.StructField("BACK", T.ArrayType(T.StructType([T.StructField("NO", _S), T.StructField("ITEM", _ITEMS)])))]))


@register("decode_two_bodies", """
WITH b AS (
  SELECT o_orderkey, kind, n, sha256(sha256('order-' || o_orderkey || '|0|' || kind || '|' || (n - 1)) || '|ITEM|0') AS UUID,
         sha256('order-' || o_orderkey || '|0|' || kind || '|' || (n - 1)) AS UUID_BODY
  FROM orders, (VALUES ('SALE', 1), ('SALE', 2), ('BACK', 1)) AS k(kind, n)
  WHERE kind = 'SALE' OR o_orderstatus = 'F')
SELECT CAST(o_orderkey AS VARCHAR) AS ORDERKEY, CAST(n AS VARCHAR) AS NO, kind || '-' || n AS SEQ, UUID, UUID_BODY,
       sha256('order-' || o_orderkey || '|0') AS UUID_HEAD FROM b""")
def q_decode_two_bodies(spark, sf_dir):
    """N7 + N8 + N10 + P21: two body tables with a sub-body element of one name
    (prefixes stripped from the text); the sub-body table has the rows of both,
    each linked to its own body row."""
    def body(kind, n):
        return F.lit(f"<n0:{kind}><NO>{n}</NO><n0:ITEM><SEQ>{kind}-{n}</SEQ></n0:ITEM></n0:{kind}>")
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    xml = F.concat(F.lit("<n0:Orders><n0:Order><HEADER><ORDERKEY>"), key, F.lit("</ORDERKEY></HEADER>"), body("SALE", 1),
                   body("SALE", 2), F.when(F.col("o_orderstatus") == "F", body("BACK", 1)).otherwise(F.lit("")),
                   F.lit("</n0:Order></n0:Orders>"))
    docs = o.select(F.concat(F.lit("order-"), key).alias("doc_key"), encode_base64_text(xml).alias("payload"))
    return decode_documents(docs, TWO_BODIES)["ITEM"].select("ORDERKEY", "NO", "SEQ", "UUID", "UUID_BODY", "UUID_HEAD")


@register("xml_row_links", """
SELECT CAST(o_orderkey AS VARCHAR) AS ORDERKEY, CAST(i AS VARCHAR) AS LINENO, TRUE AS own_id
FROM orders, generate_series(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) AS g(i)""")
def q_xml_row_links(spark, sf_dir):
    """S5 + N10: children read row by row keep unique ids: each body row finds
    exactly one header row, its own."""
    subs = read_xml_children(spark, _land_order_xml(spark, sf_dir), ORDER_LAYOUT, glob="*.txt")
    d = decode_children(subs, pruned(ORDER_LAYOUT, ["LINE"]))
    head = d["HEADER"].select(F.col("UUID").alias("UUID_HEAD"), F.col("ORDERKEY").alias("own"))
    return d["LINE"].select("UUID_HEAD", "ORDERKEY", "LINENO").join(head, "UUID_HEAD").select(
        "ORDERKEY", "LINENO", (F.col("own") == F.col("ORDERKEY")).alias("own_id"))


# ---- publishing and state ---------------------------------------------------

@register("publish_incremental", oracle_for("ReasonDissatisfaction", published=True))
def q_publish_incremental(spark, sf_dir):
    """The model published in two parts by month of the order, rows without
    a month in either, the second part twice: nothing is lost or doubled."""
    path = scratch_path(spark, "model")
    months = model_sources(spark, sf_dir, "ReasonDissatisfaction")
    def part(source, late):
        month = _month_of(source)
        return source.where((F.coalesce(month, F.lit("")) >= "1995-07") == late)
    for late in (False, True, True):
        flows.publish_models({k: part(v, late) for k, v in months.items()}, "ReasonDissatisfaction", path, ORG_CODES)
    return spark.read.parquet(path).withColumn("survey_month", F.col("survey_month").cast("date"))


def _month_of(source):
    """yyyy-MM of the column a source is published by."""
    by_name = {c.upper(): c for c in source.columns}
    if "PERIODO_CARGA" in by_name:
        p = F.col(by_name["PERIODO_CARGA"])
        return F.concat(F.substring(p, 1, 4), F.lit("-"), F.substring(p, 5, 2))
    return F.date_format(by_name["MES_ENCUESTA"], "yyyy-MM")


@register("watermark_state", """
SELECT r_name AS source, k AS key, r_name || '-' || k || '-2' AS value FROM region, (VALUES ('a'), ('b')) AS t(k)""")
def q_watermark_state(spark, sf_dir):
    """Two saves per source; the latest value of each key is the state."""
    from .incremental import read_state, save_watermark
    path = scratch_path(spark, "state")
    names = [r.r_name for r in table(spark, sf_dir, "region").select("r_name").collect()]   # five rows: sources are config
    for turn in (1, 2):
        for name in names:
            save_watermark(spark, path, name, {k: f"{name}-{k}-{turn}" for k in "ab"})
    return read_state(spark, path).select("source", "key", "value")


# ---- what loads leave behind ------------------------------------------------

@register("snapshots", """
SELECT 'current' AS snapshot, n_nationkey, n_name FROM nation
UNION ALL SELECT '20240201_083000', n_nationkey, n_name FROM nation
UNION ALL SELECT '20240202_083000', n_nationkey, n_name FROM nation""")
def q_snapshots(spark, sf_dir):
    """K2 + K3: current snapshot (overwritten) and stamped history snapshots."""
    base, n = scratch_path(spark, "snapshots"), table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = None
    for ts in TS:
        current = W.export_current(n, base, "NATION")
        one = spark.read.parquet(W.export_history(n, base, "NATION", ts)).withColumn("snapshot", F.lit(W.snapshot_stamp(ts)))
        out = one if out is None else out.unionByName(one)
    return out.unionByName(spark.read.parquet(current).withColumn("snapshot", F.lit("current")))


@register("history_table", """
SELECT c_custkey, c_name, 'etl_user' AS USUARIO, k AS load_key
FROM customer, (VALUES ('20240201_083000_000000'), ('20240202_083000_000000')) AS t(k)""")
def q_history_table(spark, sf_dir):
    """C3 + K4 + K5: history partitioned by load; a retried load replaces itself."""
    path, c = scratch_path(spark, "history"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for ts in (*TS, TS[1]):
        W.append_audited(c, path, "etl_user", ts)
    return spark.read.parquet(path).drop("FECHA_CARGA")


@register("typed_table", """
SELECT c_custkey, c_name, c_nationkey FROM customer""")
def q_typed_table(spark, sf_dir):
    """K4 + K14: a partitioned table created once, twice asked for, and loaded."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch_path(spark, "typed")
    name = "surveylake_typed_" + path.rsplit("-", 1)[-1]
    for _ in range(2):
        W.ensure_table(spark, name, c.schema, ["c_nationkey"], location=path)
    c.hint("rebalance", "c_nationkey").write.insertInto(name, overwrite=True)
    out = spark.read.schema(c.schema).parquet(path)
    spark.sql(f"DROP TABLE {name}")   # the files stay: the table is external
    return out


@register("load_log", """
SELECT 'SURVEY' AS DOMINIO, s AS TABLA, s || '_RawToProcessed' AS TIPO_DE_PROCESO, n AS CANT_REGISTROS, 'etl_user' AS USUARIO
FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)""")
def q_load_log(spark, sf_dir):
    """A4 + K8: record counts by source, logged one row per load."""
    path, o = scratch_path(spark, "log"), table(spark, sf_dir, "orders")
    counts = counts_by_source({s: o.where(F.col("o_orderstatus") == s) for s in "FOP"})
    for r in counts.collect():   # one row per source
        W.log_load(spark, path, "SURVEY", r.TABLA, f"{r.TABLA}_RawToProcessed", r.ROWS_COUNT, "etl_user", TS[0])
    return spark.read.parquet(path).drop("FECHA_CARGA")


@register("raw_cells", """
SELECT CAST(o_orderkey AS VARCHAR) AS k, 'document' AS via,
       CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 'nan' ELSE o_orderpriority END AS cell FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'sheet',
       CASE o_orderstatus WHEN 'P' THEN 'None' WHEN 'O' THEN 'nan' ELSE o_orderpriority END FROM orders""")
def q_raw_cells(spark, sf_dir):
    """P10 + K1: the text 'None' becomes NULL on the document path only; a sheet's
    cells are landed as they are."""
    base = scratch_path(spark, "raw")
    status = F.col("o_orderstatus")
    cell = F.when(status == "P", "None").when(status == "O", "nan").otherwise(F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), cell.alias("cell"))
    W.write_raw(rows, f"{base}/document")
    flows.ingest_sheet(rows, f"{base}/sheet", base, "SHEET", TS[0])
    return spark.read.parquet(f"{base}/document").withColumn("via", F.lit("document")).unionByName(
        spark.read.parquet(f"{base}/sheet").select("k", "cell").withColumn("via", F.lit("sheet")))


@register("exports", """
SELECT DISTINCT 'csv' AS kind, o_orderpriority AS a, o_orderstatus AS b FROM orders
UNION ALL SELECT 'json', o_orderpriority, o_orderstatus FROM orders""")
def q_exports(spark, sf_dir):
    """K9 + K10: de-duplicated CSV export and archived JSON lines, read back."""
    base = scratch_path(spark, "exports")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b"))
    csv = spark.read.option("header", True).csv(W.export_csv(rows, base, "ORDERS", TS[0]))
    json = spark.read.schema("a string, b string").json(W.archive_json(rows, base, "ORDERS", TS[0]))
    return csv.withColumn("kind", F.lit("csv")).unionByName(json.withColumn("kind", F.lit("json")))


@register("xml_archive", f"""
WITH {_DOCS_SQL}
SELECT BUUID AS UUID, HUUID AS UUID_HEAD, ORDERKEY, CAST(line_no AS VARCHAR) AS LINENO, AMOUNT FROM b""")
def q_xml_archive(spark, sf_dir):
    """K11 + N11: the decoded XML archived twice by one load counts once; the
    archived text decodes to the same body rows, ids included."""
    from ..functions.cleanse import decode_base64_text, strip_prefixes
    base, docs = scratch_path(spark, "archive"), order_documents(spark, sf_dir)
    xml = docs.select("doc_key", strip_prefixes(decode_base64_text("payload")).alias("xml"))
    for _ in range(2):
        path = W.archive_xml(xml, base, "Order", load=W.load_key(TS[0]))
    kept = spark.read.parquet(path).where(F.col("table_name") == "Order")
    keyed = kept.join(docs.select("doc_key", F.sha2("doc_key", 256).alias("id")), "id").select("doc_key", "data")
    body = decode_documents(keyed, ORDER_LAYOUT, payload="data", base64=False)["LINE"]
    return conform_to_schema(body, SchemaDocument("B", [Field(n) for n in ["UUID", "UUID_HEAD", "ORDERKEY", "LINENO",
                                                                           "AMOUNT"]]))


@register("schema_document", """
SELECT "table", count(*) AS n_fields, count(*) FILTER (kind = 'INT64') AS n_int
FROM (SELECT p_brand AS "table", CASE WHEN p_size <= 25 THEN 'INT64' ELSE 'STRING' END AS kind FROM part)
GROUP BY 1""")
def q_schema_document(spark, sf_dir):
    """S11 + S12: schema documents of 25 tables, one field per part, written to
    the shared folder as JSON and loaded from there."""
    from ..schema import load_schema
    base = scratch_path(spark, "schemas")
    fields = F.struct(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("name"), F.lit("false").alias("primary_key"),
                      F.lit("str").alias("raw_type"), F.when(F.col("p_size") <= 25, "INT64").otherwise("STRING").alias("master_type"))
    docs = (table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(fields).alias("fields"))
            .select(F.col("p_brand").alias("name"), F.translate("p_brand", "#", "_").alias("file"), "fields"))
    docs.write.partitionBy("file").json(base, mode="overwrite")
    rows = []
    for r in docs.select("file").collect():   # one row per table: configuration
        doc = load_schema(spark, f"{base}/none", fallback=f"{base}/file={r.file}")
        rows.append((doc.name, len(doc.fields), sum(f.master_type == "INT64" for f in doc.fields)))
    return spark.createDataFrame(rows, "`table` string, n_fields long, n_int long")


@register("config_order", """
SELECT TABLA, COLUMNAS, row_number() OVER (ORDER BY TABLA, COLUMNAS) AS place
FROM (SELECT DISTINCT source AS TABLA, lang AS COLUMNAS FROM documents)""")
def q_config_order(spark, sf_dir):
    """O1: config rows come in the order of their table name."""
    from pyspark.sql import Window

    from ..sources.config import load_config
    cfg = table(spark, sf_dir, "documents").select(F.lit("D").alias("DOMINIO"), F.col("source").alias("TABLA"),
                                                   F.col("lang").alias("COLUMNAS")).distinct()
    # monotonically_increasing_id follows the order of the rows
    rows = load_config(cfg, "D").select("TABLA", "COLUMNAS").withColumn("at", F.monotonically_increasing_id())
    first = rows.groupBy("TABLA").agg(F.min("at").alias("of_table"))
    w = Window.orderBy("of_table", "COLUMNAS")
    return rows.join(first, "TABLA").select("TABLA", "COLUMNAS", F.row_number().over(w).cast("long").alias("place"))


@register("workbook_sources", """
SELECT 'csv' AS kind, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation
UNION ALL SELECT 'parquet', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def q_workbook_sources(spark, sf_dir):
    """S2 + S3: one frame per exported worksheet, and a parquet snapshot."""
    from ..sources.sheets import ingest_all, read_parquet
    base = scratch_path(spark, "book")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    n.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
    n.write.mode("overwrite").parquet(f"{base}/parquet")
    frames = ingest_all(spark, {"csv": f"{base}/csv"}) | {"parquet": read_parquet(spark, f"{base}/parquet")}
    return frames["csv"].withColumn("kind", F.lit("csv")).unionByName(frames["parquet"].withColumn("kind", F.lit("parquet")))
