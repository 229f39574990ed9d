"""Driver queries for sources and run control: S10, S11, N4/N5, C8, P25/K5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.cleanse import with_audit
from ..operators.nested import explode_prefixed
from ..schema import dictionary_to_fields
from .catalog import register, table
from .incremental import incremental_window, request_window


@register("explode_prefixed", """
WITH c AS (SELECT conv_id, turn // 4 AS chunk, turn, role, text FROM conversations),
g AS (SELECT conv_id, chunk, bool_or(role = 'user') AS has_user,
             count(*) FILTER (WHERE role <> 'system') AS n FROM c GROUP BY conv_id, chunk)
SELECT c.conv_id, c.chunk, c.turn AS msgs_turn, c.role AS msgs_role, c.text AS msgs_text
FROM c JOIN g ON c.conv_id = g.conv_id AND c.chunk = g.chunk
WHERE g.has_user AND c.role <> 'system'
UNION ALL
SELECT conv_id, chunk, NULL, NULL, NULL FROM g WHERE NOT has_user""")
def q_explode_prefixed(spark, sf_dir):
    """Conversation turns packed into lists of at most four messages
    (a bounded group, whatever the conversation length), system turns
    filtered out; a chunk without a user turn has a NULL list (row kept), an
    emptied list drops its row; exploding gives ``msgs.<field>`` columns
    (renamed ``msgs_<field>`` here so a checker can select them by name)."""
    c = table(spark, sf_dir, "conversations").withColumn("chunk", F.floor(F.col("turn") / 4).cast("bigint"))
    msg = F.struct("turn", "role", "text")
    g = (c.groupBy("conv_id", "chunk")
         .agg(F.max((F.col("role") == "user").cast("int")).alias("has_user"),
              F.collect_list(F.when(F.col("role") != "system", msg)).alias("msgs")))
    g = g.select("conv_id", "chunk", F.when(F.col("has_user") == 1, F.array_sort("msgs")).alias("msgs"))
    out = explode_prefixed(g, "msgs")
    return out.toDF(*[c.replace(".", "_") for c in out.columns])


@register("dictionary_to_fields", """
WITH d AS (
  SELECT CASE WHEN p_size <= 12 THEN 'STRING' WHEN p_size <= 25 THEN 'INT64'
              WHEN p_size <= 37 THEN 'FLOAT64' ELSE 'date' END AS DATA_TYPE,
         p_name AS BD_ALPHA,
         CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN NULL ELSE p_brand END AS BD_BETA,
         CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type || '_' || p_partkey END AS BD_GAMMA
  FROM part),
l AS (
  UNPIVOT d ON BD_ALPHA, BD_BETA, BD_GAMMA INTO NAME "table" VALUE "column")
SELECT "table", "column", upper(trim(DATA_TYPE)) AS master_type,
       lower("column") IN ('identificador_unico', 'mes_encuesta') AS primary_key,
       'str' AS raw_type,
       CASE upper(trim(DATA_TYPE)) WHEN 'INT64' THEN '0' WHEN 'FLOAT64' THEN '0.0'
            WHEN 'DATE' THEN '0001-01-01' ELSE 'X0' END AS "default"
FROM l WHERE "column" IS NOT NULL AND trim("column") <> ''""")
def q_dictionary_to_fields(spark, sf_dir):
    """A wide schema dictionary (one column per table, DATA_TYPE per
    row, blank = absent) unpivoted into one field row per (table, column)."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    d = p.select(
        F.when(size <= 12, "STRING").when(size <= 25, "INT64").when(size <= 37, "FLOAT64")
         .otherwise("date").alias("DATA_TYPE"),
        F.col("p_name").alias("BD_ALPHA"),
        F.when(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("BD_BETA"),
        F.when(F.col("p_type") == "SMALL", F.lit(""))
         .otherwise(F.concat("p_type", F.lit("_"), F.col("p_partkey").cast("string"))).alias("BD_GAMMA"))
    return dictionary_to_fields(d).drop("ordinal")


@register("load_config", """
SELECT source AS TABLA, 'raw_' || lang AS DATASET_STAGE, 'processed_' || lang AS DATASET_DESTINO,
       CAST(doc_id AS VARCHAR) || ';' || CAST(n_chars AS VARCHAR) AS COLUMNAS
FROM documents WHERE lang = 'es' ORDER BY TABLA""")
def q_load_config(spark, sf_dir):
    """Config rows of one domain, ordered by table name."""
    from ..sources.config import load_config
    d = table(spark, sf_dir, "documents")
    cfg = d.select(F.col("lang").alias("DOMINIO"), F.col("source").alias("TABLA"),
                   F.concat(F.lit("raw_"), "lang").alias("DATASET_STAGE"),
                   F.concat(F.lit("processed_"), "lang").alias("DATASET_DESTINO"),
                   F.concat(F.col("doc_id").cast("string"), F.lit(";"), F.col("n_chars").cast("string")).alias("COLUMNAS"))
    return load_config(cfg, "es").select("TABLA", "DATASET_STAGE", "DATASET_DESTINO", "COLUMNAS")


TODAY = dt.date(2024, 1, 20)


@register("incremental_window", """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-19 00:00:00' AND ts < TIMESTAMP '2024-01-27 00:00:00'
UNION ALL
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2023-12-21 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' AND event_type = 'purchase'""")
def q_incremental_window(spark, sf_dir):
    """Configured window whose start is today -> starts yesterday; an
    unconfigured window -> the last 30 days (here for purchases)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    w1 = request_window({"fecinicio_query": "20240120", "fecfin_query": "20240127",
                         "interfaz_query": "EVENTS"}, today=TODAY)
    w2 = request_window({}, today=TODAY)
    return incremental_window(e, "ts", w1).unionByName(
        incremental_window(e.where(F.col("event_type") == "purchase"), "ts", w2))


LOAD_TS = dt.datetime(2024, 2, 1, 8, 30, 0)


@register("with_audit", """
SELECT c_custkey, c_name, 'etl_user' AS USUARIO, TIMESTAMP '2024-02-01 08:30:00' AS FECHA_CARGA
FROM customer""")
def q_with_audit(spark, sf_dir):
    """P25/K5: user and one fixed load time per run added to every row."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_audit(c, "etl_user", LOAD_TS).withColumn("FECHA_CARGA", F.col("FECHA_CARGA").cast("timestamp_ntz"))


@register("consume_landing", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def q_consume_landing(spark, sf_dir):
    """The landed events file consumed once by a file stream
    (availableNow) into a parquet sink; the sink holds every row once."""
    from ..session import scratch_path
    from ..streaming.landing import consume_landing
    src = table(spark, sf_dir, "events")
    base = scratch_path(spark, "landing")
    consume_landing(spark, sf_dir, src.schema, f"{base}/sink", f"{base}/checkpoint",
                    glob="events.parquet")
    return spark.read.parquet(f"{base}/sink")


_ENVELOPE_HEADER = ["ORDERKEY", "CUSTKEY", "STATUS", "TRANSMITDATE", "TRANSMITDATE_CT", "INVOICEDATE",
                    "INVOICEDATE_CT", "WORKORDERNUMBER", "SOURCEURL", "LEVEL"]


_ENVELOPE_SQL = """
WITH h AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ORDERKEY, CAST(o_custkey AS VARCHAR) AS CUSTKEY, o_orderstatus AS STATUS,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
      CASE o_orderstatus WHEN 'F' THEN '-05:00' WHEN 'P' THEN '+01:00' ELSE '' END AS TRANSMITDATE_CT,
    CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00-05:00' END AS INVOICEDATE_CT,
    'WO-' || o_orderkey AS WORKORDERNUMBER, 'http://orders.example/' || o_orderkey AS SOURCEURL,
    o_orderpriority AS LEVEL
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), NULL, 'REV', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
    NULL, NULL, NULL, NULL
  FROM orders WHERE o_orderstatus = 'F')
SELECT ORDERKEY, CUSTKEY, STATUS, regexp_replace(TRANSMITDATE_CT, '-\\d{2}:\\d{2}$', '') AS TRANSMITDATE,
  TRANSMITDATE_CT, regexp_replace(INVOICEDATE_CT, '-\\d{2}:\\d{2}$', '') AS INVOICEDATE, INVOICEDATE_CT,
  WORKORDERNUMBER, SOURCEURL, LEVEL
FROM h"""


@register("read_envelope", _ENVELOPE_SQL)
def q_read_envelope(spark, sf_dir):
    """S6 + N11: API responses landed as JSON lines ``{"data": [{"interfaceValue":
    <base64 XML>}, ...]}`` (64 documents per response), read back, exploded
    and decoded into header rows."""
    from ..operators.nested import conform_to_schema, decode_documents
    from ..schema import Field, SchemaDocument
    from ..session import scratch_path
    from ..sources.documents import read_envelope
    from .q_documents import ORDER_LAYOUT, dealt, rendered
    docs = rendered(dealt(table(spark, sf_dir, "orders"), F.floor(F.col("o_orderkey") / 64), "response"), "response")
    env = docs.groupBy("response").agg(F.collect_list(F.struct(F.col("payload").alias("interfaceValue"))).alias("data"))
    path = scratch_path(spark, "envelopes")
    env.select("data").write.mode("overwrite").option("compression", "gzip").json(path)
    decoded = decode_documents(read_envelope(spark, path, "*.json.gz", multi_line=False), ORDER_LAYOUT, tables=["HEADER"])
    return conform_to_schema(decoded["HEADER"], SchemaDocument("H", [Field(n) for n in _ENVELOPE_HEADER]))


@register("read_sheet_export", """
SELECT CAST(o_orderkey AS VARCHAR) AS identificador_unico,
  CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Mes_Encuesta,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS Estado,
  CAST(o_totalprice AS VARCHAR) AS Monto,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE strftime(o_orderdate, '%Y%m') END AS Period
FROM orders""")
def q_read_sheet_export(spark, sf_dir):
    """S1 + P18 + P17 (C1 before the writes): a worksheet exported as CSV
    (header row, blank cells, mixed-case month column) read back as text and
    given its yyyyMM Period."""
    from ..functions.cleanse import add_period
    from ..schema import find_column
    from ..session import scratch_path
    from ..sources.sheets import read_sheet_export
    o = table(spark, sf_dir, "orders")
    sheet = o.select(
        F.col("o_orderkey").cast("string").alias("identificador_unico"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Mes_Encuesta"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("Estado"),
        F.col("o_totalprice").cast("string").alias("Monto"))
    path = scratch_path(spark, "sheet")
    sheet.write.mode("overwrite").option("header", True).csv(path)
    df = read_sheet_export(spark, path)
    return add_period(df, find_column(df.columns))


ORDERS_PER_FILE = 1024


def _land_order_xml(spark, sf_dir, compression="none"):
    """Land XML files (one document of up to 1,024 orders per file, a bounded
    group) under the shared scratch folder; returns the folder."""
    from ..session import scratch_path
    from .q_documents import ROOT_CLOSE, ROOT_OPEN, dealt, order_children
    o = dealt(table(spark, sf_dir, "orders"), F.floor(F.col("o_orderkey") / ORDERS_PER_FILE), "file")
    files = (o.select("file", "o_orderkey", order_children(o).alias("child"))
             .groupBy("file")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "child"))),
                                           lambda x: x["child"]), "").alias("children"))
             .select("file", F.concat(F.lit(ROOT_OPEN), "children", F.lit(ROOT_CLOSE)).alias("value")))
    path = scratch_path(spark, "xml")
    files.write.mode("overwrite").partitionBy("file").option("compression", compression).text(path)
    return path


def _header_spec():
    from ..schema import Field, SchemaDocument
    return SchemaDocument("H", [Field(n) for n in _ENVELOPE_HEADER])


@register("read_xml_folder", _ENVELOPE_SQL)
def q_read_xml_folder(spark, sf_dir):
    """S4/S5 + N2 + N11: XML files landed in a folder tree, each file one
    document whose root holds up to 1,024 orders (many children per
    document); read whole-text by glob, decoded into header rows."""
    from ..operators.nested import conform_to_schema, decode_documents
    from ..sources.documents import read_xml_folder
    from .q_documents import ORDER_LAYOUT
    docs = read_xml_folder(spark, _land_order_xml(spark, sf_dir), glob="*.txt")
    decoded = decode_documents(docs, ORDER_LAYOUT, base64=False, tables=["HEADER"])
    return conform_to_schema(decoded["HEADER"], _header_spec())


@register("read_xml_rows", _ENVELOPE_SQL)
def q_read_xml_rows(spark, sf_dir):
    """S5 (large files): the same landed XML read with Spark's XML reader,
    one row per ``Order`` child (rowTag; files are split, namespaces
    ignored), decoded into header rows."""
    from ..operators.nested import conform_to_schema, decode_children, pruned, read_xml_children
    from .q_documents import ORDER_LAYOUT
    layout = pruned(ORDER_LAYOUT, ["HEADER"])
    subs = read_xml_children(spark, _land_order_xml(spark, sf_dir), layout, glob="*.txt")
    return conform_to_schema(decode_children(subs, layout)["HEADER"], _header_spec())
