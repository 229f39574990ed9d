"""Driver queries for N1-N11 (+S6, P20-P24): decode XML documents.

One document per order is rendered as base64 XML, built map-side from the
order row alone (no grouping, so no group can grow with skew):

    <n0:Orders xmlns:n0="urn:orders">
      <n0:Order>                       one child; status F adds a second one
        <HEADER> ORDERKEY CUSTKEY STATUS TRANSMITDATE(-05:00 / +01:00 / none)
                 [INVOICEDATE unless status O] WORKORDERNUMBER SOURCEURL(http://...)
        <PRIORITY><LEVEL>                second header element, merged
        <LINE> x (priority - 1)        0, 1 or many body elements
           LINENO AMOUNT [WORKORDERNUMBER on line 2]
           <ITEM> x LINENO             1 or many sub-body elements: SEQ CODE
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleanse import encode_base64_text
from ..operators.nested import DocumentLayout, conform_to_schema, decode_documents
from ..schema import Field, SchemaDocument
from .catalog import register, table

S = T.StringType()
ORDER_LAYOUT = DocumentLayout(
    element_name="Orders", sub_element="Order",
    tables_header=["HEADER", "PRIORITY"], tables_body=["LINE"], tables_sub_body=["ITEM"],
    schema=T.StructType([
        T.StructField("HEADER", T.StructType([T.StructField(n, S) for n in
                      ["ORDERKEY", "CUSTKEY", "STATUS", "TRANSMITDATE", "INVOICEDATE",
                       "WORKORDERNUMBER", "SOURCEURL"]])),
        T.StructField("PRIORITY", T.StructType([T.StructField("LEVEL", S)])),
        T.StructField("LINE", T.ArrayType(T.StructType([
            T.StructField("LINENO", S), T.StructField("AMOUNT", S), T.StructField("WORKORDERNUMBER", S),
            T.StructField("ITEM", T.ArrayType(T.StructType([T.StructField("SEQ", S),
                                                            T.StructField("CODE", S)])))]))),
    ]),
    ignore_namespace=True)   # the schema uses no prefixed names

HEADER_SPEC = SchemaDocument("ORDER_HEADER", [Field(n) for n in [
    "DOCUMENTE_XML_ID", "UUID", "ORDERKEY", "CUSTKEY", "STATUS", "TRANSMITDATE", "TRANSMITDATE_CT",
    "INVOICEDATE", "INVOICEDATE_CT", "WORKORDERNUMBER", "WORKORDERNUMBER_HEADER", "SOURCEURL", "LEVEL"]])
BODY_SPEC = SchemaDocument("ORDER_LINE", [Field(n) for n in [
    "UUID", "UUID_HEAD", "DOCUMENTE_XML_ID", "ORDERKEY", "STATUS", "TRANSMITDATE", "LEVEL", "LINENO", "AMOUNT",
    "WORKORDERNUMBER", "WORKORDERNUMBER_HEADER", "ITEMSEQ", "ITEMCODE"]])
SUB_BODY_SPEC = SchemaDocument("ORDER_ITEM", [Field(n) for n in [
    "UUID", "UUID_BODY", "ORDERKEY", "LINENO", "SEQ", "CODE", "WORKORDERNUMBER", "ITEM"]])


def _el(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


MAX_LINES = 4


def order_children(o):
    """The ``<n0:Order>`` child element(s) of one order, as XML text."""
    ok = F.col("o_orderkey").cast("string")
    ts = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    st = F.col("o_orderstatus")
    offset = F.when(st == "F", F.lit("-05:00")).when(st == "P", F.lit("+01:00")).otherwise(F.lit(""))
    header = F.concat(
        F.lit("<HEADER>"), _el("ORDERKEY", ok), _el("CUSTKEY", F.col("o_custkey").cast("string")),
        _el("STATUS", st), _el("TRANSMITDATE", F.concat(ts, offset)),
        F.when(st != "O", _el("INVOICEDATE", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:00:00-05:00"))))
         .otherwise(F.lit("")),
        _el("WORKORDERNUMBER", F.concat(F.lit("WO-"), ok)),
        _el("SOURCEURL", F.concat(F.lit("http://orders.example/"), ok)), F.lit("</HEADER>"))
    prio = _el("PRIORITY", _el("LEVEL", F.col("o_orderpriority")))
    n_lines = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    amount = F.col("o_totalprice").cast("string")
    cust = F.col("o_custkey").cast("string")

    # priority '1'..'5' -> 0..4 lines; line i carries items 1..i.  Built from
    # fixed arrays + slice (codegen-friendly, no per-row lambda).
    items = [_el("ITEM", F.concat(_el("SEQ", F.lit(str(j))), _el("CODE", F.concat(cust, F.lit(f"-{j}")))))
             for j in range(1, MAX_LINES + 1)]

    def line(i):
        wo = _el("WORKORDERNUMBER", F.concat(F.lit("WO-"), ok, F.lit("-2"))) if i == 2 else F.lit("")
        return _el("LINE", F.concat(_el("LINENO", F.lit(str(i))), _el("AMOUNT", amount), wo, *items[:i]))

    lines = F.array_join(F.slice(F.array(*[line(i) for i in range(1, MAX_LINES + 1)]), 1,
                                 F.greatest(n_lines, F.lit(0))), "")
    rev = F.when(st == "F", F.concat(F.lit("<n0:Order><HEADER>"), _el("ORDERKEY", ok), _el("STATUS", F.lit("REV")),
                                     _el("TRANSMITDATE", ts), F.lit("</HEADER></n0:Order>"))).otherwise(F.lit(""))
    return F.concat(F.lit("<n0:Order>"), header, prio, lines, F.lit("</n0:Order>"), rev)


ROOT_OPEN = '<n0:Orders xmlns:n0="urn:orders">'
ROOT_CLOSE = "</n0:Orders>"


ORDERS_PER_TASK = 50_000   # about 50 MB of documents


def dealt(o, group: Column, name: str):
    """The rows of ``o`` dealt by ``group``, as column ``name``, before any text
    is rendered from them: grouping the texts by it needs no exchange of its own."""
    tasks = max(o.sparkSession.sparkContext.defaultParallelism, math.ceil(o.count() / ORDERS_PER_TASK))
    return o.withColumn(name, group).repartition(tasks, name)


def responses(spark, sf_dir, status):
    """(response, data): up to 64 documents of the orders of one status, as the
    ``data`` list of an API response.  An order counts as often as its key has rows
    of that status."""
    o = dealt(table(spark, sf_dir, "orders"), F.floor(F.col("o_orderkey") / 64), "response").where(F.col("o_orderkey").isNotNull())
    found = F.count_if(F.col("o_orderstatus") == status).over(Window.partitionBy("response", "o_orderkey"))
    own = o.withColumn("found", found.cast("int")).where("found > 0")
    own = own.select("*", F.explode(F.array_repeat(F.lit(0), F.col("found")))).drop("found", "col")
    return rendered(own, "response").groupBy("response").agg(
        F.collect_list(F.struct(F.col("payload").alias("interfaceValue"))).alias("data"))


def order_documents(spark, sf_dir):
    """(doc_key, payload, o_orderkey): one base64 XML document per order."""
    return rendered(spread(table(spark, sf_dir, "orders")))


def spread(o):
    """The rows of ``o``, dealt out where the splits of its files would leave one
    task half as much again as its share; else as they are read, as every
    use of the documents would shuffle them once more."""
    tasks = o.sparkSession.sparkContext.defaultParallelism
    most, rows = o.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    return o if rows and 2 * most * tasks <= 3 * rows else o.repartition(tasks)


def rendered(o, *more: str):
    """(doc_key, payload, o_orderkey, *more) of order rows."""
    xml = F.concat(F.lit(ROOT_OPEN), order_children(o), F.lit(ROOT_CLOSE))
    return o.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("doc_key"),
                    encode_base64_text(xml).alias("payload"), "o_orderkey", *more)


def _decoded(spark, sf_dir, tables=None):
    return decode_documents(order_documents(spark, sf_dir).drop("o_orderkey"), ORDER_LAYOUT, tables=tables)


_DOCS_SQL = """
h AS (
  SELECT 'order-' || o_orderkey AS doc_key, 0 AS sub_pos, CAST(o_orderkey AS VARCHAR) AS ORDERKEY,
    CAST(o_custkey AS VARCHAR) AS CUSTKEY, o_orderstatus AS STATUS,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
      CASE o_orderstatus WHEN 'F' THEN '-05:00' WHEN 'P' THEN '+01:00' ELSE '' END AS TRANSMITDATE_CT,
    CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00-05:00' END AS INVOICEDATE_CT,
    'WO-' || o_orderkey AS WORKORDERNUMBER, 'http://orders.example/' || o_orderkey AS SOURCEURL,
    o_orderpriority AS LEVEL, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS n_lines,
    CAST(o_totalprice AS VARCHAR) AS AMOUNT
  FROM orders
  UNION ALL
  SELECT 'order-' || o_orderkey, 1, CAST(o_orderkey AS VARCHAR), NULL, 'REV',
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), NULL, NULL, NULL, NULL, 0, NULL
  FROM orders WHERE o_orderstatus = 'F'),
hh AS (
  SELECT *, sha256(doc_key) AS DOCUMENTE_XML_ID, sha256(doc_key || '|' || sub_pos) AS HUUID,
    regexp_replace(TRANSMITDATE_CT, '-\\d{2}:\\d{2}$', '') AS TRANSMITDATE,
    regexp_replace(INVOICEDATE_CT, '-\\d{2}:\\d{2}$', '') AS INVOICEDATE
  FROM h),
b AS (
  SELECT hh.*, g.i AS line_no, sha256(doc_key || '|' || sub_pos || '|LINE|' || (g.i - 1)) AS BUUID,
    CASE WHEN g.i = 2 THEN 'WO-' || ORDERKEY || '-2' END AS BODY_WO
  FROM hh, generate_series(1, n_lines) AS g(i) WHERE n_lines > 0)"""


@register("decode_header", f"""
WITH {_DOCS_SQL}
SELECT DOCUMENTE_XML_ID, HUUID AS UUID, ORDERKEY, CUSTKEY, STATUS, TRANSMITDATE, TRANSMITDATE_CT,
       INVOICEDATE, INVOICEDATE_CT, WORKORDERNUMBER, WORKORDERNUMBER AS WORKORDERNUMBER_HEADER, SOURCEURL, LEVEL
FROM hh""")
def q_decode_header(spark, sf_dir):
    """N6 (+S6/P20/P21/P24/N1/N2/N10): header rows, one per child element."""
    return conform_to_schema(_decoded(spark, sf_dir, ["HEADER"])["HEADER"], HEADER_SPEC)


@register("decode_body", f"""
WITH {_DOCS_SQL}
SELECT BUUID AS UUID, HUUID AS UUID_HEAD, DOCUMENTE_XML_ID, ORDERKEY, STATUS, TRANSMITDATE, LEVEL,
       CAST(line_no AS VARCHAR) AS LINENO, AMOUNT,
       COALESCE(BODY_WO, WORKORDERNUMBER) AS WORKORDERNUMBER, WORKORDERNUMBER AS WORKORDERNUMBER_HEADER,
       '1' AS ITEMSEQ, CUSTKEY || '-1' AS ITEMCODE
FROM b""")
def q_decode_body(spark, sf_dir):
    """Body rows with header columns (header wins), the body's
    work order overriding the header's, first sub-body element flattened."""
    return conform_to_schema(_decoded(spark, sf_dir, ["LINE"])["LINE"], BODY_SPEC)


@register("decode_sub_body", f"""
WITH {_DOCS_SQL}
SELECT sha256(BUUID || '|ITEM|' || (s.j - 1)) AS UUID,
       BUUID AS UUID_BODY, ORDERKEY, CAST(line_no AS VARCHAR) AS LINENO,
       CAST(s.j AS VARCHAR) AS SEQ, CUSTKEY || '-' || s.j AS CODE,
       COALESCE(BODY_WO, WORKORDERNUMBER) AS WORKORDERNUMBER, '' AS ITEM
FROM b, generate_series(1, line_no) AS s(j)""")
def q_decode_sub_body(spark, sf_dir):
    """Sub-body rows with body columns (body wins), list column set to ''."""
    return conform_to_schema(_decoded(spark, sf_dir, ["ITEM"])["ITEM"], SUB_BODY_SPEC)
