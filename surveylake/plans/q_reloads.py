"""Driver queries for loads that must lose and double nothing: documents broken
half-way, several landings and API runs into one RAW, late files, cut
responses, windows without new files, domain loops that crash, publishes that
change nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.cleanse import encode_base64_text
from ..operators.nested import decode_documents, rejected_rows
from ..schema import Field, SchemaDocument
from ..session import scratch_path
from . import flows
from .catalog import register, table
from .incremental import CURSOR_KEY, compact_state, load_watermark, save_watermark
from .q_documents import HEADER_SPEC, ORDER_LAYOUT, ROOT_CLOSE, ROOT_OPEN, dealt, order_children, responses
from .q_loads import _HEADER_COLUMNS, _set_modified
from .q_models import ORG_CODES, model_sources, oracle_for
from .q_sources import _ENVELOPE_SQL

_TABLES = {"HEADER": HEADER_SPEC}
_FIRST = {"fecinicio_query": "20240101", "fecfin_query": "20240125", "interfaz_query": "ORDERS"}


@register("partial_documents", """
SELECT sha256('order-' || o_orderkey) AS DOCUMENTE_XML_ID, CASE o_orderstatus WHEN 'O' THEN 'loaded' ELSE 'xml' END AS outcome
FROM orders""")
def q_partial_documents(spark, sf_dir):
    """N1 + N11: documents of status F break in a later child, those of status P go
    on after the root: none of their children counts and all are listed; a
    comment after the root (status O) breaks nothing."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    xml = F.concat(
        F.lit(ROOT_OPEN), order_children(o),
        F.when(status == "F", F.lit("<n0:Order><HEADER><ORDERKEY>a & b</ORDERKEY></HEADER></n0:Order>")).otherwise(F.lit("")),
        F.lit(ROOT_CLOSE),
        F.when(status == "P", F.lit("<n0:Orders><n0:Order/></n0:Orders>")).otherwise(F.lit("<!-- end -->\n")))
    docs = o.select(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("doc_key"),
                    encode_base64_text(xml).alias("payload"))
    decoded = decode_documents(docs, ORDER_LAYOUT, tables=["HEADER"])
    rejected = rejected_rows(decoded["__parsed"]).select(F.sha2("doc_key", 256).alias("DOCUMENTE_XML_ID"),
                                                         F.col("reason").alias("outcome"))
    return decoded["HEADER"].select("DOCUMENTE_XML_ID", F.lit("loaded").alias("outcome")).unionByName(rejected)


def _responses(spark, sf_dir, status):
    """Responses of up to 64 documents of one status, as JSON text."""
    return responses(spark, sf_dir, status).select(F.to_json(F.struct("data")).alias("value"))


def _land(spark, sf_dir, landing, status, stamp, value="value"):
    (_responses(spark, sf_dir, status).select(F.expr(value).alias("value")).write.mode("overwrite")
     .option("compression", "gzip").text(f"{landing}/{status}"))
    _set_modified(spark, f"{landing}/{status}", stamp)


def _api(spark, base, day, name="ORDERS"):
    return flows.run_api_documents(spark, f"{base}/landing", ORDER_LAYOUT, _TABLES, f"{base}/raw", f"{base}/export",
                                   f"{base}/state", name, _FIRST, dt.date(2024, 1, day), multi_line=False, glob="*.txt.gz")


def _raw(spark, base):
    return spark.read.parquet(f"{base}/raw/{HEADER_SPEC.name}")


@register("two_landings", f"""
SELECT h.*, CASE STATUS WHEN 'P' THEN 'api' ELSE 'stream' END AS via, TRUE AS own_load
FROM ({_ENVELOPE_SQL}) h""")
def q_two_landings(spark, sf_dir):
    """K1 + K12: two landing streams, each with its own checkpoint, and an API
    load into one RAW table, each run twice: every document is there once, and
    every landing has loads of its own."""
    base = scratch_path(spark, "landings")
    o = table(spark, sf_dir, "orders")
    for status in "FO":
        own = dealt(o.where(F.col("o_orderstatus") == status), F.floor(F.col("o_orderkey") / 1024), "file")
        xml = own.select("file", order_children(own).alias("child"))
        files = xml.groupBy("file").agg(F.array_join(F.collect_list("child"), "").alias("children"))
        files.select("file", F.concat(F.lit(ROOT_OPEN), "children", F.lit(ROOT_CLOSE)).alias("value")).write.partitionBy(
            "file").option("compression", "gzip").text(f"{base}/xml/{status}")
    _land(spark, sf_dir, f"{base}/landing", "P", dt.datetime(2024, 1, 24))
    for _ in range(2):
        for status in "FO":
            flows.stream_document_etl(spark, f"{base}/xml/{status}", f"{base}/checkpoint/{status}", ORDER_LAYOUT, _TABLES,
                                      f"{base}/raw", f"{base}/export", "MANUAL", glob="*.txt.gz")
        _api(spark, base, 25)
    raw = _raw(spark, base).withColumn("group", F.when(F.col("STATUS") == "REV", "F").otherwise(F.col("STATUS")))
    groups = raw.groupBy("load_id").agg(F.countDistinct("group").alias("groups"))   # a row per load
    via = F.when(F.col("load_id").startswith("ORDERS-"), "api").otherwise("stream")
    return raw.join(groups, "load_id").select(*_HEADER_COLUMNS, via.alias("via"), (F.col("groups") == 1).alias("own_load"))


@register("late_files", f"""
SELECT *, CASE WHEN STATUS IN ('F', 'REV') THEN 'ORDERS-1' ELSE 'ORDERS-2' END AS load_id
FROM ({_ENVELOPE_SQL}) WHERE STATUS <> 'P'""")
def q_late_files(spark, sf_dir):
    """C8 + S6: files that land after the run whose window they are stamped in
    come with the next run, once; those stamped before the first window began
    are not asked for."""
    base = scratch_path(spark, "late")
    _land(spark, sf_dir, f"{base}/landing", "F", dt.datetime(2024, 1, 24))
    _land(spark, sf_dir, f"{base}/landing", "P", dt.datetime(2023, 12, 31, 23, 59))
    _api(spark, base, 25)
    _land(spark, sf_dir, f"{base}/landing", "O", dt.datetime(2024, 1, 24, 23, 59))
    for day in (26, 27, 28):
        _api(spark, base, day)
    return _raw(spark, base).select(*_HEADER_COLUMNS, "load_id")


@register("broken_envelopes", f"""
SELECT ORDERKEY, STATUS, 'loaded' AS outcome FROM ({_ENVELOPE_SQL}) WHERE STATUS <> 'O'
UNION ALL SELECT NULL, NULL, 'envelope' FROM (SELECT DISTINCT o_orderkey // 64 FROM orders WHERE o_orderstatus = 'O')""")
def q_broken_envelopes(spark, sf_dir):
    """Responses that are cut off (status O) are listed among the rejects of
    their load, one row each; the other responses' documents are loaded."""
    base = scratch_path(spark, "envelopes")
    for status in "FP":
        _land(spark, sf_dir, f"{base}/landing", status, dt.datetime(2024, 1, 24))
    _land(spark, sf_dir, f"{base}/landing", "O", dt.datetime(2024, 1, 24), "substr(value, 1, length(value) - 10)")
    _api(spark, base, 25)
    rejects = spark.read.parquet(f"{base}/raw/ORDERS_REJECTS")
    none = F.lit(None).cast("string")
    return _raw(spark, base).select("ORDERKEY", "STATUS", F.lit("loaded").alias("outcome")).unionByName(
        rejects.select(none.alias("ORDERKEY"), none.alias("STATUS"), F.col("reason").alias("outcome")))


@register("empty_window", f"""
SELECT *, '2024-01-25T00:00:00' AS "cursor", 0 AS later_counts FROM ({_ENVELOPE_SQL}) WHERE STATUS IN ('F', 'REV')""")
def q_empty_window(spark, sf_dir):
    """C8 + C9: a window without new files leaves RAW and the cursor as they were."""
    base = scratch_path(spark, "empty")
    _land(spark, sf_dir, f"{base}/landing", "F", dt.datetime(2024, 1, 24))
    later = [len(_api(spark, base, day)) for day in (25, 26, 27)][1:]
    cursor = load_watermark(spark, f"{base}/state", "ORDERS")[CURSOR_KEY]
    return _raw(spark, base).select(*_HEADER_COLUMNS, F.lit(cursor).alias("cursor"), F.lit(sum(later)).alias("later_counts"))


@register("state_order", """
SELECT r_name AS source, k AS key, v AS value FROM region,
  (VALUES ('cursor', '2024-02-01T00:00:00'), ('fecinicio_query', '20240201'), ('note', 'second')) AS t(k, v)""")
def q_state_order(spark, sf_dir):
    """K13 + C9: a cursor that would move back is not taken, the other keys are;
    compacting the state table changes nothing."""
    path = scratch_path(spark, "ordered-state")
    for r in table(spark, sf_dir, "region").select("r_name").collect():   # five rows: sources are config
        for day, note in (("02-01", "first"), ("01-10", "second")):
            state = save_watermark(spark, path, r.r_name, {
                CURSOR_KEY: f"2024-{day}T00:00:00", "fecinicio_query": f"2024{day.replace('-', '')}", "note": note})
    compact_state(spark, path)
    return state.sparkSession.read.parquet(path).select("source", "key", "value")


_SHEET = SchemaDocument("SHEET", [Field("identificador_unico", "STRING", True, "X0"), Field("Mes_Encuesta", "DATE", True, "0001-01-01"),
                                  Field("Score", "INT64")])


@register("resumed_load", """
SELECT o_orderstatus AS "table", CAST(o_orderkey AS VARCHAR) AS identificador_unico, CAST(o_custkey AS BIGINT) AS Score,
       TRUE AS one_load FROM orders""")
def q_resumed_load(spark, sf_dir):
    """C3 + C5: a domain's loop over three tables breaks at the second one,
    whose RAW is not there yet; called again it goes on there with the load time
    it began with, and history is that of an unbroken run."""
    base = scratch_path(spark, "resumed")
    o = table(spark, sf_dir, "orders")
    raw = o.select("o_orderstatus", F.col("o_orderkey").cast("string").alias("identificador_unico"),
                   F.date_format("o_orderdate", "yyyy-MM-dd").alias("Mes_Encuesta"), F.col("o_custkey").cast("string").alias("Score"))
    document = spark.createDataFrame([(_SHEET.dumps(),)], "value string").coalesce(1)
    for status in "FOP":
        for name in (status, f"{status}_SQL"):
            document.write.text(f"{base}/schemas/{name}.input.schema")
        rows = raw.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
        rows.where(F.lit(False)).write.parquet(f"{base}/raw/{status}_SQL")
        if status != "O":
            rows.write.parquet(f"{base}/raw/{status}")
    config = spark.createDataFrame([("SURVEY", f"T_{s};{s};{s}_SQL", "raw", "processed") for s in "FOP"],
                                   "DOMINIO string, TABLA string, DATASET_STAGE string, DATASET_DESTINO string")

    def load():
        return flows.process_domain(spark, config, "SURVEY", base, f"{base}/schemas", "etl_user")

    try:
        load()
        raise RuntimeError("the second table's RAW is missing, yet it was loaded")
    except flows.AnalysisException:
        raw.where(F.col("o_orderstatus") == "O").drop("o_orderstatus").write.parquet(f"{base}/raw/O")
    load()
    out = None
    for status in "FOP":
        history = spark.read.parquet(f"{base}/processed/T_{status}_HISTORY")
        one = history.agg(F.countDistinct("load_key").alias("loads"))
        part = history.crossJoin(F.broadcast(one)).select(   # one row
            F.lit(status).alias("table"), "identificador_unico", "Score", (F.col("loads") == 1).alias("one_load"))
        out = part if out is None else out.unionByName(part)
    return out


@register("publish_unchanged", f"""
WITH p AS (SELECT count(*) AS n FROM (
  SELECT DISTINCT "Domain", origin, survey_month FROM ({oracle_for("ReasonDissatisfaction", published=True)}) q))
SELECT 1 AS publish, n AS written FROM p UNION ALL SELECT 2, 0 UNION ALL SELECT 3, 1""")
def q_publish_unchanged(spark, sf_dir):
    """Partitions written by a first publish, by the same one again, and by
    one in which a single row of one month of one source is there twice."""
    path = scratch_path(spark, "model")
    sources = model_sources(spark, sf_dir, "ReasonDissatisfaction")
    written = [flows.publish_models(sources, "ReasonDissatisfaction", path, ORG_CODES) for _ in range(2)]
    key = sorted(sources)[0]
    changed = sources | {key: sources[key].unionByName(sources[key].orderBy(*sources[key].columns).limit(1))}
    written.append(flows.publish_models(changed, "ReasonDissatisfaction", path, ORG_CODES))
    return spark.createDataFrame([(i, n) for i, n in enumerate(written, 1)], "publish int, written long")


@register("split_sheet", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, replace(text, chr(13), ' ') AS text, source FROM documents""")
def q_split_sheet(spark, sf_dir):
    """S1 + S2: a sheet whose cells span lines and hold quotes, read in as many
    tasks as its files have splits: the rows are those that were exported."""
    from ..sources.sheets import read_sheet_export
    path = scratch_path(spark, "split-sheet")
    cells = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "lang", F.translate("text", "\r", " ").alias("text"), "source")
    (cells.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))   # files this small would be one split each
    try:
        # splits are laid out when the frame is read, and its records are written while it is
        return read_sheet_export(spark, path, split=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
