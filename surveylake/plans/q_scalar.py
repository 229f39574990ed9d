"""Driver queries for P1-P26: casts and cleansing on text derived from tables.

RAW tables are all text, so each query first renders driver columns as the
text a sheet export would hold (including blank, whitespace-only, sentinel
and malformed cells, chosen by a value of the row -- no row is dropped), then
applies the operator.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import apply_schema, cast_bool, cast_date, cast_datetime, cast_float, cast_int
from ..functions.cleanse import (composite_key, day_text, nan, null_if_text, nz, period, recode,
                                 strip_offset, to_numeric, upper_columns)
from ..schema import Field, SchemaDocument
from .catalog import register, table

_K = r'"k": (\d+)'

# Shape selector: which text form of ``ts`` an event carries (9 forms; the
# last is not an accepted DATETIME shape).
_DT_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm'Z'", "yyyy-MM-dd HH:mm'Z'",
               "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss",
               "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy/MM/dd HH:mm"]
_DT_FORMATS_SQL = ["%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%MZ", "%Y-%m-%d %H:%MZ", "%Y-%m-%dT%H:%M",
                   "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ",
                   "%Y-%m-%dT%H:%M:%S.%gZ", "%Y/%m/%d %H:%M"]
_BOOL_TEXT = ["true", "FALSE", "", "True", "yes"]


def raw_events(spark, sf_dir):
    """events rendered as an all-text RAW sheet."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    k = F.regexp_extract("props", _K, 1)
    shape = F.pmod(F.col("event_id"), F.lit(9))
    dt_text = F.lit(None).cast("string")
    for i in reversed(range(len(_DT_FORMATS))):
        dt_text = F.when(shape == i, F.date_format("ts", _DT_FORMATS[i])).otherwise(dt_text)
    bsel = F.pmod(F.col("event_id"), F.lit(5))
    bool_text = F.lit(None).cast("string")
    for i in reversed(range(len(_BOOL_TEXT))):
        bool_text = F.when(bsel == i, F.lit(_BOOL_TEXT[i])).otherwise(bool_text)
    return e.select(
        "event_id",
        F.when(et == "signup", F.lit("")).when(et == "error", F.lit("   "))
         .otherwise(F.col("user_id").cast("string")).alias("int_text"),
        F.when(et == "signup", F.lit("")).when(et == "error", F.concat(F.lit("k"), k))
         .otherwise(F.concat(k, F.lit("."), F.col("user_id").cast("string"))).alias("float_text"),
        F.when(et == "signup", F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date_text"),
        F.when(et == "error", F.date_format("ts", "yyyy/MM/dd")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date_text_bad"),
        dt_text.alias("dt_text"),
        bool_text.alias("bool_text"))


_RAW_EVENTS_SQL = f"""
re AS (
  SELECT event_id,
    CASE WHEN event_type = 'signup' THEN '' WHEN event_type = 'error' THEN '   '
         ELSE CAST(user_id AS VARCHAR) END AS int_text,
    CASE WHEN event_type = 'signup' THEN '' WHEN event_type = 'error' THEN 'k' || regexp_extract(props, '{_K}', 1)
         ELSE regexp_extract(props, '{_K}', 1) || '.' || CAST(user_id AS VARCHAR) END AS float_text,
    CASE WHEN event_type = 'signup' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date_text,
    CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%Y-%m-%d') END AS date_text_bad,
    CASE {' '.join(f"WHEN event_id % 9 = {i} THEN strftime(ts, '{f}')" for i, f in enumerate(_DT_FORMATS_SQL))} END AS dt_text,
    CASE {' '.join(f"WHEN event_id % 5 = {i} THEN '{b}'" for i, b in enumerate(_BOOL_TEXT))} END AS bool_text
  FROM events)"""


@register("cast_int", f"""
WITH {_RAW_EVENTS_SQL}
SELECT event_id, int_text, CASE WHEN trim(int_text) = '' THEN NULL ELSE CAST(int_text AS BIGINT) END AS as_int,
       CASE WHEN trim(float_text) = '' THEN NULL
            WHEN regexp_full_match(trim(float_text), '[+-]?[0-9]+') THEN TRY_CAST(float_text AS BIGINT) END AS as_int_lenient
FROM re""")
def q_cast_int(spark, sf_dir):
    """blank/whitespace -> NULL, digits -> BIGINT (strict); lenient gives
    NULL for junk and for decimals."""
    r = raw_events(spark, sf_dir)
    return r.select("event_id", "int_text", cast_int("int_text").alias("as_int"),
                    cast_int("float_text", strict=False).alias("as_int_lenient"))


@register("cast_float", f"""
WITH {_RAW_EVENTS_SQL}
SELECT event_id, float_text,
       CASE WHEN trim(float_text) = '' THEN NULL ELSE TRY_CAST(float_text AS DOUBLE) END AS as_float
FROM re""")
def q_cast_float(spark, sf_dir):
    """Safe cast; blank and junk -> NULL."""
    r = raw_events(spark, sf_dir)
    return r.select("event_id", "float_text", cast_float("float_text").alias("as_float"))


@register("cast_date", f"""
WITH {_RAW_EVENTS_SQL}
SELECT event_id, date_text,
       CASE WHEN trim(date_text) = '' THEN NULL ELSE CAST(strptime(date_text, '%Y-%m-%d') AS DATE) END AS as_date,
       CAST(try_strptime(date_text_bad, '%Y-%m-%d') AS DATE) AS as_date_lenient
FROM re""")
def q_cast_date(spark, sf_dir):
    """Strict yyyy-MM-dd; lenient mode gives NULL for another layout."""
    r = raw_events(spark, sf_dir)
    return r.select("event_id", "date_text", cast_date("date_text").alias("as_date"),
                    cast_date("date_text_bad", strict=False).alias("as_date_lenient"))


_SHAPES_SQL = [
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "%Y-%m-%dT%H:%M:%S"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z", "%Y-%m-%dT%H:%MZ"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}Z", "%Y-%m-%d %H:%MZ"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}", "%Y-%m-%dT%H:%M"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", "%Y-%m-%d %H:%M"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z", "%Y-%m-%dT%H:%M:%SZ"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z", "%Y-%m-%dT%H:%M:%S.%gZ"),
]


@register("cast_datetime", f"""
WITH {_RAW_EVENTS_SQL}
SELECT event_id, dt_text,
  CASE {' '.join(f"WHEN regexp_full_match(dt_text, '{p}') THEN strptime(dt_text, '{f}')" for p, f in _SHAPES_SQL)}
  ELSE NULL END AS as_datetime
FROM re""")
def q_cast_datetime(spark, sf_dir):
    """Eight accepted shapes (trailing Z dropped), anything else NULL."""
    r = raw_events(spark, sf_dir)
    return r.select("event_id", "dt_text", cast_datetime("dt_text").alias("as_datetime"))


@register("cast_bool", f"""
WITH {_RAW_EVENTS_SQL}
SELECT event_id, bool_text,
  CASE WHEN bool_text = 'yes' THEN NULL WHEN trim(bool_text) = '' THEN NULL
       ELSE CAST(bool_text AS BOOLEAN) END AS as_bool,
  CASE WHEN trim(bool_text) = '' THEN NULL WHEN lower(bool_text) = 'true' THEN TRUE
       WHEN lower(bool_text) = 'false' THEN FALSE END AS as_bool_lenient
FROM re""")
def q_cast_bool(spark, sf_dir):
    """P5: true/false in any case; 'yes' is rejected (strict raises, so the
    strict column is applied where the text is valid; lenient gives NULL)."""
    r = raw_events(spark, sf_dir)
    b = F.col("bool_text")
    return r.select("event_id", "bool_text",
                    F.when(b == "yes", F.lit(None).cast("boolean")).otherwise(cast_bool(b)).alias("as_bool"),
                    cast_bool(b, strict=False).alias("as_bool_lenient"))


EVENTS_SCHEMA = SchemaDocument("EVENTS_RAW", [
    Field("EVENT_ID", "INT64", primary_key=True, default="0"),
    Field("Int_Text", "INT64"),
    Field("float_text", "FLOAT64"),
    Field("DATE_TEXT", "DATE"),
    Field("dt_text", "DATETIME"),
    Field("bool_text", "STRING"),
    Field("missing_col", "FLOAT64"),
])


@register("apply_schema", f"""
WITH {_RAW_EVENTS_SQL}
SELECT CAST(event_id AS BIGINT) AS EVENT_ID,
  CASE WHEN trim(int_text) = '' THEN NULL ELSE CAST(int_text AS BIGINT) END AS Int_Text,
  CASE WHEN trim(float_text) = '' THEN NULL ELSE TRY_CAST(float_text AS DOUBLE) END AS float_text,
  CASE WHEN trim(date_text) = '' THEN NULL ELSE CAST(strptime(date_text, '%Y-%m-%d') AS DATE) END AS DATE_TEXT,
  CASE {' '.join(f"WHEN regexp_full_match(dt_text, '{p}') THEN strptime(dt_text, '{f}')" for p, f in _SHAPES_SQL)}
  ELSE NULL END AS dt_text,
  bool_text, CAST(NULL AS DOUBLE) AS missing_col
FROM re""")
def q_apply_schema(spark, sf_dir):
    """A schema document casts a RAW frame by name (case-insensitive);
    a field the frame lacks becomes a typed NULL."""
    r = raw_events(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string"))
    return apply_schema(r, EVENTS_SCHEMA)


@register("null_if_text", """
WITH t AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'None' WHEN 'MACHINERY' THEN 'nan'
                                   ELSE c_mktsegment END AS seg_text FROM customer)
SELECT c_custkey, seg_text, NULLIF(seg_text, 'None') AS seg_nz, NULLIF(seg_text, 'nan') AS seg_nan,
       NULLIF(NULLIF(seg_text, 'None'), 'nan') AS seg_clean FROM t""")
def q_null_if_text(spark, sf_dir):
    """The texts 'None' and 'nan' mean no value."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    t = c.select("c_custkey", F.when(seg == "BUILDING", F.lit("None")).when(seg == "MACHINERY", F.lit("nan"))
                 .otherwise(seg).alias("seg_text"))
    return t.select("c_custkey", "seg_text", nz("seg_text").alias("seg_nz"), nan("seg_text").alias("seg_nan"),
                    null_if_text("seg_text", "None", "nan").alias("seg_clean"))


ORG_CODES = {"F": "2000", "O": "3000"}


@register("recode", """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN '2000' WHEN o_orderstatus = 'O' THEN '3000' ELSE NULL END AS company_id,
       'PRIME' AS domain
FROM orders""")
def q_recode(spark, sf_dir):
    """Configured code per organisation text (unknown -> NULL) and a
    constant domain column."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus", recode("o_orderstatus", ORG_CODES).alias("company_id"),
                    F.lit("PRIME").alias("domain"))


@register("to_numeric", """
WITH t AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'None'
                                  ELSE CAST(c_acctbal AS VARCHAR) END AS acctbal_text FROM customer)
SELECT c_custkey, TRY_CAST(acctbal_text AS DECIMAL(38, 9)) AS loyalty_index FROM t""")
def q_to_numeric(spark, sf_dir):
    """NUMERIC = decimal(38,9) from text; sentinel text -> NULL."""
    c = table(spark, sf_dir, "customer")
    txt = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("None")).otherwise(F.col("c_acctbal").cast("string"))
    return c.select("c_custkey", to_numeric(txt).alias("loyalty_index"))


@register("composite_key", """
SELECT o_orderkey,
  CAST(month(o_orderdate) AS VARCHAR) || '-' ||
  CAST(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS VARCHAR) || '-' ||
  CAST(o_orderkey AS VARCHAR) AS survey_id
FROM orders""")
def q_composite_key(spark, sf_dir):
    """Month-customer-serial key; NULL when a part is NULL."""
    o = table(spark, sf_dir, "orders")
    cust = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey"))
    return o.select("o_orderkey", composite_key("o_orderdate", cust, "o_orderkey").alias("survey_id"))


@register("day_text", """
SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS period_day,
       substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 10) AS period_from_date
FROM orders""")
def q_day_text(spark, sf_dir):
    """First ten characters of the stringified survey month."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", day_text("o_orderdate").alias("period_day"),
                    day_text(F.to_date("o_orderdate")).alias("period_from_date"))


@register("add_period", """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'bad'
                                   ELSE strftime(o_orderdate, '%Y-%m-%d') END AS mes_encuesta FROM orders)
SELECT o_orderkey, mes_encuesta,
       CASE WHEN len(string_split(mes_encuesta, '-')) >= 3
            THEN string_split(mes_encuesta, '-')[1] || string_split(mes_encuesta, '-')[2] END AS Period
FROM t""")
def q_add_period(spark, sf_dir):
    """yyyyMM period from the month text; malformed -> NULL."""
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit("bad"))
                 .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("mes_encuesta"))
    return t.select("o_orderkey", "mes_encuesta", period("mes_encuesta").alias("Period"))


@register("strip_offset", """
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
             CASE o_orderstatus WHEN 'F' THEN '-05:00' WHEN 'O' THEN '+02:00' ELSE '' END AS transmit_ct
           FROM orders)
SELECT o_orderkey, transmit_ct, regexp_replace(transmit_ct, '-\\d{2}:\\d{2}$', '') AS transmit
FROM t""")
def q_strip_offset(spark, sf_dir):
    """P20: trailing negative UTC offset removed; original kept in *_CT."""
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.col("o_orderstatus") == "F", F.lit("-05:00"))
         .when(F.col("o_orderstatus") == "O", F.lit("+02:00")).otherwise(F.lit(""))).alias("transmit_ct"))
    return t.select("o_orderkey", "transmit_ct", strip_offset("transmit_ct").alias("transmit"))


CUSTOMER_SPEC = SchemaDocument("CUSTOMER", [
    Field("C_CUSTKEY", "STRING", primary_key=True, default="X0"),
    Field("C_NAME", "STRING"),
    Field("C_PHONE", "STRING"),
    Field("C_ACCTBAL", "STRING"),
    Field("C_MKTSEGMENT", "STRING", primary_key=True, default="X0"),
])


@register("conform_to_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS C_CUSTKEY, c_name AS C_NAME, CAST(NULL AS VARCHAR) AS C_PHONE,
       CAST(c_acctbal AS VARCHAR) AS C_ACCTBAL,
       COALESCE(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE c_mktsegment END, 'X0') AS C_MKTSEGMENT
FROM customer""")
def q_conform_to_schema(spark, sf_dir):
    """Upper-cased record projected to a field list: missing
    field -> NULL, non-text -> text, NULL primary key -> its default."""
    from ..operators.nested import conform_to_schema
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    rec = c.select("c_custkey", "c_name", "c_acctbal",
                   F.when(seg == "AUTOMOBILE", F.lit(None).cast("string")).otherwise(seg).alias("c_mktsegment"))
    return conform_to_schema(upper_columns(rec), CUSTOMER_SPEC)
