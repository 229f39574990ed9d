"""Driver queries for J1-J5, K6, K7, C4, U1-U3, A1-A3."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.cleanse import ntz_lit
from ..operators.audit import dedup, total_rows
from ..operators.merge import (changed_pairs, changed_rows, drop_months, keep_months, month_replace,
                               update_months, upsert_by_key)
from ..operators.union import union_sources
from .catalog import register, table


def _ts(y, m, d):
    return ntz_lit(dt.datetime(y, m, d))


def _survey_orders(spark, sf_dir):
    """Orders as survey rows: month = order date; low-priority pending orders
    carry a NULL month (the 'blank month' case, built from the data)."""
    o = table(spark, sf_dir, "orders")
    null_month = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    F.when(null_month, F.lit(None).cast("date"))
                    .otherwise(F.to_date("o_orderdate")).alias("survey_month"))


_SURVEY_ORDERS_SQL = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS survey_month
  FROM orders)"""


@register("month_replace", f"""
WITH {_SURVEY_ORDERS_SQL},
d AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1997-01-01'),
r AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1997-07-01')
SELECT 'dest' AS origin, o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM d
WHERE NOT EXISTS (SELECT 1 FROM r WHERE date_trunc('month', r.survey_month) = date_trunc('month', d.survey_month))
  AND NOT EXISTS (SELECT 1 FROM s WHERE date_trunc('month', s.survey_month) = date_trunc('month', d.survey_month))
UNION ALL
SELECT 'raw', o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM r
WHERE NOT EXISTS (SELECT 1 FROM s WHERE date_trunc('month', s.survey_month) = date_trunc('month', r.survey_month))
UNION ALL
SELECT 'sql', o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM s
""")
def q_month_replace(spark, sf_dir):
    """C4: PROCESSED (orders before 1997) has its months replaced by a sheet
    source (1996-07..1998) then an SQL-export source (1997-07..); where both
    sources hold a month only the second survives."""
    o = _survey_orders(spark, sf_dir)
    d = o.where(F.col("o_orderdate") < _ts(1997, 1, 1))
    r = o.where((F.col("o_orderdate") >= _ts(1996, 7, 1)) & (F.col("o_orderdate") < _ts(1999, 1, 1)))
    s = o.where(F.col("o_orderdate") >= _ts(1997, 7, 1))
    out = month_replace(d, [(r, "survey_month"), (s, "survey_month")], "survey_month",
                        tag="origin", tags=["dest", "raw", "sql"])
    return out.drop("o_orderdate")


def _ship_window(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.where((F.col("l_shipdate") >= _ts(1997, 3, 1)) & (F.col("l_shipdate") < _ts(1998, 7, 1)))


_SHIP_EXISTS = """EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_shipdate >= TIMESTAMP '1997-03-01' AND l.l_shipdate < TIMESTAMP '1998-07-01'
    AND date_trunc('month', l.l_shipdate) = date_trunc('month', o.o_orderdate))"""


@register("keep_months", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders o WHERE {_SHIP_EXISTS}""")
def q_keep_months(spark, sf_dir):
    """Orders whose month has shipments in the window (LeftSemi)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return keep_months(o, "o_orderdate", _ship_window(spark, sf_dir), "l_shipdate")


@register("drop_months", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders o WHERE NOT {_SHIP_EXISTS}""")
def q_drop_months(spark, sf_dir):
    """Orders left after deleting every month that has shipments in the window."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return drop_months(o, "o_orderdate", _ship_window(spark, sf_dir), "l_shipdate")


@register("update_months", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN {_SHIP_EXISTS} THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       o_orderdate
FROM orders o""")
def q_update_months(spark, sf_dir):
    """Conditional update of the months present in the source."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return update_months(o, "o_orderdate", _ship_window(spark, sf_dir),
                         {"o_orderstatus": F.lit("U")}, "l_shipdate")


def _altered_customer(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        "c_custkey",
        F.when(seg == "MACHINERY", F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(seg == "BUILDING", F.col("c_acctbal") + 1.0).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment")


_ALTERED_CUSTOMER_SQL = """
n AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS c_name,
         CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment
  FROM customer)"""

_CUSTOMER_TYPES = {"c_name": "STRING", "c_nationkey": "INT64", "c_acctbal": "FLOAT64",
                   "c_mktsegment": "STRING"}


@register("changed_rows", f"""
WITH {_ALTERED_CUSTOMER_SQL}
SELECT n.* FROM n JOIN customer a ON a.c_custkey = n.c_custkey
WHERE COALESCE(a.c_name, '') <> COALESCE(n.c_name, '')
   OR COALESCE(a.c_nationkey, 0) <> COALESCE(n.c_nationkey, 0)
   OR COALESCE(a.c_acctbal, 0) <> COALESCE(n.c_acctbal, 0)
   OR COALESCE(a.c_mktsegment, '') <> COALESCE(n.c_mktsegment, '')""")
def q_changed_rows(spark, sf_dir):
    """J4+J5 sentinel mode: a NULL that replaces the type's sentinel (0) is no change."""
    return changed_rows(table(spark, sf_dir, "customer"), _altered_customer(spark, sf_dir),
                        ["c_custkey"], _CUSTOMER_TYPES, mode="sentinel")


@register("changed_rows_null_safe", f"""
WITH {_ALTERED_CUSTOMER_SQL}
SELECT n.* FROM n JOIN customer a ON a.c_custkey = n.c_custkey
WHERE a.c_name IS DISTINCT FROM n.c_name OR a.c_nationkey IS DISTINCT FROM n.c_nationkey
   OR a.c_acctbal IS DISTINCT FROM n.c_acctbal OR a.c_mktsegment IS DISTINCT FROM n.c_mktsegment""")
def q_changed_rows_null_safe(spark, sf_dir):
    """J4+J5 null-safe mode: every NULL <-> value switch is a change."""
    return changed_rows(table(spark, sf_dir, "customer"), _altered_customer(spark, sf_dir),
                        ["c_custkey"], _CUSTOMER_TYPES, mode="null_safe")


@register("changed_pairs", f"""
WITH {_ALTERED_CUSTOMER_SQL}
SELECT n.c_custkey, a.c_name AS old_c_name, a.c_nationkey AS old_c_nationkey, a.c_acctbal AS old_c_acctbal,
       a.c_mktsegment AS old_c_mktsegment, n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment
FROM n JOIN customer a ON a.c_custkey = n.c_custkey
WHERE COALESCE(a.c_name, '') <> COALESCE(n.c_name, '')
   OR COALESCE(a.c_nationkey, 0) <> COALESCE(n.c_nationkey, 0)
   OR COALESCE(a.c_acctbal, 0) <> COALESCE(n.c_acctbal, 0)
   OR COALESCE(a.c_mktsegment, '') <> COALESCE(n.c_mktsegment, '')""")
def q_changed_pairs(spark, sf_dir):
    """J4 + J5: key condition and change predicate over two aliases; old and new values."""
    return changed_pairs(table(spark, sf_dir, "customer"), _altered_customer(spark, sf_dir), ["c_custkey"], _CUSTOMER_TYPES)


@register("upsert_by_key", """
WITH new AS (
  SELECT n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation WHERE n_regionkey IN (0, 1)
  UNION ALL
  SELECT r_regionkey + 100 AS n_nationkey, r_name AS n_name, r_regionkey FROM region)
SELECT n_nationkey, n_name, n_regionkey FROM nation o
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.n_nationkey = o.n_nationkey)
UNION ALL SELECT * FROM new""")
def q_upsert_by_key(spark, sf_dir):
    """K7: nation rows of two regions re-keyed in, region rows added as new keys."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    new = (nation.where(F.col("n_regionkey").isin(0, 1))
           .select("n_nationkey", F.lower("n_name").alias("n_name"), "n_regionkey")
           .unionByName(region.select((F.col("r_regionkey") + 100).alias("n_nationkey"),
                                      F.col("r_name").alias("n_name"), "r_regionkey")
                        .withColumnRenamed("r_regionkey", "n_regionkey")))
    return upsert_by_key(nation.select("n_nationkey", "n_name", "n_regionkey"), new, ["n_nationkey"])


@register("union_sources", """
SELECT c_custkey AS KEY, c_name AS NAME, c_nationkey AS NATIONKEY, c_acctbal AS ACCTBAL,
       c_mktsegment AS MKTSEGMENT, 'customer' AS origin FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def q_union_sources(spark, sf_dir):
    """Two sources whose columns differ in case, order and presence."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("KEY"), F.col("c_name").alias("NAME"),
        F.col("c_nationkey").alias("NATIONKEY"), F.col("c_acctbal").alias("ACCTBAL"),
        F.col("c_mktsegment").alias("MKTSEGMENT"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("Name"),
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nationkey"))
    return union_sources([c, s], tag="origin", tags=["customer", "supplier"])


@register("total_rows", """
SELECT CAST(SUM(n) AS BIGINT) AS ROWS_COUNT FROM (
  SELECT COUNT(*) AS n FROM documents UNION ALL SELECT COUNT(*) FROM events) t""")
def q_total_rows(spark, sf_dir):
    """SUM over a UNION ALL of per-table counts (log row count)."""
    return total_rows([table(spark, sf_dir, "documents"), table(spark, sf_dir, "events")])


@register("dedup", """
SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events""")
def q_dedup(spark, sf_dir):
    """A3: full-row distinct of the exported projection (one value is very hot)."""
    e = table(spark, sf_dir, "events")
    return dedup(e.select("event_type", "user_id", F.to_date("ts").alias("day")))


@register("replace_months_table", f"""
WITH {_SURVEY_ORDERS_SQL},
d AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1997-01-01'),
r AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '1997-07-01'),
t AS (
  SELECT 'dest' AS origin, o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM d
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE date_trunc('month', r.survey_month) = date_trunc('month', d.survey_month))
    AND NOT EXISTS (SELECT 1 FROM s WHERE date_trunc('month', s.survey_month) = date_trunc('month', d.survey_month))
  UNION ALL
  SELECT 'raw', o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM r
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE date_trunc('month', s.survey_month) = date_trunc('month', r.survey_month))
  UNION ALL
  SELECT 'sql', o_orderkey, o_custkey, o_orderstatus, o_totalprice, survey_month FROM s)
SELECT *, CAST(date_trunc('month', survey_month) AS DATE) AS month_key FROM t""")
def q_replace_months_table(spark, sf_dir):
    """K6/C4 through the storage writer: the PROCESSED table is written
    month-partitioned, then the two sources replace their months with a
    dynamic partition overwrite (untouched months are not rewritten) and the
    NULL-month rows are kept in partitions of their load; the table is read back."""
    from ..session import scratch_path
    from ..sinks.writers import replace_months
    src = _survey_orders(spark, sf_dir)
    d = src.where(F.col("o_orderdate") < _ts(1997, 1, 1)).drop("o_orderdate").withColumn("origin", F.lit("dest"))
    r = (src.where((F.col("o_orderdate") >= _ts(1996, 7, 1)) & (F.col("o_orderdate") < _ts(1999, 1, 1)))
         .drop("o_orderdate").withColumn("origin", F.lit("raw")))
    s = src.where(F.col("o_orderdate") >= _ts(1997, 7, 1)).drop("o_orderdate").withColumn("origin", F.lit("sql"))
    path = scratch_path(spark, "processed")
    replace_months(path, [(d, "survey_month")])
    replace_months(path, [(r, "survey_month"), (s, "survey_month")])
    out = spark.read.parquet(path).drop("load_key")
    return out.withColumn("month_key", F.col("month_key").cast("date"))


@register("upsert_orders", """
WITH new AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey + 1000000000, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P')
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM new""")
def q_upsert_orders(spark, sf_dir):
    """K7: finished orders re-priced, pending ones added under new keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.col("o_orderstatus")
    new = o.where(status == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1.0).unionByName(
        o.where(status == "P").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000))
    return upsert_by_key(o, new, ["o_orderkey"])


@register("changed_versions", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem n
WHERE EXISTS (SELECT 1 FROM lineitem a WHERE a.l_orderkey = n.l_orderkey
              AND (a.l_quantity IS DISTINCT FROM n.l_quantity OR a.l_returnflag IS DISTINCT FROM n.l_returnflag))""")
def q_changed_versions(spark, sf_dir):
    """J4+J5: every key holds several old versions; a new row that differs from
    any of them is changed."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return changed_rows(lines, lines, ["l_orderkey"], {"l_quantity": "FLOAT64", "l_returnflag": "STRING"}, mode="null_safe")
