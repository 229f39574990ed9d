"""Driver queries for M1-M24 / U3 / C7: publish the common data model.

The survey sources are not shipped, so each (domain, origin) PROCESSED
source is rendered from ``orders``: every order row lands in exactly one
source (domain by priority, origin by date), and every column a mapping
reads gets a typed value derived from the row:

* DATE sources: order date + column index days;
* INT sources: (order key + column index) mod 11;
* NUMERIC sources: total price;
* PERIODO_CARGA: ``yyyyMM`` of the order date;
* ORGANIZACION: an organisation text by order status ('None' when pending);
* other text: 'None' (pending), 'nan' (open) or ``v<index>-<order key>``.

The oracle renders the same rule and the mapping tables as SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.cleanse import ntz_lit
from . import models as M
from .catalog import register, table

ORG_CODES = {"ORG-PRIMARY": "2000"}
DOMAIN_PRIORITIES = {"PRIME": ["1-URGENT"], "RENTAL": ["2-HIGH"], "PARTS": ["3-MEDIUM"],
                     "SERVICE": ["4-NOT SPECIFIED", "5-LOW"]}
SQL_FROM = dt.datetime(1998, 1, 1)


def _roles(mapping):
    """source column -> (role, index) by its first use in the mapping."""
    roles: dict[str, tuple[str, str, int]] = {}

    def put(name, role):
        key = name.lower()
        if key not in roles:
            roles[key] = (name, role, len(roles))

    for tgt, s in mapping:
        if isinstance(s, str):
            if tgt in M.DATE_TARGETS:
                put(s, "date")
            elif tgt in M.INT_TARGETS:
                put(s, "int")
            elif s.upper() == "PERIODO_CARGA":
                put(s, "period")
            elif s.upper() == M.ORG_COLUMN:
                put(s, "org")
            else:
                put(s, "text")
        elif s.kind in ("nz", "nan"):
            put(s.name, "org" if s.name.upper() == M.ORG_COLUMN else "text")
        elif s.kind == "num":
            put(s.name, "num")
        elif s.kind == "org":
            put(M.ORG_COLUMN, "org")
        elif s.kind == "day10":
            put(M.MONTH_COLUMN, "date")
        elif s.kind == "key":
            put(M.MONTH_COLUMN, "date")
            put(M.KEY_CUSTOMER_COLUMN, "text")
            put(M.KEY_SERIAL_COLUMN, "text")
    return list(roles.values())


def _spark_value(role, idx):
    """The synthesis rule as Spark SQL text (one JVM call per column)."""
    if role == "date":
        return f"date_add(to_date(o_orderdate), {idx})"
    if role == "int":
        return f"CAST(pmod(o_orderkey + {idx}, 11) AS BIGINT)"
    if role == "num":
        return "o_totalprice"
    if role == "period":
        return "date_format(o_orderdate, 'yyyyMM')"
    if role == "org":
        return "CASE o_orderstatus WHEN 'F' THEN 'ORG-PRIMARY' WHEN 'O' THEN 'ORG-OTHER' ELSE 'None' END"
    return (f"CASE o_orderstatus WHEN 'P' THEN 'None' WHEN 'O' THEN 'nan' "
            f"ELSE concat('v{idx}-', CAST(o_orderkey AS STRING)) END")


def _sql_value(role, idx):
    if role == "date":
        return f"CAST(o_orderdate AS DATE) + {idx}"
    if role == "int":
        return f"CAST((o_orderkey + {idx}) % 11 AS BIGINT)"
    if role == "num":
        return "o_totalprice"
    if role == "period":
        return "strftime(o_orderdate, '%Y%m')"
    if role == "org":
        return "CASE o_orderstatus WHEN 'F' THEN 'ORG-PRIMARY' WHEN 'O' THEN 'ORG-OTHER' ELSE 'None' END"
    return (f"CASE o_orderstatus WHEN 'P' THEN 'None' WHEN 'O' THEN 'nan' "
            f"ELSE 'v{idx}-' || CAST(o_orderkey AS VARCHAR) END")


def _where_spark(domain, origin):
    pr = F.col("o_orderpriority").isin(*DOMAIN_PRIORITIES[domain])
    d = F.col("o_orderdate") >= ntz_lit(SQL_FROM)
    return pr & (d if origin == "sql" else ~d)


def _where_sql(domain, origin):
    prs = ", ".join(f"'{p}'" for p in DOMAIN_PRIORITIES[domain])
    op = ">=" if origin == "sql" else "<"
    return f"o_orderpriority IN ({prs}) AND o_orderdate {op} TIMESTAMP '1998-01-01 00:00:00'"


def model_sources(spark, sf_dir, target):
    o = table(spark, sf_dir, "orders")
    out = {}
    for domain in M.DOMAINS:
        for origin in M.ORIGINS:
            roles = _roles(M.MAPPINGS[target](domain, origin))
            out[(domain, origin)] = o.where(_where_spark(domain, origin)).selectExpr(
                *[f"{_spark_value(role, idx)} AS `{name}`" for name, role, idx in roles])
    return out


_SQL_TYPES = {"DateType()": "DATE", "LongType()": "BIGINT", "DecimalType(38,9)": "DECIMAL(38,9)",
              "StringType()": "VARCHAR"}


def _sql_type(col):
    return _SQL_TYPES[repr(M.target_type(col))]


def _q(name):
    return f'"{name}"'


def _sql_expr(src):
    if isinstance(src, str):
        return _q(src)
    if src.kind == "nz":
        return f"NULLIF({_q(src.name)}, 'None')"
    if src.kind == "nan":
        return f"NULLIF({_q(src.name)}, 'nan')"
    if src.kind == "num":
        return f"TRY_CAST({_q(src.name)} AS DECIMAL(38,9))"
    if src.kind == "lit":
        return f"'{src.name}'"
    if src.kind == "org":
        cases = " ".join(f"WHEN {_q(M.ORG_COLUMN)} = '{k}' THEN '{v}'" for k, v in ORG_CODES.items())
        return f"CASE {cases} ELSE NULL END"
    if src.kind == "day10":
        return f"substr(CAST({_q(M.MONTH_COLUMN)} AS VARCHAR), 1, 10)"
    if src.kind == "key":
        return (f"CAST(month({_q(M.MONTH_COLUMN)}) AS VARCHAR) || '-' || CAST({_q(M.KEY_CUSTOMER_COLUMN)} AS VARCHAR)"
                f" || '-' || CAST({_q(M.KEY_SERIAL_COLUMN)} AS VARCHAR)")
    raise ValueError(src)


def oracle_for(target, published=False):
    """SQL for the mapped target; ``published`` adds the columns the publish
    step partitions by (origin, survey month)."""
    parts = []
    for domain in M.DOMAINS:
        for origin in M.ORIGINS:
            mapping = M.MAPPINGS[target](domain, origin)
            roles = _roles(mapping)
            src = ", ".join(f"{_sql_value(role, idx)} AS {_q(name)}" for name, role, idx in roles)
            exprs = dict((t, _sql_expr(s)) for t, s in mapping)
            sel = ", ".join(f"CAST({exprs.get(c, 'NULL')} AS {_sql_type(c)}) AS {_q(c)}"
                            for c in M.TARGET_COLUMNS[target])
            if published:
                sel += f", '{origin}' AS origin"
            parts.append(f"SELECT {sel} FROM (SELECT {src} FROM orders WHERE {_where_sql(domain, origin)}) s")
    body = "\nUNION ALL\n".join(parts)
    if not published:
        return body
    if "SurveyDate" in M.TARGET_COLUMNS[target]:
        month = '"SurveyDate"'
    else:
        month = ("COALESCE(CAST(try_strptime(substr(\"Period\", 1, 10), '%Y-%m-%d') AS DATE), "
                 "CAST(try_strptime(\"Period\", '%Y%m') AS DATE))")
    return f"SELECT *, CAST(date_trunc('month', {month}) AS DATE) AS survey_month FROM ({body}) p"


@register("build_survey", oracle_for("Survey"))
def q_build_survey(spark, sf_dir):
    """M1-M8 + U3: eight sources (4 domains x sheet/SQL export) -> Survey."""
    return M.build_model(model_sources(spark, sf_dir, "Survey"), "Survey", ORG_CODES)


@register("build_reason", oracle_for("ReasonDissatisfaction"))
def q_build_reason(spark, sf_dir):
    """Eight sources -> ReasonDissatisfaction (10 columns)."""
    return M.build_model(model_sources(spark, sf_dir, "ReasonDissatisfaction"),
                         "ReasonDissatisfaction", ORG_CODES)


@register("build_reason_v2", oracle_for("ReasonDissatisfactionV2"))
def q_build_reason_v2(spark, sf_dir):
    """Eight sources -> ReasonDissatisfactionV2 (103 columns, no cleansing)."""
    return M.build_model(model_sources(spark, sf_dir, "ReasonDissatisfactionV2"),
                         "ReasonDissatisfactionV2", ORG_CODES)


@register("publish_reason", oracle_for("ReasonDissatisfaction", published=True))
def q_publish_reason(spark, sf_dir):
    """The ReasonDissatisfaction model published twice into a table
    partitioned by (Domain, origin, survey month) with dynamic partition
    overwrite; the second run replaces, so every row is there once."""
    from ..session import scratch_path
    from .flows import publish_models
    path = scratch_path(spark, "model")
    for _ in range(2):
        publish_models(model_sources(spark, sf_dir, "ReasonDissatisfaction"), "ReasonDissatisfaction",
                       path, ORG_CODES)
    return spark.read.parquet(path).withColumn("survey_month", F.col("survey_month").cast("date"))
