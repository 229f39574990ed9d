"""Physical-plan properties the design relies on (regression guards)."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_model_publish_has_no_shuffle_and_pruned_scans(spark):
    plan = plan_of(E.queries()["build_survey"](spark, SF))
    assert "Exchange" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_comment" not in s and "o_custkey" not in s for s in schemas)


def test_header_only_decode_does_not_parse_bodies(spark):
    header_plan = plan_of(E.queries()["decode_header"](spark, SF))
    body_plan = plan_of(E.queries()["decode_body"](spark, SF))
    assert "StructField(LINE" not in header_plan
    assert "StructField(LINE" in body_plan
    assert header_plan.count("from_xml") == 1


def test_month_replace_broadcasts_months_not_rows(spark):
    plan = plan_of(E.queries()["month_replace"](spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
