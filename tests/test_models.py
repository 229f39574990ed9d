"""Model mappings on hand-built PROCESSED rows with hand-computed results."""

import datetime as dt
from decimal import Decimal

from surveylake.plans import models as M

ORG = {"ORG-A": "2000"}


def test_reason_prime_sheet_and_sql(spark):
    sheet = spark.createDataFrame(
        [("R1", "ORG-A", "C9", dt.date(2024, 3, 1), "Slow", "More staff", "None"),
         ("None", "None", "None", dt.date(2024, 4, 1), "None", "x", "y")],
        "Reporte_Asignacion string, Organizacion string, Codigo_Cliente string, Mes_encuesta date, "
        "Motivos_Insatisfaccion string, Oportunidad_Mejora string, Sugerencia string")
    sql = spark.createDataFrame([("R2", "ORG-B", "C7", "202405", "Price", "Cheaper", "Less")],
                                "REPORTE_DE_ASIGNACION string, ORGANIZACION string, CODIGO_DE_CLIENTE string, "
                                "PERIODO_CARGA string, MOTIVOS_DE_INSATISFACCION string, OPORTUNIDAD_DE_MEJORA string, "
                                "SUGERENCIA string")
    out = M.build_model({("PRIME", "sheet"): sheet, ("PRIME", "sql"): sql}, "ReasonDissatisfaction", ORG)
    assert out.columns == M.REASON_V1_COLUMNS
    rows = sorted((tuple(r) for r in out.collect()), key=repr)
    assert rows == sorted([
        ("R1", "2000", "ORG-A", "PRIME", "C9", "C9", "2024-03-01", "Slow", "More staff", "None"),
        (None, None, None, "PRIME", None, None, "2024-04-01", None, "x", "y"),
        ("R2", None, "ORG-B", "PRIME", "C7", "C7", "202405", "Price", "Cheaper", "Less"),
    ], key=repr)


def test_survey_rental_key_numeric_and_casts(spark):
    cols = {n: "string" for n in M.source_columns(M.survey_mapping("RENTAL", "sheet"))}
    cols.update({"MES_ENCUESTA": "date", "Fecha_finalizacion_encuesta": "date", "INDICE_LEALTAD": "double",
                 "NLS": "double", "NRO_ENCUESTAS": "bigint", "SATISFACCION_GENERAL": "string"})
    values = {n: f"v_{n}" for n in cols}
    for tgt, src in M.survey_mapping("RENTAL", "sheet"):       # INT targets get integer text
        if tgt in M.INT_TARGETS and isinstance(src, str):
            values[src] = "3"
    values.update({"MES_ENCUESTA": dt.date(2024, 7, 15), "Fecha_finalizacion_encuesta": dt.date(2024, 7, 20),
                   "INDICE_LEALTAD": 8.125, "NLS": 0.5, "NRO_ENCUESTAS": 2, "SATISFACCION_GENERAL": "9",
                   "NUMERO_CLIENTE": "C1", "Serie": "S1", "SEGMENTO_2": "nan", "ORGANIZACION": "None"})
    names = list(cols)
    df = spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"`{n}` {cols[n]}" for n in names))
    r = M.build_model({("RENTAL", "sheet"): df}, "Survey", ORG).first().asDict()
    assert r["SurveyID"] == "7-C1-S1"                        # month-customer-serial key
    assert r["CompanyID"] is None and r["CompanyDescription"] is None
    assert r["CustomerID"] == r["CustomerIDDBS"] == "C1"
    assert r["SatisfactionEvaluation"] == 9                  # text source cast to INT
    assert r["LoyaltyIndex"] == Decimal("8.125000000") and r["NetLoyaltyScore"] == Decimal("0.500000000")
    assert r["AditionalCustomerSegmentDescription"] is None  # 'nan' cleansed
    assert r["Period"] == "2024-07-15" and r["SurveyDate"] == dt.date(2024, 7, 15)
    assert r["UniqueID"] is None                             # RENTAL has no unique id


def test_v2_keeps_sentinels_and_adds_reasons(spark):
    m = dict(M.reason_v2_mapping("PRIME", "sheet"))
    assert "SurveyID" not in m and "SurveyOrigin" not in m
    assert m["SurveyContactName"] == "Contacto_encuesta"
    assert m["ReasonDissatisfaction"] == "MOTIVOS_INSATISFACCION"       # no 'None' cleansing in V2
    assert m["ModelDescription"] == "IND_MODELO"
    sql = dict(M.reason_v2_mapping("SERVICE", "sql"))
    assert "UniqueID" not in sql and "Period" in sql and "OperationPlace" not in sql
