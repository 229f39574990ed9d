"""Publish survey sources into the common data model.

Each mapping is data: ``target column -> source expression``; one function
turns a mapping into a single ``select`` (a projection: no shuffle) and the
publish step unions the mapped frames by name.  Source column names are
resolved case-insensitively, so one mapping serves a sheet whose header case
drifts between loads.

Three targets: ``Survey`` (M1-M8), ``ReasonDissatisfaction`` (M9-M16) and
``ReasonDissatisfactionV2`` (M17-M24).  V2 mappings are derived by a rule
from the Survey mappings (no 'None'/'nan' cleansing, no SurveyID or
SurveyOrigin, plus the three reason columns) and a short list of deltas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import cast_for, resolve
from ..functions.cleanse import NAN_TEXT, NONE_TEXT


@dataclass(frozen=True)
class Src:
    """One source expression of a mapping."""
    kind: str                 # col | nz | nan | num | lit | org | day10 | key
    name: str | None = None   # column name (or literal text for ``lit``)


def nz(c: str) -> Src:
    return Src("nz", c)


def nan(c: str) -> Src:
    return Src("nan", c)


def num(c: str) -> Src:
    return Src("num", c)


def lit(v: str) -> Src:
    return Src("lit", v)


ORGCODE = Src("org")     # company code recoded from the organisation name
DAY10 = Src("day10")     # first 10 characters of the stringified survey month
RENTALKEY = Src("key")   # <month number>-<customer number>-<serial>
SAME = None              # SQL-export column = the sheet column

# --- fixed values: source column roles --------------------------------------
ORG_COLUMN = "ORGANIZACION"
MONTH_COLUMN = "MES_ENCUESTA"
KEY_CUSTOMER_COLUMN = "NUMERO_CLIENTE"
KEY_SERIAL_COLUMN = "Serie"
# ----------------------------------------------------------------------------

# --- fixed values: target columns and types ---------------------------------
V2_COLUMNS = [
    "Domain", "CompanyID", "CompanyDescription", "SurveyType", "BranchOfficeID",
    "BranchOfficeDescription", "SalesOfficeDescription", "OperationPlace", "SurveyDate",
    "SurveyEndDate", "CustomerID", "CustomerIDDBS", "CustomerName", "CustomerPhomeNumber",
    "InvoiceAmount", "ReferenceDocument", "ModelDescription", "FamilyDescription", "ComponentCode",
    "SerialNumber", "AssignmentReport", "SurveyContactName", "SurveyContactJobPosition",
    "SurveyContactPhoneNumber", "SurveyContactEmail", "SurveyPerson", "SurveyPersonNumber",
    "WorkOrderNumber", "OpeningDate", "InvoiceDate", "TransactionDate", "LastJobDate",
    "WorkOrderClosingDate", "InvoiceID", "ServiceType", "CSAType", "WorkshopGroup",
    "WorkOrderPrefix", "CC_CN", "WorkOrderPositionType", "SatisfactionEvaluation",
    "BuybackEvaluation", "RecommendationEvaluation", "AttentionEvaluation",
    "ConfigurationEvaluation", "PerformanceEvaluation", "PhysicalDeliveryEvaluation",
    "TechnicalDeliveryEvaluation", "EaseDoingBusinessEvaluation", "AvailabilityEvaluation",
    "AnswerEvaluation", "CommunicationEvaluation", "PreparationEvaluation", "DurationEvaluation",
    "TangibleInvoiceEvaluation", "QualityEvaluation", "InvoicePunctualityEvaluation",
    "InvoiceAccuracyEvaluation", "SatisfactionComment", "BuybackComment", "RecommendationComment",
    "AttentionComment", "ConfigurationComment", "PerformanceComment", "PhysicalDeliveryComment",
    "TechnicalDeliveryComment", "EaseDoingBusinessComment", "AvailabilityComment", "AnswerComment",
    "CommunicationComment", "PreparationComment", "DurationComment", "TangibleInvoiceComment",
    "QualityComment", "InvoicePunctualityComment", "InvoiceAccuracyComment",
    "HigherRatingComment", "AdditionalComment", "AudioFile", "RegionDescription",
    "ResponsibleManagement", "SalesRepGroupDescription", "CustomerSegmentDescription",
    "AditionalCustomerSegmentDescription", "CustomerMarketDescription", "RRVV", "PSSR",
    "SurveyCounter", "LoyaltyIndex", "NetLoyaltyScoreDescription", "NetLoyaltyScore",
    "ExecutedBy", "CustomerType", "ParentCustomerName", "AttendedBy", "BrandDescription",
    "LineDescription", "CSAPlanType", "Period", "UniqueID", "ReasonDissatisfaction",
    "OpportunityImprovement", "Suggestion",
]
DATE_TARGETS = {"SurveyDate", "SurveyEndDate", "OpeningDate", "InvoiceDate", "TransactionDate",
                "LastJobDate", "WorkOrderClosingDate"}
NUMERIC_TARGETS = {"LoyaltyIndex", "NetLoyaltyScore"}
INT_TARGETS = {c for c in V2_COLUMNS if c.endswith("Evaluation")} | {"SurveyCounter"}
REASON_COLUMNS = ["ReasonDissatisfaction", "OpportunityImprovement", "Suggestion"]
SURVEY_COLUMNS = (["SurveyID"] + [c for c in V2_COLUMNS if c not in REASON_COLUMNS and c != "CSAPlanType"
                                  and c != "Period" and c != "UniqueID"]
                  + ["SurveyOrigin", "CSAPlanType", "Period", "UniqueID"])
REASON_V1_COLUMNS = ["SurveyID", "CompanyID", "CompanyDescription", "Domain", "CustomerID",
                     "CustomerIDDBS", "Period", "ReasonDissatisfaction", "OpportunityImprovement",
                     "Suggestion"]
# ----------------------------------------------------------------------------


def target_type(name: str) -> T.DataType:
    if name in DATE_TARGETS:
        return T.DateType()
    if name in NUMERIC_TARGETS:
        return T.DecimalType(38, 9)
    if name in INT_TARGETS:
        return T.LongType()
    return T.StringType()


def target_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, target_type(c), True) for c in columns])


SURVEY_SCHEMA = target_schema(SURVEY_COLUMNS)
REASON_V1_SCHEMA = target_schema(REASON_V1_COLUMNS)
REASON_V2_SCHEMA = target_schema(V2_COLUMNS)

# --- fixed values: Survey mappings (target, sheet source, SQL-export source) -
SURVEY_PRIME = [
    ("SurveyID", "Reporte_Asignacion", nz("REPORTE_DE_ASIGNACION")),
    ("Domain", lit("PRIME"), SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", "ORGANIZACION", SAME),
    ("BranchOfficeID", "NRO_SUCURSAL", SAME),
    ("BranchOfficeDescription", "SUCURSAL", SAME),
    ("SalesOfficeDescription", "OFICINA", SAME),
    ("SurveyDate", "MES_ENCUESTA", SAME),
    ("SurveyEndDate", "Fecha_finalizacion_encuesta", "FECHA_DE_FINALIZACION_DE_LA_ENCUESTA"),
    ("CustomerID", "Codigo_Cliente", "CODIGO_DE_CLIENTE"),
    ("CustomerIDDBS", "Codigo_Cliente", "CODIGO_DE_CLIENTE"),
    ("CustomerName", "Nombre_cliente", "NOMBRE_DEL_CLIENTE"),
    ("ModelDescription", nz("IND_MODELO"), SAME),
    ("FamilyDescription", "Familia_productos", nz("FAMILIADEPRODUCTOS")),
    ("SerialNumber", nz("SERIE"), SAME),
    ("AssignmentReport", "Reporte_Asignacion", nz("REPORTE_DE_ASIGNACION")),
    ("SurveyContactName", "Contacto_para_encuesta", nz("CONTACTO_ENCUESTA")),
    ("SurveyContactJobPosition", nz("CARGO"), SAME),
    ("SurveyContactPhoneNumber", nz("TELEFONO"), SAME),
    ("SurveyContactEmail", nz("CORREO_ELECTRONICO"), SAME),
    ("SatisfactionEvaluation", "SATISFACCION", SAME),
    ("BuybackEvaluation", "RECOMPRA", SAME),
    ("RecommendationEvaluation", "RECOMENDACION", SAME),
    ("AttentionEvaluation", "ATENCION", SAME),
    ("ConfigurationEvaluation", "CONFIGURACION", SAME),
    ("PerformanceEvaluation", "Desempeno", "DESEMPENIO"),
    ("PhysicalDeliveryEvaluation", "ENTREGA_FISICA", SAME),
    ("TechnicalDeliveryEvaluation", "ENTREGA_TECNICA", SAME),
    ("SatisfactionComment", nz("COMENTARIO_SATISFACCION"), SAME),
    ("BuybackComment", nz("COMENTARIO_RECOMPRA"), SAME),
    ("RecommendationComment", nz("COMENTARIO_RECOMENDACION"), SAME),
    ("AttentionComment", nz("COMENTARIO_ATENCION"), SAME),
    ("ConfigurationComment", nz("COMENTARIO_CONFIGURACION"), SAME),
    ("PerformanceComment", "Comentario_Desempeno", nz("COMENTARIO_DESEMPENIO")),
    ("PhysicalDeliveryComment", nz("COMENTARIO_ENTREGA_FISICA"), SAME),
    ("TechnicalDeliveryComment", nz("COMENTARIO_ENTREGA_TECNICA"), SAME),
    ("HigherRatingComment", nz("MAYOR_VALORACION"), SAME),
    ("AdditionalComment", nz("COMENTARIO_ADICIONAL"), SAME),
    ("RegionDescription", nz("REGION"), SAME),
    ("ResponsibleManagement", nz("GERENCIA_RESPONSABLE"), SAME),
    ("SalesRepGroupDescription", "Unidad_negocio", "UNIDAD_DE_NEGOCIO"),
    ("CustomerSegmentDescription", "SEGMENTO", SAME),
    ("AditionalCustomerSegmentDescription", nz("SEGMENTO_2"), SAME),
    ("CustomerMarketDescription", "MERCADO", SAME),
    ("RRVV", nz("RRVV"), SAME),
    ("PSSR", nz("PSSR"), SAME),
    ("SurveyCounter", "NRO_ENCUESTAS", SAME),
    ("LoyaltyIndex", num("Indice_lealtad"), num("INDICE_DE_LEALTAD")),
    ("NetLoyaltyScoreDescription", "NLS2", SAME),
    ("NetLoyaltyScore", num("NLS"), SAME),
    ("ExecutedBy", "EJECUTADA_POR", SAME),
    ("CustomerType", "Tipo_razon_social", "TIPO_DE_RAZON_SOCIAL"),
    ("ParentCustomerName", "RAZON_SOCIAL_PARENT", SAME),
    ("AttendedBy", "ATENDIDO_POR", SAME),
    ("BrandDescription", "MARCA", SAME),
    ("LineDescription", "LINEA", SAME),
    ("SurveyOrigin", "ORIGEN_ENCUESTA", SAME),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("UniqueID", "identificador_unico", SAME),
]

SURVEY_RENTAL = [
    ("SurveyID", RENTALKEY, SAME),
    ("Domain", lit("RENTAL"), SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", nz("ORGANIZACION"), SAME),
    ("BranchOfficeID", nz("NRO_SUCURSAL"), SAME),
    ("BranchOfficeDescription", nz("SUCURSAL"), SAME),
    ("SalesOfficeDescription", nz("OFICINA"), SAME),
    ("SurveyDate", "MES_ENCUESTA", SAME),
    ("SurveyEndDate", "Fecha_finalizacion_encuesta", "FECHA_FINALIZACION_LA_ENCUESTA"),
    ("CustomerID", nz("NUMERO_CLIENTE"), SAME),
    ("CustomerIDDBS", nz("NUMERO_CLIENTE"), SAME),
    ("CustomerName", "Nombre_Cliente", nz("NOMBRE_DEL_CLIENTE")),
    ("CustomerPhomeNumber", "Numero_Cliente", nz("NUMERO_DEL_CLIENTE")),
    ("ComponentCode", nz("CODIGO_COMPONENTE"), SAME),
    ("SerialNumber", nz("SERIE"), SAME),
    ("SurveyContactName", "Contacto_Cliente", nz("CONTACTO_DE_CLIENTE")),
    ("SurveyContactPhoneNumber", nz("TELEFONO_CONTACTO"), SAME),
    ("SurveyContactEmail", nz("CORREO_CONTACTO"), SAME),
    ("SurveyPerson", "Persona_contesto_encuesta", "PERSONA_QUE_CONTESTO_LA_ENCUESTA"),
    ("SurveyPersonNumber", "TELEFONO", SAME),
    ("SatisfactionEvaluation", "SATISFACCION_GENERAL", SAME),
    ("BuybackEvaluation", "RECOMPRA", SAME),
    ("RecommendationEvaluation", "RECOMENDACION", SAME),
    ("EaseDoingBusinessEvaluation", "Facilidad_para_tramite", "FACILIDAD_PARA_EL_TRAMITE"),
    ("AvailabilityEvaluation", "DISPONIBILIDAD", SAME),
    ("AnswerEvaluation", "RESPUESTA", SAME),
    ("CommunicationEvaluation", "COMUNICACION", SAME),
    ("PreparationEvaluation", "PREPARACION", SAME),
    ("DurationEvaluation", "DURACION", SAME),
    ("QualityEvaluation", "CALIDAD", SAME),
    ("InvoicePunctualityEvaluation", "PUNTUALIDAD_FACTURA", "PUNTUALIDAD_LA_FACTURA"),
    ("InvoiceAccuracyEvaluation", "PRECISION_FACTURA", "PRECISION_LA_FACTURA"),
    ("SatisfactionComment", nz("SATISFACCION_GENERAL_COMS"), SAME),
    ("BuybackComment", nz("RECOMPRA_COMS"), SAME),
    ("RecommendationComment", nz("RECOMENDACION_COMS"), SAME),
    ("EaseDoingBusinessComment", "Facilidad_Tramite_Coms", nz("FACILIDAD_PARA_EL_TRAMITE_COMS")),
    ("AvailabilityComment", "Disponibilidad_Fiabilidad_Coms", nz("DISPONIBILIDAD_Y_FIABILIDAD_COMS")),
    ("AnswerComment", nz("RESPUESTA_COMS"), SAME),
    ("CommunicationComment", "COMUNICACION_COMS", SAME),
    ("PreparationComment", "PREPARACION_COMS", SAME),
    ("DurationComment", "DURACION_COMS", SAME),
    ("QualityComment", "CALIDAD_COMS", SAME),
    ("InvoicePunctualityComment", "PUNTUALIDAD_FACTURA_COMS", SAME),
    ("InvoiceAccuracyComment", "PRECISION_FACTURA_COMS", SAME),
    ("HigherRatingComment", "MAYOR_VALORACION_COMS", SAME),
    ("AdditionalComment", "COMENTARIOS_ADICIONALES", SAME),
    ("AudioFile", "ARCHIVO_AUDIO", SAME),
    ("RegionDescription", "REGION", SAME),
    ("ResponsibleManagement", "GERENCIA_RESPONSABLE", SAME),
    ("SalesRepGroupDescription", "UNIDAD_NEGOCIO", SAME),
    ("CustomerSegmentDescription", "SEGMENTO", SAME),
    ("AditionalCustomerSegmentDescription", nan("SEGMENTO_2"), SAME),
    ("CustomerMarketDescription", "MERCADO", SAME),
    ("RRVV", "RRVV", SAME),
    ("PSSR", "PSSR", SAME),
    ("SurveyCounter", "NRO_ENCUESTAS", SAME),
    ("LoyaltyIndex", num("INDICE_LEALTAD"), SAME),
    ("NetLoyaltyScoreDescription", "NLS2", SAME),
    ("NetLoyaltyScore", num("NLS"), SAME),
    ("CustomerType", "TIPO_RAZON_SOCIAL", SAME),
    ("ParentCustomerName", "RAZON_SOCIAL_PARENT", SAME),
    ("AttendedBy", "ATENDIDO_POR", SAME),
    ("BrandDescription", "MARCA", SAME),
    ("LineDescription", "LINEA", SAME),
    ("SurveyOrigin", "ORIGEN_ENCUESTA", SAME),
    ("Period", DAY10, "PERIODO_CARGA"),
]

SURVEY_PARTS = [
    ("SurveyID", "DOCUMENTO_REFERENCIA", SAME),
    ("Domain", lit("PARTS"), SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", "ORGANIZACION", SAME),
    ("SurveyType", "TIPO_ENCUESTA", SAME),
    ("BranchOfficeID", "N_SUCURSAL", SAME),
    ("BranchOfficeDescription", "SUCURSAL", SAME),
    ("SalesOfficeDescription", "OFICINA", SAME),
    ("SurveyDate", "MES_ENCUESTA", SAME),
    ("SurveyEndDate", "Fecha_finalizacion_encuesta", "FECHA_FINALIZACION_LA_ENCUESTA"),
    ("CustomerID", "NUMERO_CLIENTE", SAME),
    ("CustomerIDDBS", "NUMERO_CLIENTE", SAME),
    ("CustomerName", "NOMBRE_CLIENTE", SAME),
    ("InvoiceAmount", "MONTO_FACTURADO", SAME),
    ("ReferenceDocument", "DOCUMENTO_REFERENCIA", SAME),
    ("ComponentCode", "CODIGO_COMPONENTE", SAME),
    ("SurveyContactName", "CONTACTO_CLIENTE", SAME),
    ("SurveyContactPhoneNumber", "TELEFONO_CONTACTO", SAME),
    ("SurveyContactEmail", "Correo_del_contacto", "CORREO_CONTACTO"),
    ("SurveyPerson", "Persona_respondio_encuesta", "PERSONA_QUE_RESPONDIO_LA_ENCUESTA"),
    ("SurveyPersonNumber", "TELEFONO", SAME),
    ("SatisfactionEvaluation", "SATISFACCION_GENERAL", SAME),
    ("BuybackEvaluation", "RECOMPRA", SAME),
    ("RecommendationEvaluation", "RECOMENDACION", SAME),
    ("EaseDoingBusinessEvaluation", "Facilidad_para_tramite", "FACILIDAD_PARA_EL_TRAMITE"),
    ("AvailabilityEvaluation", "DISPONIBILIDAD_CONOCIMIENTO_VENDEDOR", SAME),
    ("AnswerEvaluation", "RESPUESTA", SAME),
    ("CommunicationEvaluation", "COMUNICACION", SAME),
    ("PreparationEvaluation", "PREPARACION_STOCK", SAME),
    ("DurationEvaluation", "DURACION", SAME),
    ("QualityEvaluation", "CALIDAD", SAME),
    ("InvoicePunctualityEvaluation", "PUNTUALIDAD_FACTURA", SAME),
    ("InvoiceAccuracyEvaluation", "PRECISION_FACTURA", SAME),
    ("SatisfactionComment", nz("SATISFACCION_GENERAL_COMENTARIO"), SAME),
    ("BuybackComment", nz("RECOMPRA_COMENTARIO"), SAME),
    ("RecommendationComment", nz("RECOMENDACION_COMENTARIO"), SAME),
    ("EaseDoingBusinessComment", "Facilidad_Tramite_Comentario", nz("FACILIDAD_PARA_EL_TRAMITE_COMENTARIO")),
    ("AvailabilityComment", nz("Disponibilidad_Fiabilidad_Comentario"), nz("DISPONIBILIDAD_Y_FIABILIDAD_COMENTARIO")),
    ("AnswerComment", nz("RESPUESTA_COMENTARIO"), SAME),
    ("CommunicationComment", "COMUNICACION_COMENTARIO", SAME),
    ("PreparationComment", "PREPARACION_COMS", SAME),
    ("DurationComment", "DURACION_COMENTARIO", SAME),
    ("QualityComment", "CALIDAD_COMENTARIO", SAME),
    ("InvoicePunctualityComment", "Puntualidad_Factura_Comntario", "PUNTUALIDAD_FACTURA_COMENTARIO"),
    ("InvoiceAccuracyComment", "PRECISION_FACTURA_COMENTARIO", SAME),
    ("HigherRatingComment", "MAYOR_VALORACION_COMENTARIO", SAME),
    ("AdditionalComment", "COMENTARIOS_ADICIONALES", SAME),
    ("RegionDescription", "REGION", SAME),
    ("ResponsibleManagement", "GERENCIA_RESPONSABLE", SAME),
    ("SalesRepGroupDescription", "UNIDAD_NEGOCIOS", SAME),
    ("CustomerSegmentDescription", "SEGMENTO", SAME),
    ("AditionalCustomerSegmentDescription", "SEGMENTO_2", SAME),
    ("CustomerMarketDescription", "MERCADO", SAME),
    ("RRVV", "RRVV", SAME),
    ("PSSR", "PSSR", SAME),
    ("SurveyCounter", "NRO_ENCUESTAS", SAME),
    ("LoyaltyIndex", num("INDICE_LEALTAD"), SAME),
    ("NetLoyaltyScoreDescription", "NLS2", SAME),
    ("NetLoyaltyScore", num("NLS"), SAME),
    ("CustomerType", "TIPO_RAZON_SOCIAL", SAME),
    ("ParentCustomerName", "RAZON_SOCIAL_PARENT", SAME),
    ("AttendedBy", "ATENDIDO_POR", SAME),
    ("BrandDescription", "MARCA", SAME),
    ("LineDescription", "LINEA", SAME),
    ("SurveyOrigin", "ORIGEN_ENCUESTA", SAME),
    ("Period", DAY10, "PERIODO_CARGA"),
]

SURVEY_SERVICE = [
    ("SurveyID", "Nro_de_Orden_de_Trabajo", "NRO_ORDEN_DETRABAJO"),
    ("Domain", lit("SERVICE"), SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", "ORGANIZACION", SAME),
    ("BranchOfficeID", "NRO_SUCURSAL", "N_SUCURSAL"),
    ("BranchOfficeDescription", "SUCURSAL", SAME),
    ("SalesOfficeDescription", "OFICINA", SAME),
    ("OperationPlace", "LUGAR_DE_OPERACION", SAME),
    ("SurveyDate", "MES_ENCUESTA", SAME),
    ("SurveyEndDate", "FECHA_FINALIZACION_DE_ENCUESTA", "FECHA_FINALIZACION_LA_ENCUESTA"),
    ("CustomerID", "NRO_DE_CLIENTE", "NRO_CLIENTE"),
    ("CustomerIDDBS", "NRO_DE_CLIENTE", "NRO_CLIENTE"),
    ("CustomerName", "NOMBRE_DE_CLIENTE", "NOMBRE_CLIENTE"),
    ("ModelDescription", "MODELO", SAME),
    ("SerialNumber", "NUMERO_DE_SERIE", "NUMERO_SERIE"),
    ("SurveyContactName", "CONTACTO_CON_EL_CLIENTE", SAME),
    ("SurveyPerson", "PERSONA_CONTESTO_LA_ENCUESTA", "PERSONA_QUE_CONTESTO_LA_ENCUESTA"),
    ("WorkOrderNumber", "NRO_DE_ORDEN_DE_TRABAJO", "NRO_ORDEN_DETRABAJO"),
    ("OpeningDate", "FECHA_DE_APERTURA", "FECHA_APERTURA"),
    ("InvoiceDate", "FECHA_DE_FACTURA", "FECHA_FACTURA"),
    ("TransactionDate", "FECHA_DE_TRANSACCION", "FECHA_TRANSACCION"),
    ("LastJobDate", "ULTIMO_TRABAJO", SAME),
    ("WorkOrderClosingDate", "CIERRE_ORDEN_TRABAJO", "CIERRE_LA_ORDEN_TRABAJO"),
    ("InvoiceID", "NRO_DE_FACTURA", "NRO_FACTURA"),
    ("ServiceType", "TIPO_SERVICIO", SAME),
    ("CSAType", "TIPO_DE_CSA", "TIPO_CSA"),
    ("WorkshopGroup", "AGRUPACION_TALLERES", SAME),
    ("WorkOrderPrefix", "PREFIJO_DE_LA_OT", "PREFIJO_LA_OT"),
    ("CC_CN", "CC_CN", SAME),
    ("WorkOrderPositionType", "TIPO_CARGO_OT", SAME),
    ("SatisfactionEvaluation", "SATISFACCION_GENERAL", SAME),
    ("BuybackEvaluation", "RECOMPRA", SAME),
    ("RecommendationEvaluation", "RECOMENDACION", SAME),
    ("EaseDoingBusinessEvaluation", "FACILIDAD_PARA_HACER_NEGOCIOS", SAME),
    ("AvailabilityEvaluation", "DISPONIBILIDAD", SAME),
    ("AnswerEvaluation", "RESPUESTA", SAME),
    ("CommunicationEvaluation", "COMUNICACION", SAME),
    ("PreparationEvaluation", "PREPARACION", SAME),
    ("DurationEvaluation", "DURACION", SAME),
    ("TangibleInvoiceEvaluation", "TANGIBLES_FACTURA", SAME),
    ("QualityEvaluation", "CALIDAD", SAME),
    ("InvoicePunctualityEvaluation", "PUNTUALIDAD_DE_LA_FACTURA", "PUNTUALIDAD_LA_FACTURA"),
    ("InvoiceAccuracyEvaluation", "PRECISION_DE_LA_FACTURA", "PRECISION_LA_FACTURA"),
    ("SatisfactionComment", "SATISFACCION_GENERAL_COMS", SAME),
    ("BuybackComment", "RECOMPRA_COMS", SAME),
    ("RecommendationComment", "RECOMENDACION_COMS", SAME),
    ("EaseDoingBusinessComment", "FACILIDAD_PARA_HACER_NEGOCIOS_COMS", SAME),
    ("AvailabilityComment", "Disponibilidad_Fiabilidad_Coms", "DISPONIBILIDAD_Y_FIABILIDAD_COMS"),
    ("AnswerComment", "RESPUESTA_COMS", SAME),
    ("CommunicationComment", "COMUNICACION_COMS", SAME),
    ("PreparationComment", "PREPARACION_COMS", SAME),
    ("DurationComment", "DURACION_COMS", SAME),
    ("TangibleInvoiceComment", "TANGIBLES_FACTURA_COMS", SAME),
    ("QualityComment", "CALIDAD_COMS", SAME),
    ("InvoicePunctualityComment", "Puntualidad_de_factura_Coms", "PUNTUALIDAD_LA_FACTURA_COMS"),
    ("InvoiceAccuracyComment", "PRECISION_DE_FACTURA_COMS", "PRECISION_LA_FACTURA_COMS"),
    ("HigherRatingComment", "MAYOR_VALORACION_COMS", SAME),
    ("AdditionalComment", "COMENTARIOS_ADICIONALES", SAME),
    ("RegionDescription", "REGION", SAME),
    ("ResponsibleManagement", "GERENCIA_RESPONSABLE", SAME),
    ("SalesRepGroupDescription", "UNIDAD_DE_NEGOCIOS", "UNIDAD_NEGOCIOS"),
    ("CustomerSegmentDescription", "SEGMENTO", SAME),
    ("AditionalCustomerSegmentDescription", "SEGMENTO_2", SAME),
    ("CustomerMarketDescription", "MERCADO", SAME),
    ("RRVV", "RRVV", SAME),
    ("PSSR", nan("PSSR"), SAME),
    ("SurveyCounter", "NRO_ENCUESTAS", SAME),
    ("LoyaltyIndex", num("INDICE_DE_LEALTAD"), num("INDICE_LEALTAD")),
    ("NetLoyaltyScoreDescription", "NLS2", SAME),
    ("NetLoyaltyScore", num("NLS"), SAME),
    ("CustomerType", "TIPO_DE_RAZON_SOCIAL", "TIPO_RAZON_SOCIAL"),
    ("ParentCustomerName", "RAZON_SOCIAL_PARENT", SAME),
    ("AttendedBy", "ATENDIDO_POR", SAME),
    ("BrandDescription", "MARCA", SAME),
    ("LineDescription", "LINEA", SAME),
    ("SurveyOrigin", "ORIGEN_ENCUESTA", SAME),
    ("CSAPlanType", "TIPO_DE_CSA", "TIPO_CSA"),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("UniqueID", "identificador_unico", SAME),
]

# ReasonDissatisfaction (V1): (target, sheet source, SQL-export source) per domain.
REASON_PARTS = [
    ("SurveyID", nz("DOCUMENTO_REFERENCIA"), SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", nz("ORGANIZACION"), SAME),
    ("Domain", lit("PARTS"), SAME),
    ("CustomerID", nz("NUMERO_CLIENTE"), SAME),
    ("CustomerIDDBS", nz("NUMERO_CLIENTE"), SAME),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("ReasonDissatisfaction", nz("MOTIVO_INSATISFACCION"), SAME),
    ("OpportunityImprovement", nz("OPORTUNIDAD_MEJORA"), SAME),
    ("Suggestion", nz("SUGERENCIA_MEJORA"), SAME),
]
REASON_PRIME = [
    ("SurveyID", nz("REPORTE_ASIGNACION"), nz("REPORTE_DE_ASIGNACION")),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", nz("ORGANIZACION"), SAME),
    ("Domain", lit("PRIME"), SAME),
    ("CustomerID", nz("CODIGO_CLIENTE"), nz("CODIGO_DE_CLIENTE")),
    ("CustomerIDDBS", nz("CODIGO_CLIENTE"), nz("CODIGO_DE_CLIENTE")),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("ReasonDissatisfaction", nz("MOTIVOS_INSATISFACCION"), nz("MOTIVOS_DE_INSATISFACCION")),
    ("OpportunityImprovement", "OPORTUNIDAD_MEJORA", "OPORTUNIDAD_DE_MEJORA"),
    ("Suggestion", "SUGERENCIA", SAME),
]
REASON_RENTAL = [
    ("SurveyID", RENTALKEY, SAME),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", nz("ORGANIZACION"), SAME),
    ("Domain", lit("RENTAL"), SAME),
    ("CustomerID", nz("NUMERO_CLIENTE"), SAME),
    ("CustomerIDDBS", nz("NUMERO_CLIENTE"), SAME),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("ReasonDissatisfaction", nz("MOTIVO_INSATISFACCION"), SAME),
    ("OpportunityImprovement", "OPORTUNIDAD_MEJORA", SAME),
    ("Suggestion", "SUGERENCIA_MEJORA", SAME),
]
REASON_SERVICE = [
    ("SurveyID", nz("N_ORDEN_TRABAJO"), nz("NRO_ORDEN_DETRABAJO")),
    ("CompanyID", ORGCODE, SAME),
    ("CompanyDescription", nz("ORGANIZACION"), SAME),
    ("Domain", lit("SERVICE"), SAME),
    ("CustomerID", nz("NO_CLIENTE"), nz("NRO_CLIENTE")),
    ("CustomerIDDBS", nz("NO_CLIENTE"), nz("NRO_CLIENTE")),
    ("Period", DAY10, "PERIODO_CARGA"),
    ("ReasonDissatisfaction", nz("MOTIVO_INSATISFACCION"), SAME),
    ("OpportunityImprovement", "OPORTUNIDAD_MEJORA", SAME),
    ("Suggestion", "SUGERENCIA_MEJORA", SAME),
]

# V2 deltas from the Survey mapping of the same domain and origin.
V2_DELTAS = {
    ("PRIME", "sheet"): {"SurveyContactName": "Contacto_encuesta"},
    ("RENTAL", "sheet"): {"EaseDoingBusinessComment": "Facilidad_para_Tramite_Coms",
                          "InvoiceAccuracyComment": "Precision_de_Factura_Coms"},
    ("PARTS", "sheet"): {"SurveyContactEmail": "CORREO_CONTACTO",
                         "EaseDoingBusinessComment": "FACILIDAD_PARA_TRAMITE_COMENTARIO",
                         "InvoicePunctualityComment": "PUNTUALIDAD_FACTURA_COMENTARIO"},
    ("SERVICE", "sheet"): {
        "BranchOfficeID": "N_Sucursal", "OperationPlace": "Lugar_Operacion",
        "SurveyEndDate": "Fecha_finalizacion_encuesta", "CustomerID": "No_cliente",
        "CustomerIDDBS": "No_cliente", "CustomerName": "Nombre_cliente", "SerialNumber": "Numero_Serie",
        "SurveyContactName": "Contacto_con_cliente", "SurveyPerson": "Persona_contesto_encuesta",
        "WorkOrderNumber": "N_Orden_Trabajo", "OpeningDate": "Fecha_apertura",
        "InvoiceDate": "Fecha_factura", "TransactionDate": "Fecha_transaccion", "InvoiceID": "N_factura",
        "CSAType": "Tipo_CSA", "CSAPlanType": "Tipo_CSA", "WorkOrderPrefix": "Prefijo_OT",
        "InvoicePunctualityEvaluation": "Puntualidad_factura",
        "InvoiceAccuracyEvaluation": "Precision_factura",
        "EaseDoingBusinessComment": "Facilidad_para_negocios_Coms",
        "InvoicePunctualityComment": "Puntualidad_factura_Coms",
        "InvoiceAccuracyComment": "Precision_factura_Coms", "SalesRepGroupDescription": "Unidad_negocios",
        "LoyaltyIndex": num("Indice_lealtad"), "CustomerType": "Tipo_razon_social"},
    ("PRIME", "sql"): {"SurveyContactName": "CONTACTO_PARA_ENCUESTA"},
    ("RENTAL", "sql"): {"CustomerName": "NOMBRE_CLIENTE", "SurveyContactName": "CONTACTO_CLIENTE"},
    ("PARTS", "sql"): {"InvoicePunctualityEvaluation": "PUNTUALIDAD_DE_FACTURA",
                       "InvoiceAccuracyEvaluation": "PRECISION_DE_FACTURA",
                       "InvoicePunctualityComment": "PUNTUALIDAD_DE_FACTURA_COMENTARIO",
                       "InvoiceAccuracyComment": "PRECISION_DE_FACTURA_COMENTARIO"},
    ("SERVICE", "sql"): {},
}
V2_DROPS = {
    ("SERVICE", "sheet"): ["Period"],
    ("SERVICE", "sql"): ["OperationPlace", "ModelDescription", "SerialNumber", "WorkOrderNumber",
                         "OpeningDate", "InvoiceDate", "TransactionDate", "LastJobDate",
                         "WorkOrderClosingDate", "InvoiceID", "ServiceType", "CSAType", "WorkshopGroup",
                         "WorkOrderPrefix", "CC_CN", "WorkOrderPositionType", "TangibleInvoiceEvaluation",
                         "TangibleInvoiceComment", "CSAPlanType", "UniqueID"],
}
# ----------------------------------------------------------------------------

SURVEY_TABLES = {"PRIME": SURVEY_PRIME, "RENTAL": SURVEY_RENTAL, "PARTS": SURVEY_PARTS,
                 "SERVICE": SURVEY_SERVICE}
REASON_TABLES = {"PARTS": REASON_PARTS, "PRIME": REASON_PRIME, "RENTAL": REASON_RENTAL,
                 "SERVICE": REASON_SERVICE}
ORIGINS = ("sheet", "sql")
DOMAINS = ("PRIME", "RENTAL", "PARTS", "SERVICE")


def _pick(row: tuple, origin: str) -> Src | str:
    _, sheet, sql = row
    return sheet if origin == "sheet" or sql is SAME else sql


def _plain(src: Src | str) -> Src | str:
    """V2 rule: no 'None'/'nan' cleansing."""
    if isinstance(src, Src) and src.kind in ("nz", "nan"):
        return src.name
    return src


def survey_mapping(domain: str, origin: str) -> list[tuple[str, Src | str]]:
    """M1-M8: Survey mapping of one domain and origin (sheet / sql)."""
    return [(r[0], _pick(r, origin)) for r in SURVEY_TABLES[domain]]


def reason_mapping(domain: str, origin: str) -> list[tuple[str, Src | str]]:
    """ReasonDissatisfaction (V1) mapping."""
    return [(r[0], _pick(r, origin)) for r in REASON_TABLES[domain]]


def reason_v2_mapping(domain: str, origin: str) -> list[tuple[str, Src | str]]:
    """M17-M24 by rule: the Survey mapping without cleansing, without
    SurveyID / SurveyOrigin, plus the three reason columns, then deltas."""
    deltas = V2_DELTAS.get((domain, origin), {})
    drops = set(V2_DROPS.get((domain, origin), []))
    out = []
    for target, src in survey_mapping(domain, origin):
        if target in ("SurveyID", "SurveyOrigin") or target in drops:
            continue
        out.append((target, _plain(deltas.get(target, src))))
    reasons = dict(reason_mapping(domain, origin))
    for r in REASON_COLUMNS:
        out.append((r, _plain(reasons[r])))
    return out


MAPPINGS = {
    "Survey": survey_mapping,
    "ReasonDissatisfaction": reason_mapping,
    "ReasonDissatisfactionV2": reason_v2_mapping,
}
TARGET_COLUMNS = {"Survey": SURVEY_COLUMNS, "ReasonDissatisfaction": REASON_V1_COLUMNS,
                  "ReasonDissatisfactionV2": V2_COLUMNS}


def source_columns(mapping: Sequence[tuple[str, Src | str]]) -> list[str]:
    """Every source column a mapping reads (for pruning / fixtures)."""
    out: list[str] = []
    for _, s in mapping:
        names = []
        if isinstance(s, str):
            names = [s]
        elif s.kind in ("nz", "nan", "num", "col"):
            names = [s.name]
        elif s.kind == "org":
            names = [ORG_COLUMN]
        elif s.kind == "day10":
            names = [MONTH_COLUMN]
        elif s.kind == "key":
            names = [MONTH_COLUMN, KEY_CUSTOMER_COLUMN, KEY_SERIAL_COLUMN]
        for n in names:
            if n.lower() not in {o.lower() for o in out}:
                out.append(n)
    return out


def _bq(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sq(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(df: DataFrame, name: str) -> str:
    src = resolve(df.columns, name)
    if src is None:
        raise KeyError(f"source column {name!r} not found")
    return _bq(src)


def source_sql(df: DataFrame, src: Src | str, org_codes: Mapping[str, str]) -> str:
    """A mapping source as one Spark SQL expression (parsed JVM-side: a
    100-column mapping costs one call per column, not one per operator)."""
    if isinstance(src, str):
        return _name(df, src)
    if src.kind == "nz":
        return f"nullif({_name(df, src.name)}, {_sq(NONE_TEXT)})"
    if src.kind == "nan":
        return f"nullif({_name(df, src.name)}, {_sq(NAN_TEXT)})"
    if src.kind == "num":
        return f"try_cast({_name(df, src.name)} AS DECIMAL(38,9))"
    if src.kind == "lit":
        return _sq(src.name)
    if src.kind == "org":
        org = _name(df, ORG_COLUMN)
        cases = " ".join(f"WHEN {org} = {_sq(k)} THEN {_sq(v)}" for k, v in org_codes.items())
        return f"CASE {cases} ELSE CAST(NULL AS STRING) END" if cases else "CAST(NULL AS STRING)"
    if src.kind == "day10":
        return f"substring(CAST({_name(df, MONTH_COLUMN)} AS STRING), 1, 10)"
    if src.kind == "key":
        return (f"concat(CAST(month(to_date({_name(df, MONTH_COLUMN)})) AS STRING), '-', "
                f"CAST({_name(df, KEY_CUSTOMER_COLUMN)} AS STRING), '-', "
                f"CAST({_name(df, KEY_SERIAL_COLUMN)} AS STRING))")
    raise ValueError(f"unknown source kind {src.kind}")


def source_expr(df: DataFrame, src: Src | str, org_codes: Mapping[str, str]) -> Column:
    return F.expr(source_sql(df, src, org_codes))


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, Src | str]], target: str,
                  org_codes: Mapping[str, str], strict: bool = True) -> DataFrame:
    """One ``INSERT ... SELECT`` as a projection to the full target schema.

    Text sources feeding a typed target go through the master-type casts
    (strict by default); typed sources are cast to the target type; target
    columns the mapping does not feed are typed NULLs.
    """
    cols = TARGET_COLUMNS[target]
    exprs: dict[str, Column] = {}
    for tgt, src in mapping:
        ttype = target_type(tgt)
        tname = ttype.simpleString()
        if isinstance(src, str) and not isinstance(ttype, T.StringType) \
                and isinstance(df.schema[resolve(df.columns, src)].dataType, T.StringType):
            master = "DATE" if isinstance(ttype, T.DateType) else (
                "NUMERIC" if isinstance(ttype, T.DecimalType) else "INT64")
            exprs[tgt] = cast_for(F.col(_name(df, src)), master, strict).cast(ttype).alias(tgt)
        else:
            exprs[tgt] = F.expr(f"CAST({source_sql(df, src, org_codes)} AS {tname}) AS {_bq(tgt)}")
    return df.select(*[exprs[c] if c in exprs else
                       F.expr(f"CAST(NULL AS {target_type(c).simpleString()}) AS {_bq(c)}") for c in cols])


def build_model(sources: Mapping[tuple[str, str], DataFrame], target: str,
                org_codes: Mapping[str, str], strict: bool = True,
                origin_column: str | None = None) -> DataFrame:
    """Map every (domain, origin) source and union them by name.

    ``sources`` maps ``(domain, origin)`` -> PROCESSED frame.  Pure
    projections and a union: the plan has no shuffle, so it scales with the
    sources and a hot domain costs nothing extra.
    """
    fn = MAPPINGS[target]
    parts = []
    for (domain, origin), df in sources.items():
        m = apply_mapping(df, fn(domain, origin), target, org_codes, strict)
        if origin_column:
            m = m.withColumn(origin_column, F.lit(origin))
        parts.append(m)
    # every part is projected to the same target column list, so a
    # positional union is exact (and cheaper to analyse than by-name)
    return reduce(DataFrame.union, parts)
