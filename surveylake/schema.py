"""Schema documents: declarative field lists that drive RAW -> PROCESSED casts.

A schema document is JSON:
``{"name", "title", "type", "fields": [{"name", "primary_key", "raw_type",
"master_type", "default"}], "config": {...}}``.  Documents are metadata (one
entry per column), so they are small and are handled on the driver; the data
they describe never is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import is_missing_path

# --- fixed values (must equal the source system's conventions) -------------
# Master type names and the Spark type each one lands as.
MASTER_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INT": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
}
# Default text written for a NULL primary-key value, by master type.
TYPE_DEFAULTS = {"INT64": "0", "FLOAT64": "0.0", "DATE": "0001-01-01"}
OTHER_DEFAULT = "X0"
# Column names (case-insensitive) that form the primary key of a survey sheet.
PRIMARY_KEY_NAMES = ("identificador_unico", "mes_encuesta")
# Month column of a survey sheet and its fallback spelling.
MONTH_COLUMN = "mes_encuesta"
MONTH_COLUMN_FALLBACK = "Mes_encuesta"
# ---------------------------------------------------------------------------


def default_for(master_type: str) -> str:
    return TYPE_DEFAULTS.get(master_type.upper(), OTHER_DEFAULT)


def is_primary_key(name: str, keys: tuple[str, ...] = PRIMARY_KEY_NAMES) -> bool:
    return name.lower() in keys


def spark_type(master_type: str) -> T.DataType:
    return MASTER_TYPES.get(master_type.upper(), T.StringType())


@dataclass(frozen=True)
class Field:
    name: str
    master_type: str = "STRING"
    primary_key: bool = False
    default: str | None = None
    raw_type: str = "str"

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.master_type)

    def to_json(self) -> dict:
        return {"name": self.name, "primary_key": "true" if self.primary_key else "false",
                "raw_type": self.raw_type, "master_type": self.master_type.upper(),
                "default": self.default if self.default is not None else default_for(self.master_type)}


@dataclass
class SchemaDocument:
    name: str
    fields: list[Field]
    config: dict = field(default_factory=dict)
    title: str = ""

    @property
    def primary_keys(self) -> list[str]:
        return [f.name for f in self.fields if f.primary_key]

    def struct(self, audit: bool = False) -> T.StructType:
        st = T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])
        if audit:
            st = st.add("USUARIO", T.StringType()).add("FECHA_CARGA", T.TimestampType())
        return st

    def raw_struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.fields])

    def to_json(self) -> dict:
        return {"name": self.name, "$schema": "http://json-schema.org/draft-07/schema#",
                "title": self.title, "type": "object",
                "fields": [f.to_json() for f in self.fields], "config": self.config}

    def dumps(self) -> str:
        return json.dumps(self.to_json(), indent=4)


def _truthy(v) -> bool:
    return str(v).strip().lower() == "true"


def document_from_dict(doc: dict) -> SchemaDocument:
    fields = [Field(name=f["name"], master_type=str(f.get("master_type", "STRING")).upper(),
                    primary_key=_truthy(f.get("primary_key", "false")),
                    default=f.get("default"), raw_type=f.get("raw_type", "str"))
              for f in doc.get("fields", [])]
    return SchemaDocument(name=doc.get("name", ""), fields=fields,
                          config=doc.get("config", {}) or {}, title=doc.get("title", ""))


def load_schema(spark: SparkSession, path: str, fallback: str | None = None) -> SchemaDocument:
    """Read a schema document from (shared) storage, else a fallback path.

    The document is read with Spark's JSON reader so any Hadoop filesystem
    works; its ``fields`` array is exploded and collected (one row per column,
    a bounded metadata read).
    """
    for p in [path, fallback]:
        if not p:
            continue
        try:
            raw = spark.read.option("multiLine", True).json(p)
        except AnalysisException as e:  # a missing path -> try the fallback; all else is an error
            if not is_missing_path(e):
                raise
            continue
        if "fields" not in raw.columns:
            continue
        head_cols = [c for c in ("name", "title") if c in raw.columns]
        head = raw.select(*head_cols).first().asDict() if head_cols else {}
        cfg_row = raw.select("config").first()[0] if "config" in raw.columns else None
        cfg = cfg_row.asDict(recursive=True) if cfg_row is not None else {}
        rows = (raw.select(F.posexplode("fields").alias("pos", "f"))
                .select("pos", "f.*").orderBy("pos").collect())
        doc = {"name": head.get("name") or "", "title": head.get("title") or "",
               "config": cfg or {},
               "fields": [r.asDict() for r in rows]}
        return document_from_dict(doc)
    raise FileNotFoundError(f"no schema document at {path!r} or {fallback!r}")


def dictionary_to_fields(df: DataFrame, type_column: str = "DATA_TYPE",
                         keys: tuple[str, ...] = PRIMARY_KEY_NAMES) -> DataFrame:
    """Wide schema dictionary -> one row per (table, column).

    Input: one column per table plus ``type_column``; a cell holds the name
    of that table's column for the row's type, blank/NULL when the table has
    no such column.  Output columns: table, column, master_type, primary_key,
    raw_type, default, ordinal (row order in the dictionary).
    """
    tables = [c for c in df.columns if c != type_column]
    with_pos = df.withColumn("ordinal", F.monotonically_increasing_id())
    long = with_pos.unpivot(["ordinal", type_column], tables, "table", "column")
    mt = F.upper(F.trim(F.col(type_column)))
    return (long.where(F.col("column").isNotNull() & (F.trim("column") != ""))
            .select("table", "column", mt.alias("master_type"),
                    F.lower("column").isin(*keys).alias("primary_key"),
                    F.lit("str").alias("raw_type"),
                    default_column(mt).alias("default"), "ordinal"))


def default_column(master_type: Column) -> Column:
    expr = F.lit(OTHER_DEFAULT)
    for t, v in reversed(list(TYPE_DEFAULTS.items())):
        expr = F.when(master_type == t, F.lit(v)).otherwise(expr)
    return expr


def documents_from_dictionary(df: DataFrame, type_column: str = "DATA_TYPE",
                              config: dict | None = None) -> list[SchemaDocument]:
    """Collect the (bounded: one row per column) field table into documents."""
    rows = dictionary_to_fields(df, type_column).orderBy("table", "ordinal").collect()
    docs: dict[str, SchemaDocument] = {}
    for r in rows:
        d = docs.setdefault(r["table"], SchemaDocument(r["table"], [], dict(config or {})))
        d.fields.append(Field(r["column"], r["master_type"], bool(r["primary_key"]), r["default"]))
    return list(docs.values())


def find_column(columns: list[str], wanted: str = MONTH_COLUMN,
                fallback: str | None = MONTH_COLUMN_FALLBACK) -> str | None:
    """Case-insensitive column lookup with a fallback name."""
    for c in columns:
        if c.lower() == wanted.lower():
            return c
    return fallback


def union_documents(first: SchemaDocument, second: SchemaDocument, name: str | None = None) -> SchemaDocument:
    """U2 (schema side): fields of ``first`` then fields of ``second`` whose
    name (case-insensitive) is new; the first document's type wins."""
    seen = {f.name.upper() for f in first.fields}
    fields = list(first.fields) + [f for f in second.fields if f.name.upper() not in seen]
    return SchemaDocument(name or first.name, fields, dict(first.config), first.title)
