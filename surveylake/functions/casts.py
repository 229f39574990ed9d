"""Text -> typed casts driven by a master type.

All casts are built-in column expressions (they stay inside whole-stage
codegen).  ``strict`` mirrors the source system: INT64, DATE and BOOL raise on
a malformed value, FLOAT64 is a safe cast (bad -> NULL), DATETIME accepts a
fixed list of shapes and gives NULL for any other text.  Strictness does not
depend on ``spark.sql.ansi.enabled``: a failed parse is turned into
``raise_error`` explicitly.  ``strict=False`` (lenient) gives NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import Field, SchemaDocument

# --- fixed values -----------------------------------------------------------
# Accepted DATETIME text shapes, in order (all anchored, no trimming).
DATETIME_SHAPES = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}Z$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$",
)
DATE_FORMAT = "yyyy-M-d"   # one- or two-digit month and day
FLOAT_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
BLANK = r"(?U)^[\s\u00A0\u2007\u202F\uFEFF]*$"
INT_TEXT = r"^\s*[+-]?\d+\s*$"
BOOL_TEXT = ("true", "false")
# ----------------------------------------------------------------------------

DATETIME_PATTERN = "|".join(f"(?:{s})" for s in DATETIME_SHAPES)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """Nothing but white space, tabs and no-break spaces included (a NULL is
    not blank; it stays NULL on its own)."""
    return _c(c).rlike(BLANK)


def _fail(kind: str, c: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"malformed {kind} value: '"), c, F.lit("'")))


def _guard(parsed: Column, c: Column, kind: str, strict: bool) -> Column:
    if not strict:
        return parsed
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(parsed, _fail(kind, c)))


def cast_int(c: str | Column, strict: bool = True) -> Column:
    """P1 INT64: blank -> NULL, else integer cast (strict raises on junk).

    Text that is not an integer never reaches the cast: Spark's string ->
    long conversion fails through an exception per row, which made junk
    cells ~10x slower than good ones.  Overflow still goes through
    ``try_cast`` (NULL / raise)."""
    c = _c(c)
    parsed = F.when(c.rlike(INT_TEXT), c.try_cast("bigint"))
    return F.when(is_blank(c), F.lit(None).cast("bigint")).otherwise(_guard(parsed, c, "INT64", strict))


def cast_float(c: str | Column) -> Column:
    """P2 FLOAT64: blank -> NULL, else safe cast (malformed -> NULL).  Text is
    checked first: a bare Spark cast would take Java suffixes (``1.5d``)."""
    c = _c(c)
    return F.when(c.rlike(FLOAT_TEXT), c.try_cast("double"))


def cast_numeric(c: str | Column) -> Column:
    """P13 NUMERIC: decimal(38,9) (rounds to 9 places); malformed -> NULL."""
    c = _c(c)
    return F.when(c.rlike(FLOAT_TEXT), c.try_cast(T.DecimalType(38, 9)))


def cast_date(c: str | Column, strict: bool = True) -> Column:
    """P3 DATE: blank -> NULL, else year-month-day, month and day of one or two
    digits (strict raises on junk)."""
    c = _c(c)
    return F.when(is_blank(c), F.lit(None).cast("date")).otherwise(
        _guard(F.try_to_date(c, DATE_FORMAT), c, "DATE", strict))


def cast_datetime(c: str | Column, strict: bool = True) -> Column:
    """P4 DATETIME: text of an accepted shape -> TIMESTAMP_NTZ, else NULL.

    A trailing ``Z`` is dropped, not converted (the value is zone-less).  A
    value of an accepted shape that is not a real instant (month 13) raises
    in strict mode and is NULL in lenient mode.
    """
    c = _c(c)
    canon = F.regexp_replace(F.regexp_replace(c, "Z$", ""), "T", " ")
    parsed = canon.try_cast(T.TimestampNTZType())
    return F.when(c.rlike(DATETIME_PATTERN), _guard(parsed, c, "DATETIME", strict)).otherwise(
        F.lit(None).cast(T.TimestampNTZType()))


def cast_bool(c: str | Column, strict: bool = True) -> Column:
    """P5 BOOL: blank -> NULL, 'true'/'false' in any case, else raise (strict)
    or NULL (lenient).  A bare Spark cast would also accept t/yes/1."""
    c = _c(c)
    low = F.lower(c)
    out = (F.when(is_blank(c), F.lit(None).cast("boolean"))
           .when(low == BOOL_TEXT[0], F.lit(True))
           .when(low == BOOL_TEXT[1], F.lit(False)))
    if strict:
        return out.when(c.isNotNull(), _fail("BOOL", c)).otherwise(F.lit(None).cast("boolean"))
    return out.otherwise(F.lit(None).cast("boolean"))


def cast_for(c: str | Column, master_type: str, strict: bool = True) -> Column:
    """P1-P6 dispatch by master type; STRING and unknown types pass through."""
    t = master_type.upper()
    if t in ("INT64", "INT", "INTEGER"):
        return cast_int(c, strict)
    if t == "FLOAT64":
        return cast_float(c)
    if t == "NUMERIC":
        return cast_numeric(c)
    if t == "DATE":
        return cast_date(c, strict)
    if t == "DATETIME":
        return cast_datetime(c, strict)
    if t in ("BOOL", "BOOLEAN"):
        return cast_bool(c, strict)
    return _c(c)


def resolve(columns: list[str], name: str) -> str | None:
    """Case-insensitive lookup of ``name`` among ``columns``."""
    low = name.lower()
    for c in columns:
        if c.lower() == low:
            return c
    return None


def apply_schema(df: DataFrame, schema: SchemaDocument | list[Field], strict: bool = True,
                 missing_as_null: bool = True) -> DataFrame:
    """Cast every field of the schema, by name (case-insensitive).

    Output columns follow the schema's order and spelling.  A field the frame
    lacks becomes a typed NULL (``missing_as_null``) or raises; a primary-key
    field must be there (without its month column a load would replace nothing).
    """
    fields = schema.fields if isinstance(schema, SchemaDocument) else schema
    cols = []
    for f in fields:
        src = resolve(df.columns, f.name)
        if src is None:
            if f.primary_key or not missing_as_null:
                raise KeyError(f"column {f.name!r} not in frame")
            cols.append(F.lit(None).cast(f.spark_type).alias(f.name))
            continue
        cols.append(cast_for(F.col(f"`{src}`"), f.master_type, strict).cast(f.spark_type).alias(f.name))
    return df.select(*cols)


def project_to_fields(df: DataFrame, schema: SchemaDocument | list[Field]) -> DataFrame:
    """Select an already-typed frame into a field list by name
    (case-insensitive): present columns are cast to the field's type,
    missing ones are typed NULLs.  No text parsing happens here."""
    fields = schema.fields if isinstance(schema, SchemaDocument) else schema
    cols = []
    for f in fields:
        src = resolve(df.columns, f.name)
        c = F.col(f"`{src}`") if src else F.lit(None)
        cols.append(c.cast(f.spark_type).alias(f.name))
    return df.select(*cols)


def reject_count_column(df: DataFrame, schema: SchemaDocument | list[Field]) -> Column:
    """Number of non-blank cells in a row that a lenient cast turns into NULL."""
    fields = schema.fields if isinstance(schema, SchemaDocument) else schema
    terms = []
    for f in fields:
        src = resolve(df.columns, f.name)
        if src is None or f.master_type.upper() in ("STRING",):
            continue
        c = F.col(f"`{src}`")
        bad = c.isNotNull() & ~is_blank(c) & cast_for(c, f.master_type, strict=False).isNull()
        terms.append(bad.cast("int"))
    if not terms:
        return F.lit(0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total
