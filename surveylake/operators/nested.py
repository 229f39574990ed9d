"""Documents (XML inside base64) -> header / body / sub-body rows.

A document holds a root element with one or many ``sub_element`` children;
each child has header elements (merged into one header row), body elements
(0, 1 or many) and, inside each body element, sub-body elements (0, 1 or
many).  The whole decode is column expressions over one DataFrame of
documents: base64 -> text -> namespace-prefix strip -> ``from_xml`` with a
declared schema (a single child and a list of children both parse to an
array, so the object-vs-list branches collapse into one) -> ``posexplode``.

Ids are deterministic (``sha2`` of the document key and the positions), so a
recomputed task yields the same ids and parent/child links hold even when an
executor is lost and its partitions are rebuilt from lineage.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleanse import camel_name, decode_base64_text, strip_offset, strip_prefixes
from ..schema import Field, SchemaDocument
from ..session import scratch_path

# --- fixed values -----------------------------------------------------------
# Column names the decoded tables carry.
DOC_ID = "DOCUMENTE_XML_ID"
ROW_ID = "UUID"
HEAD_ID = "UUID_HEAD"
BODY_ID = "UUID_BODY"
TRANSMIT = "TRANSMITDATE"
INVOICE = "INVOICEDATE"
CT_SUFFIX = "_CT"
WORK_ORDER = "WORKORDERNUMBER"
WORK_ORDER_HEADER = "WORKORDERNUMBER_HEADER"
# ----------------------------------------------------------------------------
SHARED_KEYS = 1_000_000   # hashes of document keys that may be sent to every task (8 bytes each)
# of parsed documents written aside; a level that takes little time beside the parser's
SCRATCH_PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.compression.codec.zstd.level": "6"}
CORRUPT = "_corrupt_record"   # where the XML parser puts a document that is broken anywhere


@dataclass
class DocumentLayout:
    """Which elements form the header, body and sub-body tables.

    ``schema`` is the Spark schema of ONE ``sub_element`` child (a struct);
    body elements must be declared ``ARRAY<STRUCT<...>>`` and sub-body
    elements ``ARRAY<STRUCT<...>>`` inside the body struct.
    """
    element_name: str
    sub_element: str
    tables_header: list[str]
    tables_body: list[str]
    tables_sub_body: list[str]
    schema: T.StructType
    extra: dict = field(default_factory=dict)
    # True: let the XML parser drop every namespace prefix (measured ~20%
    # faster than the text strip).  False (default): strip only the
    # configured prefixes, exactly as the source system did.
    ignore_namespace: bool = False

    def document_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.sub_element, T.ArrayType(self.schema), True)])


def row_id(*parts: Column | str) -> Column:
    """Deterministic id = sha2 of the '|'-joined key parts."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256)


def document_id(key: str) -> Column:
    return F.sha2(F.col(key).cast("string"), 256)


def parse_documents(docs: DataFrame, layout: DocumentLayout, payload: str = "payload",
                    base64: bool = True, key: str = "doc_key", repartition: int | None = None,
                    strict: bool = False) -> DataFrame:
    """N1 + P21 + P24: (doc_key, payload) -> (doc_key, DOC_ID, parsed struct,
    reason, rejected payload).

    A document counts as a whole or not at all: one that does not decode (bad
    base64, XML that is broken anywhere, text after the root, no child) has no
    rows in the tables; ``reason`` names the step that failed (``base64``,
    ``xml``, or what the reader of ``docs`` put into its own column ``reason``)
    and ``rejected`` keeps the payload.  ``strict`` raises at it.
    ``repartition`` spreads the documents of a few small files over so many
    tasks, as parsing is bound by the CPU.
    """
    if repartition:
        docs = docs.repartition(repartition)
    text = decode_base64_text(payload) if base64 else F.col(payload)
    shape = layout.document_schema().add(CORRUPT, T.StringType())
    if layout.ignore_namespace:
        parsed = F.from_xml("text", shape, {"ignoreNamespace": "true", "columnNameOfCorruptRecord": CORRUPT})
    else:
        parsed = F.from_xml(strip_prefixes("text"), shape, {"columnNameOfCorruptRecord": CORRUPT})
    known = F.col("reason") if "reason" in docs.columns else F.lit(None).cast("string")
    tried = docs.select(F.col(key).alias("doc_key"), F.col(payload).alias("payload"), known.alias("known"), text.alias("text"))
    tried = tried.select("doc_key", "payload", "known", _after_root("text", layout).alias("more"),
                         F.col("text").isNull().alias("no_text"), parsed.alias("doc"))
    kids = F.col("doc").getField(layout.sub_element)
    broken = F.col("doc").getField(CORRUPT).isNotNull() | F.col("more") | kids.isNull() | (F.size(kids) == 0)
    reason = F.coalesce("known", F.when(F.col("no_text"), "base64").when(broken, "xml"))
    out = tried.select("doc_key", "payload", "doc", reason.alias("reason"))
    whole = F.when(F.col("reason").isNull(), F.col("doc"))
    if strict:
        whole = whole.otherwise(F.raise_error(F.concat(F.lit("document does not decode: "), F.col("doc_key").cast("string"))))
    return out.select("doc_key", document_id("doc_key").alias(DOC_ID), whole.alias("doc"), "reason",
                      F.when(F.col("reason").isNotNull(), F.col("payload")).alias("rejected"))


def _after_root(text: str, layout: DocumentLayout) -> Column:
    """Whether anything but comments and processing instructions follows the
    root's end: the parser stops there and would not see it."""
    rest = F.regexp_extract(text, rf"(?s)</(?:[\w.-]+:)?{re.escape(layout.element_name)}\s*>\s*(\S.*)$", 1)
    return F.coalesce(F.regexp_replace(rest, r"(?s)<!--.*?-->|<\?.*?\?>|\s+", "") != "", F.lit(False))


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """(doc_key, payload, reason) of the documents that ``parse_documents``
    rejected.  (An outer explode again: a filter would be pushed below the parser.)"""
    row = F.struct("doc_key", F.col("rejected").alias("payload"), "reason")
    rows = parsed.select(F.explode_outer(F.when(F.col("reason").isNotNull(), F.array(row))).alias("r"))
    return rows.where(F.col("r").isNotNull()).select("r.*")


def rejected_documents(docs: DataFrame, layout: DocumentLayout, payload: str = "payload", base64: bool = True,
                       key: str = "doc_key") -> DataFrame:
    """(doc_key, payload, reason): documents that give no row, with the step
    that failed."""
    return rejected_rows(parse_documents(docs, pruned(layout, layout.tables_header or None), payload, base64, key))


def _flatten(struct: Column, dtype: T.StructType, prefix: str = "",
             first_of_lists: bool = True) -> list[tuple[str, Column]]:
    """Nested struct -> [(dotted name, column)]; an array field gives
    its first element (NULL when empty), then is flattened in turn."""
    out: list[tuple[str, Column]] = []
    for f in dtype.fields:
        name = f"{prefix}.{f.name}" if prefix else f.name
        c = struct.getField(f.name)
        t = f.dataType
        if isinstance(t, T.ArrayType) and first_of_lists:
            c, t = F.get(c, 0), t.elementType
        if isinstance(t, T.StructType):
            out.extend(_flatten(c, t, name, first_of_lists))
        elif isinstance(t, T.ArrayType):
            out.append((name, F.to_json(c)))
        else:
            out.append((name, c))
    return out


def flat_columns(struct: Column, dtype: T.StructType, skip: Sequence[str] = ()) -> dict[str, Column]:
    """Flatten, camel-case and upper-case (N3, P22, P23); later names win."""
    out: dict[str, Column] = {}
    for name, c in _flatten(struct, dtype):
        if name.split(".")[0] in skip:
            continue
        out[camel_name(name).upper()] = c
    return out


def flatten_struct(df: DataFrame, column: str, sep_camel: bool = True) -> DataFrame:
    """N3 as a frame operator: replace a struct column by its flat fields."""
    dtype = df.schema[column].dataType
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    flat = _flatten(F.col(f"`{column}`"), dtype)
    return df.select(*others, *[c.alias(camel_name(n) if sep_camel else n) for n, c in flat])


def explode_prefixed(df: DataFrame, column: str) -> DataFrame:
    """One row per element of a list-of-structs column, element fields
    named ``<column>.<field>``.  A NULL list keeps its row (fields NULL); an
    empty list drops the row."""
    c = F.col(f"`{column}`")
    elem = df.schema[column].dataType.elementType
    others = [F.col(f"`{x}`") for x in df.columns if x != column]
    kept = df.where(c.isNull() | (F.size(c) > 0))
    e = kept.select(*others, F.explode_outer(c).alias("__e"))
    return e.select(*others, *[F.col("__e").getField(f.name).alias(f"{column}.{f.name}")
                               for f in elem.fields])


def children(parsed: DataFrame, layout: DocumentLayout) -> DataFrame:
    """(doc_key, DOC_ID, sub_pos, sub) -- one row per sub_element child.

    The outer explode keeps the optimizer from inferring a filter on the parsed
    list, which it would push below the parser and parse every document twice."""
    kids = parsed.select("doc_key", DOC_ID, F.posexplode_outer(F.col("doc").getField(layout.sub_element))
                         .alias("sub_pos", "sub"))
    return kids.where(F.col("sub_pos").isNotNull())


def header_rows(parsed: DataFrame, layout: DocumentLayout, subs: DataFrame | None = None) -> DataFrame:
    """One header row per sub_element child: header elements merged (a
    later element wins a name clash), ids, and the offset strip of the
    transmit / invoice dates with the original kept in ``*_CT``."""
    subs = children(parsed, layout) if subs is None else subs
    cols: dict[str, Column] = {}
    sch = layout.schema
    for h in layout.tables_header:
        if h not in sch.fieldNames():
            continue
        t = sch[h].dataType
        if isinstance(t, T.ArrayType):
            c, t = F.get(F.col("sub").getField(h), 0), t.elementType
        else:
            c = F.col("sub").getField(h)
        if isinstance(t, T.StructType):
            cols.update(flat_columns(c, t))
        else:
            cols[h.upper()] = c
    if TRANSMIT in cols:
        cols[TRANSMIT + CT_SUFFIX] = cols[TRANSMIT]
        cols[TRANSMIT] = strip_offset(cols[TRANSMIT])
    if INVOICE in cols:
        cols[INVOICE + CT_SUFFIX] = cols[INVOICE]
        cols[INVOICE] = strip_offset(cols[INVOICE])
    if WORK_ORDER in cols:
        cols[WORK_ORDER_HEADER] = cols[WORK_ORDER]
    return subs.select("doc_key", "sub_pos", "sub", DOC_ID,
                       row_id("doc_key", "sub_pos").alias(ROW_ID),
                       *[c.alias(n) for n, c in cols.items()])


def _header_names(header: DataFrame) -> list[str]:
    return [c for c in header.columns if c not in ("doc_key", "sub_pos", "sub")]


def body_rows(header: DataFrame, layout: DocumentLayout, body: str) -> DataFrame:
    """One row per body element; header columns are added and win a
    name clash, except the work order: a body value replaces the header's,
    whose own value is kept in ``WORKORDERNUMBER_HEADER``."""
    t = layout.schema[body].dataType
    elem = t.elementType if isinstance(t, T.ArrayType) else t
    arr = F.col("sub").getField(body)
    if not isinstance(t, T.ArrayType):
        arr = F.when(arr.isNotNull(), F.array(arr))
    hnames = _header_names(header)
    e = header.select(*[F.col(f"`{c}`") for c in ["doc_key", "sub_pos"] + hnames],
                      F.posexplode(arr).alias("body_pos", "body"))
    bcols = flat_columns(F.col("body"), elem)
    cols: dict[str, Column] = dict(bcols)
    for h in hnames:
        if h in (ROW_ID,):
            continue
        cols[h] = F.col(f"`{h}`")
    if WORK_ORDER in bcols and WORK_ORDER in hnames:
        cols[WORK_ORDER] = F.coalesce(bcols[WORK_ORDER], F.col(WORK_ORDER))
    cols[HEAD_ID] = F.col(ROW_ID)
    # the element's name keeps rows of two body tables at one position apart
    cols[ROW_ID] = row_id("doc_key", "sub_pos", F.lit(body), "body_pos")
    return e.select("doc_key", "sub_pos", "body_pos", "body", *[c.alias(n) for n, c in cols.items()])


def sub_body_rows(body_df: DataFrame, layout: DocumentLayout, body: str, sub_body: str) -> DataFrame:
    """One row per sub-body element; body (and header) columns are added
    and win a name clash; the sub-body list column itself is set to ''."""
    bt = layout.schema[body].dataType
    belem = bt.elementType if isinstance(bt, T.ArrayType) else bt
    if sub_body not in belem.fieldNames():
        return None
    st = belem[sub_body].dataType
    selem = st.elementType if isinstance(st, T.ArrayType) else st
    arr = F.col("body").getField(sub_body)
    if not isinstance(st, T.ArrayType):
        arr = F.when(arr.isNotNull(), F.array(arr))
    bnames = [c for c in body_df.columns if c not in ("doc_key", "sub_pos", "body_pos", "body")]
    e = body_df.select(*[F.col(f"`{c}`") for c in ["doc_key", "sub_pos", "body_pos"] + bnames],
                       F.posexplode(arr).alias("sb_pos", "sb"))
    cols: dict[str, Column] = dict(flat_columns(F.col("sb"), selem))
    for b in bnames:
        if b == ROW_ID:
            continue
        cols[b] = F.col(f"`{b}`")
    cols[sub_body] = F.lit("")
    cols[BODY_ID] = F.col(ROW_ID)
    cols[ROW_ID] = row_id(ROW_ID, F.lit(sub_body), "sb_pos")
    return e.select(*[c.alias(n) for n, c in cols.items()])


def pruned(layout: DocumentLayout, tables: Sequence[str] | None) -> DocumentLayout:
    """The layout restricted to what ``tables`` need.  ``from_xml`` builds
    every declared field (its schema is not pruned by the optimizer), so a
    header-only decode must not declare the body lists at all."""
    if not tables or any(t in layout.tables_body or t in layout.tables_sub_body for t in tables):
        return layout
    keep = [f for f in layout.schema.fields if f.name not in layout.tables_body]
    return DocumentLayout(layout.element_name, layout.sub_element, layout.tables_header, [], [],
                          T.StructType(keep), dict(layout.extra), layout.ignore_namespace)


def decode_documents(docs: DataFrame, layout: DocumentLayout, payload: str = "payload",
                     base64: bool = True, key: str = "doc_key",
                     tables: Sequence[str] | None = None,
                     parsed_path: str | None = None, repartition: int | None = None,
                     strict: bool = False) -> dict[str, DataFrame]:
    """Every header, body and sub-body table of the layout (or only
    ``tables``, parsing only the elements those need).

    Returns ``{table_name: DataFrame}``; header tables share one frame (one
    header row per child).  Callers that write several tables pass a
    ``parsed_path``: the documents are parsed once and written there
    (compressed, unlike a cached frame's blocks; without their id, a hash that
    does not compress and is computed again), and every table reads the columns
    it needs from there; the caller drops the folder when done.
    """
    layout = pruned(layout, tables)
    parsed = parse_documents(docs, layout, payload, base64, key, repartition, strict)
    if parsed_path:
        names, kept = parsed.columns, parsed.drop(DOC_ID)
        kept.write.mode("overwrite").options(**SCRATCH_PARQUET).parquet(parsed_path)
        kept = parsed.sparkSession.read.schema(kept.schema).parquet(parsed_path)
        parsed = kept.withColumn(DOC_ID, document_id("doc_key")).select(*names)
    return document_tables(parsed, layout)


def document_tables(parsed: DataFrame, layout: DocumentLayout) -> dict[str, DataFrame]:
    """N11 over documents that ``parse_documents`` has parsed."""
    return _tables(parsed, layout, header_rows(parsed, layout))


def split_by_key(parsed: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(documents that share their key with no other, documents that may share it).

    Row ids are made of the document's key (N10), so equal rows that hold their
    id come from documents of one key, and only the second part can have any.
    Keys are counted by hash, nothing else is shuffled; two keys that meet in a
    hash are taken to be shared, as are all beyond ``SHARED_KEYS`` shared ones.
    """
    keyed = parsed.withColumn("key_hash", F.xxhash64("doc_key"))
    shared = keyed.groupBy("key_hash").agg(F.count("*").alias("n")).where("n > 1").select("key_hash")
    spark = parsed.sparkSession
    written = scratch_path(spark, "shared-keys")
    shared.write.mode("overwrite").parquet(written)
    shared = spark.read.schema(shared.schema).parquet(written)
    n = shared.count()
    if not n:
        return parsed, None
    if n > SHARED_KEYS:
        return None, parsed
    return tuple(keyed.join(F.broadcast(shared), "key_hash", how).drop("key_hash") for how in ("left_anti", "left_semi"))


def read_xml_children(spark, path: str, layout: DocumentLayout, glob: str = "*.xml", strict: bool = False) -> DataFrame:
    """S5 for large files: Spark's XML reader with ``rowTag`` = the child
    element splits big files and yields one row per child, namespaces
    ignored (the prefix strip of P21).  A child's position is not known on
    this path, so its id part is a hash of its content and its number among
    the equal children of its file: no two children share an id.  A broken
    child has its text in ``rejected`` and gives no rows (``strict`` raises)."""
    from ..sources.documents import with_number
    df = (spark.read.format("xml").option("rowTag", layout.sub_element).option("ignoreNamespace", True)
          .option("pathGlobFilter", glob).option("recursiveFileLookup", True)
          .schema(T.StructType([*layout.schema.fields, T.StructField(CORRUPT, T.StringType())]))
          .option("columnNameOfCorruptRecord", CORRUPT).load(path))
    sub = F.struct(*[F.col(f"`{f.name}`") for f in layout.schema.fields])
    sub = F.when(F.col(CORRUPT).isNull(), sub)
    if strict:
        sub = sub.otherwise(F.raise_error(F.concat(F.lit("broken child: "), F.col(CORRUPT))))
    rows = df.select(F.col("_metadata.file_path").alias("doc_key"), F.sha2(F.col("_metadata.file_path"), 256).alias(DOC_ID),
                     F.col(CORRUPT).alias("rejected"), sub.alias("sub"))
    keyed = with_number(rows, "doc_key", F.sha2(F.coalesce(F.to_json("sub"), "rejected"), 256))
    return keyed.select("doc_key", DOC_ID, F.concat_ws("#", "content", F.col("number").cast("string")).alias("sub_pos"),
                        "sub", "rejected")


def decode_children(subs: DataFrame, layout: DocumentLayout,
                    tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """N11 over child rows from ``read_xml_children``."""
    layout = pruned(layout, tables)
    subs = subs.where(F.col("rejected").isNull())
    return _tables(subs, layout, header_rows(None, layout, subs))


def _tables(parsed: DataFrame, layout: DocumentLayout, header: DataFrame) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {"__parsed": parsed}
    hcols = [c for c in header.columns if c not in ("sub",)]
    for h in layout.tables_header:
        out[h] = header.select(*[F.col(f"`{c}`") for c in hcols if c not in ("doc_key", "sub_pos")])
    for b in layout.tables_body:
        if b not in layout.schema.fieldNames():
            continue
        bdf = body_rows(header, layout, b)
        out[b] = bdf.drop("doc_key", "sub_pos", "body_pos", "body")
        for s in layout.tables_sub_body:
            sdf = sub_body_rows(bdf, layout, b, s)
            if sdf is not None:
                # a sub-body element may hang below several body elements
                out[s] = out[s].unionByName(sdf, allowMissingColumns=True) if s in out else sdf
    return out


def conform_to_schema(df: DataFrame, spec: SchemaDocument | Sequence[Field]) -> DataFrame:
    """Project rows to a field list: a field the rows lack is NULL, a
    non-text value becomes text, a NULL primary key takes its default."""
    fields = spec.fields if isinstance(spec, SchemaDocument) else list(spec)
    exact = set(df.columns)
    lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in fields:
        src = f.name if f.name in exact else lower.get(f.name.lower())
        c = F.col(f"`{src}`").cast("string") if src else F.lit(None).cast("string")
        if f.primary_key and f.default is not None:
            c = F.coalesce(c, F.lit(f.default))
        cols.append(c.alias(f.name))
    return df.select(*cols)
