"""The end-to-end loads, each a few lazy plans + writes.

The per-table loop runs on the driver over *configuration* rows (one per
table, a bounded list); every data step inside it is a distributed Spark
job.  Counts for the load log ride along the writes via ``observe``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import apply_schema, project_to_fields, reject_count_column
from ..functions.cleanse import (add_period, decode_base64_text, load_timestamp, malformed_period, stringify_frame,
                                 strip_prefixes, with_audit)
from ..operators.audit import dedup, observed, observed_rows
from ..operators.nested import (ROW_ID, DocumentLayout, conform_to_schema, decode_documents,
                               document_tables, rejected_rows, split_by_key)
from ..operators.union import union_all
from ..schema import SchemaDocument, find_column, union_documents
from ..session import drop_scratch, is_missing_path, scratch_path
from ..sinks import writers as W
from .incremental import Run, begin_run, end_run, finish_step
from .models import TARGET_COLUMNS, build_model


# --- C1: sheet -> RAW --------------------------------------------------------

def ingest_sheet(df: DataFrame, raw_path: str, export_base: str, name: str,
                 ts: dt.datetime | None = None, rejects: list | None = None) -> int:
    """Add ``Period`` (yyyyMM of the survey month), load RAW as text,
    and export the current and a timestamped history snapshot.

    The frame is persisted once so the three writes read the source once;
    returns the row count observed during the RAW write.  The number of month
    cells that hold text but give no period is appended to ``rejects``.
    """
    month = find_column(df.columns)
    out = add_period(df, month) if month in df.columns else df.withColumn("Period", F.lit(None).cast("string"))
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted, obs = observed(out)
        if rejects is not None and month in df.columns:
            bad = Observation(f"{name}_periods")
            counted = counted.observe(bad, F.count_if(malformed_period(F.col(f"`{month}`"))).alias("rejects"))
        W.write_raw(counted, raw_path, stringify=False)   # a sheet's cells are loaded as they are
        W.export_current(out, export_base, name)
        W.export_history(out, export_base, name, ts)
        if rejects is not None and month in df.columns:
            rejects.append(observed_rows(bad, "rejects"))
        return observed_rows(obs)
    finally:
        out.unpersist()


# --- C3/C4/C5: RAW -> PROCESSED -----------------------------------------------

@dataclass
class TableConfig:
    """One config row: destination name, the two RAW sources, their schemas."""
    name: str
    raw_path: str
    sql_path: str
    raw_schema: SchemaDocument
    sql_schema: SchemaDocument
    processed_path: str
    history_path: str
    export_base: str
    log_path: str
    domain: str = ""


def typed_sources(spark: SparkSession, cfg: TableConfig, strict: bool = True,
                  rejects: list | None = None) -> tuple[DataFrame, DataFrame, SchemaDocument]:
    """P7 + U2: both RAW sources cast by their schema documents into the
    union schema (first document wins a type, names case-insensitive).

    In lenient mode (``strict=False``) malformed cells become NULL; pass a
    list as ``rejects`` to receive one ``Observation`` per source counting
    them (filled by the first action on the frames, no extra scan)."""
    union = union_documents(cfg.raw_schema, cfg.sql_schema, cfg.name)
    out = []
    for path, schema in ((cfg.raw_path, cfg.raw_schema), (cfg.sql_path, cfg.sql_schema)):
        text = spark.read.parquet(path)
        if not strict and rejects is not None:
            obs = Observation(f"{schema.name}_rejects")
            text = text.observe(obs, F.coalesce(F.sum(reject_count_column(text, schema)), F.lit(0)).alias("rejects"))
            rejects.append(obs)
        out.append(project_to_fields(apply_schema(text, schema, strict), union.fields))
    return out[0], out[1], union


def append_history(raw: DataFrame, sql: DataFrame, path: str, user: str, load_ts: dt.datetime) -> None:
    """Both typed sources appended to ``<table>_HISTORY`` with audit columns."""
    W.append_audited(raw.unionByName(sql), path, user, load_ts)


def process_table(spark: SparkSession, cfg: TableConfig, user: str,
                  load_ts: dt.datetime | None = None, strict: bool = True,
                  export_snapshots: bool = False) -> dict:
    """History append, month replacement into PROCESSED, exports, log.

    The log count is the number of rows *read* from both sources (A2).
    ``export_snapshots`` also copies the whole PROCESSED and history tables to
    the export area, as the source system did each run: off by default, as a
    full copy per load grows with the table while the rest of the load grows
    only with the sources.

    Without a ``load_ts`` the load time is kept in the state table
    ``<log_path>_runs`` until the load is done: a load that failed is taken up
    again with the time it began with, and replaces what it left in history.
    """
    if load_ts is None:
        runs = f"{cfg.log_path.rstrip('/')}_runs"
        run = begin_run(spark, runs, f"{cfg.domain}/{cfg.name}")
        result = process_table(spark, cfg, user, run.load_ts, strict, export_snapshots)
        end_run(spark, runs, run)
        return result
    rejects: list = []
    raw, sql, union = typed_sources(spark, cfg, strict, rejects)
    # the (incremental) sources are read by the history append and by both
    # month-replace writes: cast them once
    raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    sql = sql.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = _process(spark, cfg, user, load_ts, raw, sql, union, export_snapshots)
        if rejects:
            result["rejected_cells"] = sum(observed_rows(o, "rejects") for o in rejects)
        return result
    finally:
        raw.unpersist()
        sql.unpersist()


def _process(spark, cfg, user, load_ts, raw, sql, union, export_snapshots):
    month = find_column([f.name for f in union.fields])
    raw_c, raw_obs = observed(raw, f"{cfg.name}_raw")
    sql_c, sql_obs = observed(sql, f"{cfg.name}_sql")
    append_history(raw_c, sql_c, cfg.history_path, user, load_ts)
    rows = observed_rows(raw_obs) + observed_rows(sql_obs)
    W.log_load(spark, cfg.log_path, cfg.domain, cfg.name, f"{cfg.name}_RawToProcessedHistory", rows, user, load_ts)
    W.replace_months(cfg.processed_path, [(with_audit(raw, user, load_ts), month),
                                          (with_audit(sql, user, load_ts), month)], load_ts)
    if export_snapshots:
        W.export_current(spark.read.parquet(cfg.processed_path), cfg.export_base, cfg.name)
        W.export_history(spark.read.parquet(cfg.history_path), cfg.export_base, cfg.name, load_ts)
    W.log_load(spark, cfg.log_path, cfg.domain, cfg.name, f"{cfg.name}_RawToProcessed", rows, user, load_ts)
    return {"table": cfg.name, "rows_read": rows}


# --- C6: documents -> RAW tables -----------------------------------------------

def run_document_etl(docs: DataFrame, layout: DocumentLayout, tables: Mapping[str, SchemaDocument],
                     raw_base: str, export_base: str, archive_name: str,
                     ts: dt.datetime | None = None, load_id: str | None = None,
                     strict: bool = False) -> dict[str, int]:
    """Decode once (written aside), then per output table conform to its field
    list (P19), stringify (P10), drop full-row duplicates (A3) and load RAW
    (K1), export CSV (K9); archive the payloads (K10) and the decoded XML
    (K11).  The returned counts are the records decoded (before
    de-duplication) per table, and under ``__rejected`` the documents that did
    not decode, which are kept as ``<raw_base>/<archive_name>_REJECTS``
    (``strict`` raises at the first of them).

    ``tables`` maps an element name of the layout (header / body / sub-body)
    to the schema document of its RAW table.  Every table is de-duplicated.
    Rows that hold their row id repeat only where documents share a key, so of
    those tables only the rows of such documents are shuffled.  A micro-batch
    or an API run passes its ``load_id``: every output then has its own
    partition or folder of that load, which a retry replaces.

    ``docs`` is read for the decode and for either archive; neither its texts
    nor the parsed documents are cached, as both outgrow memory and would lie
    uncompressed on the executors' disks.  The parsed documents are dropped
    before the archives are written.
    """
    ts = ts or load_timestamp()
    aside = scratch_path(docs.sparkSession, "parsed-documents")
    counts: dict[str, int] = {}
    raw = raw_base.rstrip("/")
    try:
        decoded = decode_documents(docs, layout, parsed_path=aside, strict=strict)
        alone, sharing = split_by_key(decoded["__parsed"])
        by_key = [(document_tables(part, layout), part is sharing) for part in (alone, sharing) if part is not None]
        for element, spec in tables.items():
            if element not in decoded:
                continue
            has_id = any(f.name.upper() == ROW_ID for f in spec.fields)
            parts, counters = [], []
            for found, may_repeat in by_key if has_id else [(decoded, True)]:
                out = stringify_frame(conform_to_schema(found[element], spec))
                counted, obs = observed(out, f"{spec.name}_rows_{len(parts)}")
                parts.append(dedup(counted) if may_repeat else counted)
                counters.append(obs)
            W.write_raw(union_all(parts), f"{raw}/{spec.name}", stringify=False, load_id=load_id)
            counts[spec.name] = sum(observed_rows(obs) for obs in counters)
            # the CSV is exported from the written table (lineage cut, no cache)
            W.export_csv(docs.sparkSession.read.parquet(W.raw_part(f"{raw}/{spec.name}", load_id)), export_base, spec.name, ts,
                         distinct=False, load_id=load_id)
        bad, bad_rows = observed(rejected_rows(decoded["__parsed"]), f"{archive_name}_rejects")
        W.write_raw(bad, f"{raw}/{archive_name}_REJECTS", stringify=False, load_id=load_id)
        counts["__rejected"] = observed_rows(bad_rows)
        drop_scratch(docs.sparkSession, aside)   # before the archives need its room
        W.archive_json(docs.select(F.col("payload").alias("interfaceValue")), export_base, archive_name, ts, load_id)
        xml = docs.select("doc_key", strip_prefixes(decode_base64_text("payload")).alias("xml"))
        W.archive_xml(xml, export_base, layout.sub_element, load=load_id or W.load_key(ts))
    finally:
        drop_scratch(docs.sparkSession, aside)
    return counts


def stream_document_etl(spark: SparkSession, landing: str, checkpoint: str, layout: DocumentLayout,
                        tables: Mapping[str, SchemaDocument], raw_base: str, export_base: str, archive_name: str,
                        glob: str = "*.xml", max_files_per_trigger: int | None = None, **options) -> int:
    """K12 + C6: every XML file not yet consumed goes through the document ETL,
    one micro-batch at a time; returns the number of files read.  RAW holds one
    partition per batch, named by the stream (the id that its checkpoint keeps)
    and the batch: batches add up, those of other streams and of API loads into
    the same RAW too, and a batch that is run again after a crash replaces what
    it wrote."""
    from ..streaming.landing import query_id, stream_documents

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_document_etl(batch, layout, tables, raw_base, export_base, archive_name,
                         load_id=f"{query_id(spark, checkpoint)}-{batch_id}")

    return stream_documents(spark, landing, checkpoint, handle, glob, max_files_per_trigger=max_files_per_trigger, **options)


# --- C7: publish the common data model ------------------------------------------

def publish_models(sources: Mapping[tuple[str, str], DataFrame], target: str, path: str,
                   org_codes: Mapping[str, str]) -> int:
    """C7, idempotent and incremental: the mapped rows replace the partitions of
    their (Domain, origin, survey month); other months stay, so a publish may
    carry the whole model or only the months that changed.

    Every partition has a digest of the rows last published to it, whatever
    their order, kept beside the model (``<path>_digests``).  One pass over the
    mapped rows computes the new ones; only partitions whose digest moved are
    written, and their number is returned: a repeated publish writes nothing.  A
    partition's digest is withdrawn before it is written, so a publish that
    fails half-way is made good by the next one.

    Rows without a month belong to no month that could be replaced.  They are
    merged with those published before: a row (all columns) is then held as
    often as it was, or as often as the publish brings it, whichever is more --
    so a re-run adds nothing and an incremental publish loses nothing.
    """
    spark = next(iter(sources.values())).sparkSession
    out = build_model(sources, target, org_codes, origin_column="origin")
    if "SurveyDate" in TARGET_COLUMNS[target]:
        month = F.col("SurveyDate")
    else:  # Period is 'yyyy-MM-dd' (sheet) or 'yyyyMM' (SQL export)
        p = F.col("Period")
        month = F.coalesce(F.try_to_date(F.substring(p, 1, 10), "yyyy-MM-dd"), F.try_to_date(p, "yyyyMM"))
    out = out.withColumn("survey_month", F.trunc(month, "MM"))
    keys = ["Domain", "origin", "survey_month"]
    held = _readable(spark, path, out.schema)
    digests = f"{path.rstrip('/')}_digests"
    schema = "Domain string, origin string, survey_month date, digest string, version long"
    known = _readable(spark, digests, schema) if held is not None else None
    if known is None:
        known = spark.createDataFrame([], schema)
    hashed = F.xxhash64(F.lit(0), *_exact(out))
    digest = F.concat_ws(":", F.count("*").cast("string"), F.sum(hashed.cast("decimal(38,0)")).cast("string"),
                         F.sum(F.xxhash64(hashed).cast("decimal(38,0)")).cast("string"))
    # a row for each domain, origin and month: bounded by the months there are
    now = out.groupBy(*keys).agg(digest.alias("digest"))
    last = known.groupBy(*keys).agg(F.max_by("digest", "version").alias("last"))
    same = [now[k].eqNullSafe(last[k]) for k in keys]
    moved = now.join(last, same, "left").where(~F.col("digest").eqNullSafe(F.col("last"))).select(*[now[k] for k in keys], "digest")
    aside = scratch_path(spark, "publish-moved")
    moved.write.mode("overwrite").parquet(aside)
    moved = spark.read.schema(moved.schema).parquet(aside)
    n, undated_moved = moved.agg(F.count("*"), F.count_if(F.col("survey_month").isNull())).first()
    if not n:
        return 0
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    stamp = lambda d, v: (moved.withColumn("digest", d).withColumn("version", F.lit(v).cast("long"))
                          .coalesce(1).write.mode("append").parquet(digests))
    stamp(F.lit(None).cast("string"), version)
    # 12 x 9,999 months of each domain and origin at most: may be sent to every task
    rows = out.where(F.col("survey_month").isNotNull()).join(F.broadcast(moved.select(*keys)), keys, "left_semi")
    if undated_moved:
        undated = out.where(F.col("survey_month").isNull()).join(
            F.broadcast(moved.where(F.col("survey_month").isNull()).select("Domain", "origin")), ["Domain", "origin"], "left_semi")
        if held is not None:
            undated = _at_least(undated, held.where(F.col("survey_month").isNull()).join(
                F.broadcast(moved.where(F.col("survey_month").isNull()).select("Domain", "origin")), ["Domain", "origin"], "left_semi")
                .select(*out.columns))
            # written aside first: the partitions it comes from are about to be replaced
            aside = scratch_path(spark, "publish-undated")
            undated.write.mode("overwrite").parquet(aside)
            undated = spark.read.schema(out.schema).parquet(aside)
        rows = rows.unionByName(undated)
    W.replace_partitions(rows, path, *keys)
    stamp(F.col("digest"), version + 1)
    return n


def _readable(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return None


def _exact(df: DataFrame) -> list:
    """What a row's hash is taken of: its columns, and which of them are null (a
    null is skipped by the hash)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [*cols, *(c.isNull() for c in cols)]


def _at_least(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every row of either frame, as often as in that which holds it more often.
    Rows meet by 128 bits of hash, counted before the shuffle."""
    names = a.columns

    def count(df: DataFrame, side: str) -> DataFrame:
        exact = _exact(df)
        return df.select(F.xxhash64(F.lit(0), *exact).alias("h"), F.xxhash64(F.lit(1), *exact).alias("g"),
                         F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.lit(side).alias("side"))

    both = count(a, "a").unionByName(count(b, "b"))
    n = lambda side: F.count_if(F.col("side") == side)
    counted = both.groupBy("h", "g").agg(F.first("row").alias("row"), F.greatest(n("a"), n("b")).alias("n"))
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")


# --- C5 over a domain: the config-driven loop -------------------------------------

def process_domain(spark: SparkSession, config: DataFrame, domain: str, base: str, schema_dir: str,
                   user: str, load_ts: dt.datetime | None = None, strict: bool = True,
                   export_snapshots: bool = False) -> list[dict]:
    """Every config row of ``domain`` (ordered by TABLA) loaded RAW ->
    PROCESSED.  ``TABLA`` is ``"<dest>;<raw>;<sql>"``; RAW tables live under
    ``<base>/<DATASET_STAGE>/``, PROCESSED under ``<base>/<DATASET_DESTINO>/``;
    schema documents are ``<schema_dir>/<table>.input.schema``.

    The loop runs over configuration rows (one per table: a bounded
    ``collect``); each table's load is distributed.  Without a ``load_ts`` the
    domain's run, with its one load time and the tables it has done, is kept in the state
    table ``<base>/log_runs``: after a crash the next call goes on with the
    unfinished table, under the time the run began with, and returns what it
    loaded itself.
    """
    from ..schema import load_schema
    from ..sources.config import load_config
    rows = load_config(config, domain).select("TABLA", "DATASET_STAGE", "DATASET_DESTINO").collect()
    b = base.rstrip("/")
    runs = f"{b}/log_runs"
    run = begin_run(spark, runs, domain) if load_ts is None else Run(domain, load_ts, frozenset())
    out = []
    for r in rows:
        if r["TABLA"] in run.done:
            continue
        dest, raw, sql = r["TABLA"].split(";")[:3]
        stage, target = f"{b}/{r['DATASET_STAGE']}", f"{b}/{r['DATASET_DESTINO']}"
        cfg = TableConfig(dest, f"{stage}/{raw}", f"{stage}/{sql}",
                          load_schema(spark, f"{schema_dir.rstrip('/')}/{raw}.input.schema"),
                          load_schema(spark, f"{schema_dir.rstrip('/')}/{sql}.input.schema"),
                          f"{target}/{dest}", f"{target}/{dest}_HISTORY", f"{b}/export", f"{b}/log", domain)
        out.append(process_table(spark, cfg, user, run.load_ts, strict, export_snapshots))
        if load_ts is None:
            finish_step(spark, runs, run, r["TABLA"])
    if load_ts is None:
        end_run(spark, runs, run)
    return out


def ingest_workbooks(spark: SparkSession, folders: Mapping[str, str], raw_base: str, export_base: str,
                     ts: dt.datetime | None = None, fmt: str = "csv", multi_line: bool = True,
                     split: bool = False) -> dict[str, int]:
    """S2 + C1: every worksheet export folder (survey workbook and SQL-export
    workbook alike) landed RAW with its Period and snapshots; returns the
    row count per sheet."""
    from ..sources.sheets import ingest_all
    return {name: ingest_sheet(df, f"{raw_base.rstrip('/')}/{name}", export_base, name, ts)
            for name, df in ingest_all(spark, folders, fmt, multi_line, split).items()}


def run_api_documents(spark: SparkSession, landing: str, layout: DocumentLayout,
                      tables: Mapping[str, SchemaDocument], raw_base: str, export_base: str,
                      state_path: str, source: str, defaults: Mapping[str, str] | None = None,
                      today: dt.date | None = None, multi_line: bool = True, glob: str = "*.json") -> dict[str, int]:
    """C8 + C6 + C9 + K13 ("api" load): the request window comes from the
    saved cursor (or ``defaults``).  The API responses landed under ``landing``
    before the window's end, and not before the first window's start, that no
    load has consumed yet are decoded and loaded RAW: also a file that came, or
    was stamped, later than the window it belongs to.  A file with another
    length or time is another file.

    RAW has one partition per load (``<source>-<number>``), beside those of
    other loads.  Without new files nothing is written and the cursor stays;
    the counts are empty.  Broken responses and documents are in the reject
    table before anything moves.  Then the files are entered into the ledger
    beside the state table, and the cursor moves to the window's end.  A run
    that fails anywhere is taken up by the next one under the same number.
    """
    from ..sources.documents import landed_files, literal_path, read_envelope
    from . import incremental as I
    cfg = {**(defaults or {}), **I.load_watermark(spark, state_path, source)}
    w = I.request_window(cfg, today)
    cfg.setdefault(I.FLOOR_KEY, w.start.isoformat())
    ledger = f"{state_path.rstrip('/')}_files"
    files = I.new_files(spark, landed_files(spark, landing, glob), ledger, source,
                        dt.datetime.fromisoformat(cfg[I.FLOOR_KEY]), w.end)
    # the names of one load's new files: what Spark's own file listing holds on the driver too
    found = files.collect()
    if not found:
        return {}
    number = I.next_load(spark, ledger, source)
    docs = read_envelope(spark, [literal_path(r["path"]) for r in found], "*", multi_line)
    counts = run_document_etl(docs, layout, tables, raw_base, export_base, source, load_id=f"{source}-{number}")
    I.enter_files(spark.createDataFrame(found, "path string, length long, modified long"), ledger, source, number)
    I.save_watermark(spark, state_path, source, I.advance_watermark(cfg, w, today))
    return counts
