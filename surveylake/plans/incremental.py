"""Incremental request windows and the load watermark.

The source system asked an HTTP API for a date window.  Here the same window
is a predicate on a table or stream (it reaches the parquet scan as a pushed
filter), and the cursor is kept in a small state table after a successful load:
the next window starts where the last one ended.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleanse import load_timestamp, ntz_lit, ts_lit
from ..session import is_missing_path

# --- fixed values -----------------------------------------------------------
START_KEY = "fecinicio_query"
END_KEY = "fecfin_query"
START_HOUR_KEY = "horainicio_query"
END_HOUR_KEY = "horafin_query"
INTERFACE_KEY = "interfaz_query"
DATE_FMT = "%Y%m%d"
DEFAULT_LOOKBACK_DAYS = 30
RESTART_LOOKBACK_DAYS = 1
CURSOR_KEY = "cursor"   # end of the last loaded window, ISO time
FLOOR_KEY = "floor"     # start of the first window, ISO time: older files are not asked for
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Window:
    start: dt.datetime
    end: dt.datetime
    interface: str | None = None


def _at(day: dt.date, hour: str | None) -> dt.datetime:
    t = dt.time.fromisoformat(hour) if hour else dt.time(0, 0)
    return dt.datetime.combine(day, t)


def request_window(cfg: dict, today: dt.date | None = None) -> Window:
    """Configured [start, end); a start equal to today moves back one
    day; with no configured window, the last 30 days up to today.  Once a load
    has saved its cursor the window runs from there up to today, and never ends
    before the cursor, whatever the clock says."""
    today = today or load_timestamp().date()
    if cfg.get(CURSOR_KEY):
        start = dt.datetime.fromisoformat(cfg[CURSOR_KEY])
        end = max(_at(today, None), start)
        if start >= end:
            start = end - dt.timedelta(days=RESTART_LOOKBACK_DAYS)
        return Window(start, end, cfg.get(INTERFACE_KEY))
    if cfg.get(START_KEY) and cfg.get(END_KEY) and cfg.get(INTERFACE_KEY):
        start = dt.datetime.strptime(cfg[START_KEY], DATE_FMT).date()
        if start == today:
            start = today - dt.timedelta(days=RESTART_LOOKBACK_DAYS)
        end = dt.datetime.strptime(cfg[END_KEY], DATE_FMT).date()
        return Window(_at(start, cfg.get(START_HOUR_KEY)), _at(end, cfg.get(END_HOUR_KEY)), cfg[INTERFACE_KEY])
    start = today - dt.timedelta(days=DEFAULT_LOOKBACK_DAYS)
    return Window(_at(start, cfg.get(START_HOUR_KEY)), _at(today, cfg.get(END_HOUR_KEY)), cfg.get(INTERFACE_KEY))


def incremental_window(df: DataFrame, ts_column: str, window: Window) -> DataFrame:
    """Rows with ``start <= ts < end`` (literal bounds -> parquet pushdown)."""
    c = F.col(f"`{ts_column}`")
    lo, hi = ntz_lit(window.start), ntz_lit(window.end)
    return df.where((c >= lo) & (c < hi))


def advance_watermark(cfg: dict, window: Window, today: dt.date | None = None) -> dict:
    """After a successful load the next window starts where this one ended;
    the cursor never moves back."""
    out = dict(cfg)
    end = window.end
    if cfg.get(CURSOR_KEY):
        end = max(end, dt.datetime.fromisoformat(cfg[CURSOR_KEY]))
    out[CURSOR_KEY] = end.isoformat()
    out[START_KEY] = end.strftime(DATE_FMT)
    out["actual_load_date"] = (today or load_timestamp().date()).strftime(DATE_FMT)
    return out


WATERMARK_SCHEMA = "source STRING, key STRING, value STRING, version BIGINT, updated_at TIMESTAMP"


def save_watermark(spark: SparkSession, path: str, source: str, cfg: dict) -> DataFrame:
    """Add the (source, key) -> value rows of ``cfg`` to the state table at
    ``path`` under the source's next version; the row of the highest version
    counts, whatever the clock said when it was saved, and a cursor older than
    the saved one is not taken.  One file is added per save and nothing is
    rewritten, so a save that fails leaves the state as it was.  Returns the
    state."""
    now = dt.datetime.now(dt.timezone.utc)
    held = {r["key"]: r for r in _held(spark, path, source)}
    version = max((r["version"] for r in held.values()), default=0) + 1
    cfg = dict(cfg)
    saved = held[CURSOR_KEY]["value"] if CURSOR_KEY in held else None
    if saved and cfg.get(CURSOR_KEY) and dt.datetime.fromisoformat(cfg[CURSOR_KEY]) < dt.datetime.fromisoformat(saved):
        cfg[CURSOR_KEY] = saved
        cfg[START_KEY] = dt.datetime.fromisoformat(saved).strftime(DATE_FMT)
    new = spark.createDataFrame([(source, k, None if v is None else str(v), version, now) for k, v in cfg.items()],
                                WATERMARK_SCHEMA)
    new.coalesce(1).write.mode("append").parquet(path)
    return read_state(spark, path)


def _latest(rows: DataFrame) -> DataFrame:
    order = F.struct(F.coalesce("version", F.lit(0)).alias("version"), "updated_at")   # rows of older tables have no version
    return (rows.groupBy("source", "key").agg(F.max_by(F.struct("value", "version", "updated_at"), order).alias("s"))
            .select("source", "key", "s.value", F.coalesce("s.version", F.lit(0)).alias("version"), "s.updated_at"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(source, key, value, version, updated_at): the latest row of each key.  A
    table that is there but cannot be read is an error."""
    return _latest(spark.read.schema(WATERMARK_SCHEMA).parquet(path))


def _held(spark: SparkSession, path: str, source: str) -> list:
    """The latest rows of ``source`` (a few keys); none if there is no state table yet."""
    try:
        return read_state(spark, path).where(F.col("source") == source).collect()
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return []


def load_watermark(spark: SparkSession, path: str, source: str) -> dict:
    """The saved keys of ``source``; none if there is no state table yet."""
    return {r["key"]: r["value"] for r in _held(spark, path, source)}


def compact_state(spark: SparkSession, path: str) -> int:
    """One file instead of one per save; returns the files removed.

    The latest rows are added once more, with the versions they have, and only
    then the files they came from are removed: a crash in between leaves rows
    twice, which changes nothing, and a save by someone else meanwhile stays."""
    files = spark.read.schema(WATERMARK_SCHEMA).parquet(path).inputFiles()
    if len(files) > 1:
        _latest(spark.read.schema(WATERMARK_SCHEMA).parquet(*files)).coalesce(1).write.mode("append").parquet(path)
        jvm = spark.sparkContext._jvm
        for f in files:
            p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    return len(files) if len(files) > 1 else 0


# --- runs that can be taken up again ---------------------------------------------

@dataclass(frozen=True)
class Run:
    """A run of several steps: its one load time, and the steps that are done."""
    name: str
    load_ts: dt.datetime
    done: frozenset[str]


_OPEN, _STEP = "open_run", "done:"


def begin_run(spark: SparkSession, path: str, name: str) -> Run:
    """The unfinished run of ``name`` with the load time it began with, or a new
    one.  Its rows in the state table at ``path`` stay open until ``end_run``."""
    held = load_watermark(spark, path, f"run:{name}")
    if held.get(_OPEN):
        begun = held[_OPEN]
        done = frozenset(k[len(_STEP):] for k, v in held.items() if k.startswith(_STEP) and v == begun)
        return Run(name, dt.datetime.fromisoformat(begun), done)
    run = Run(name, load_timestamp(), frozenset())
    save_watermark(spark, path, f"run:{name}", {_OPEN: run.load_ts.isoformat()})
    return run


def finish_step(spark: SparkSession, path: str, run: Run, step: str) -> None:
    save_watermark(spark, path, f"run:{run.name}", {_STEP + step: run.load_ts.isoformat()})


def end_run(spark: SparkSession, path: str, run: Run) -> None:
    save_watermark(spark, path, f"run:{run.name}", {_OPEN: ""})


# --- files that are loaded once ---------------------------------------------------

LEDGER_SCHEMA = "source STRING, path STRING, length BIGINT, modified BIGINT, number BIGINT"   # microseconds since 1970


def consumed_files(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The ledger's rows of ``source``; none if there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path).where(F.col("source") == source)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def new_files(spark: SparkSession, files: DataFrame, ledger: str, source: str, since: dt.datetime | None,
              until: dt.datetime) -> DataFrame:
    """(path, length, modified in microseconds) of landed files that no load has
    consumed, however late they came: stamped before ``until`` and not before
    ``since``, where the very first window began."""
    files = files.where(F.col("modified") < ts_lit(until))
    if since is not None:
        files = files.where(F.col("modified") >= ts_lit(since))
    files = files.withColumn("modified", F.unix_micros("modified"))
    return files.join(consumed_files(spark, ledger, source), ["path", "length", "modified"], "left_anti")


def next_load(spark: SparkSession, ledger: str, source: str) -> int:
    """The number of the load to come.  It moves when a load's files are entered
    into the ledger, so a retry has the number of the load that failed."""
    return (consumed_files(spark, ledger, source).agg(F.max("number")).first()[0] or 0) + 1


def enter_files(files: DataFrame, ledger: str, source: str, number: int) -> None:
    (files.select(F.lit(source).alias("source"), "path", "length", "modified", F.lit(number).cast("long").alias("number"))
     .write.mode("append").parquet(ledger))
