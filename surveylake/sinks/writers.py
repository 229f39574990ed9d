"""Writers for RAW, PROCESSED, history, exports, archives and logs.

All writers take a storage path (any Hadoop filesystem the cluster shares);
Spark writes in parallel straight to storage, nothing passes through the
driver.  Small outputs (one-row logs) are coalesced so they do not become
thousands of tiny files; large outputs keep their partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleanse import stringify_frame, with_audit
from ..operators.merge import month_key, month_replace
from ..operators.nested import BODY_ID, DOC_ID, HEAD_ID, ROW_ID
from ..sources.config import LOG_COLUMNS

MONTH_PARTITION = "month_key"
LOAD_PARTITION = "load_key"
LOAD_ID_PARTITION = "load_id"   # one document load of a RAW table
EVERY_LOAD = "all"   # load key of rows that any later load of their month replaces
# RAW rows are mostly hex ids, of which only half of each digit's byte can be saved: no dictionaries for them, their
# lengths kept apart (version 2), and little search for matches, which cost more than they save.  Archives are whole texts.
RAW_PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.compression.codec.zstd.level": "1"}
RAW_PARQUET |= {f"parquet.enable.dictionary#{c}": "false" for c in (DOC_ID, ROW_ID, HEAD_ID, BODY_ID)}
ARCHIVE_PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.compression.codec.zstd.level": "9"}
CSV_TEXT = {"compression": "gzip", "zlib.compress.strategy": "FILTERED"}
JSON_TEXT = CSV_TEXT | {"zlib.compress.level": "BEST_COMPRESSION"}


def load_key(load_ts: dt.datetime | None = None) -> str:
    """The partition value of one load: its time, to the microsecond."""
    return (load_ts or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S_%f")


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrite the partitions that ``df`` holds and no other.  Rows are
    gathered by partition first (AQE splits one that is large), else every task
    would write a file into every partition."""
    (df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def write_raw(df: DataFrame, path: str, stringify: bool = True, load_id: str | None = None) -> None:
    """K1: truncate-and-load a RAW table, every column text ('None' -> NULL).

    With a ``load_id`` only that load's partition is replaced: the loads of one
    RAW table (batches of any number of landing streams, API runs) add up, and
    a retried one counts once.  A RAW table is either truncated by each load or
    held by load ids; whoever consumes it drops the loads it has processed."""
    out = stringify_frame(df) if stringify else df.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    out.write.mode("overwrite").options(**RAW_PARQUET).parquet(raw_part(path, load_id))


def raw_part(path: str, load_id: str | None = None) -> str:
    """Where one load of a RAW table lies."""
    return path if load_id is None else f"{path.rstrip('/')}/{LOAD_ID_PARTITION}={load_id}"


def export_current(df: DataFrame, base: str, name: str) -> str:
    """K2: the table's current snapshot, overwritten each run."""
    path = f"{base.rstrip('/')}/current/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def snapshot_stamp(ts: dt.datetime | None = None) -> str:
    return (ts or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def export_history(df: DataFrame, base: str, name: str, ts: dt.datetime | None = None) -> str:
    """K3: a timestamped snapshot ``<name>_HISTORY_<yyyymmdd_HHMMSS>``.

    A retried run with the same load time rewrites its own snapshot."""
    path = f"{base.rstrip('/')}/history/{name}_HISTORY_{snapshot_stamp(ts)}"
    df.write.mode("overwrite").parquet(path)
    return path


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``."""
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")


def append_audited(df: DataFrame, path: str, user: str, load_ts: dt.datetime,
                   partition_by: Sequence[str] = ()) -> None:
    """``INSERT ... SELECT cols, user, load time`` (by name).  Each
    load has its own ``load_key`` partition: earlier loads stay, a retried load
    replaces itself."""
    out = with_audit(df, user, load_ts).withColumn(LOAD_PARTITION, F.lit(load_key(load_ts)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD_PARTITION, *partition_by).parquet(path))


def with_month_partition(df: DataFrame, month_column: str) -> DataFrame:
    return df.withColumn(MONTH_PARTITION, month_key(df, month_column))


def replace_months(dest_path: str, sources: Sequence[tuple[DataFrame, str]],
                   load_ts: dt.datetime | None = None) -> None:
    """K6 + C4 at scale: replace whole calendar months of a month-partitioned
    PROCESSED dataset by the sources (the last source wins a shared month).

    Only the incoming rows are written: ``raw |> months(sql) U sql`` is
    computed in one plan and written, in one job, with dynamic partition
    overwrite over (month, load): the months in the sources are replaced, every
    other month is left untouched -- the table is never rewritten as a whole.
    Rows with a NULL month are never deleted by another load: they lie in a
    partition of their own load, which only a retry of that load (the same
    ``load_ts``) replaces.
    """
    incoming = month_replace(None, list(sources))
    inc = with_month_partition(incoming, sources[-1][1])
    inc = inc.withColumn(LOAD_PARTITION, F.when(F.col(MONTH_PARTITION).isNull(), F.lit(load_key(load_ts)))
                         .otherwise(F.lit(EVERY_LOAD)))
    replace_partitions(inc, dest_path, MONTH_PARTITION, LOAD_PARTITION)


def log_load(spark: SparkSession, path: str, domain: str, table: str, process_type: str,
             rows: int, user: str, load_ts: dt.datetime) -> None:
    """K8: append one audit-log row (one small file per load)."""
    row = [(domain, table, process_type, int(rows), user, load_ts)]
    schema = ("DOMINIO STRING, TABLA STRING, TIPO_DE_PROCESO STRING, CANT_REGISTROS BIGINT, "
              "USUARIO STRING, FECHA_CARGA TIMESTAMP")
    df = spark.createDataFrame(row, schema).select(*LOG_COLUMNS)
    df.coalesce(1).write.mode("append").parquet(path)


def _stamped(name: str, ts: dt.datetime | None, load_id: str | None) -> str:
    """A load with an id has one folder, whenever it is run (again)."""
    return f"{name}-{load_id or snapshot_stamp(ts)}"


def export_csv(df: DataFrame, base: str, name: str, ts: dt.datetime | None = None,
               distinct: bool = True, load_id: str | None = None) -> str:
    """K9: de-duplicated CSV export (gzipped) with a stamped folder name
    (``distinct=False`` when the caller already de-duplicated)."""
    path = f"{base.rstrip('/')}/CSV/{name}/{_stamped(name, ts, load_id)}"
    (df.dropDuplicates() if distinct else df).write.mode("overwrite").option("header", True).options(
        **CSV_TEXT).csv(path)
    return path


def archive_json(df: DataFrame, base: str, name: str, ts: dt.datetime | None = None,
                 load_id: str | None = None) -> str:
    """Archive the original payload rows as (gzipped) JSON lines."""
    path = f"{base.rstrip('/')}/JSON/{name}/{_stamped(name, ts, load_id)}"
    df.write.mode("overwrite").options(**JSON_TEXT).json(path)
    return path


def archive_xml(docs: DataFrame, base: str, table_name: str, key: str = "doc_key",
                text: str = "xml", load: str | None = None) -> str:
    """Decoded XML kept as a table ``(id, table_name, data)`` partitioned
    by table name and load -- one row per document, not one tiny file per
    document; a retried load (the same ``load``) replaces itself."""
    path = f"{base.rstrip('/')}/XML"
    out = docs.select(F.sha2(F.col(key).cast("string"), 256).alias("id"),
                      F.lit(table_name).alias("table_name"), F.col(text).alias("data"),
                      F.lit(load or load_key()).alias(LOAD_PARTITION))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**ARCHIVE_PARQUET)
     .partitionBy("table_name", LOAD_PARTITION).parquet(path))
    return path
