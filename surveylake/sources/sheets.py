"""Spreadsheet exports and parquet snapshots as all-text frames."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .documents import BROADCAST_ROWS


def read_sheet_export(spark: SparkSession, path: str, fmt: str = "csv", blank_as_empty: bool = True,
                      multi_line: bool = True, split: bool = False) -> DataFrame:
    """A worksheet export: first row = header, every cell text.

    No schema inference (a sheet column is text until its schema document
    says otherwise).  Spark's CSV reader gives NULL for an empty cell; with
    ``blank_as_empty`` it becomes '' as in the sheet.  With ``multi_line``
    quoted cells may span lines, and a file is one task; without it Spark
    splits large files.  ``split`` reads large files in many tasks although
    cells span lines (``read_split_csv``).
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    elif split:
        df = read_split_csv(spark, path)
    else:
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("multiLine", multi_line).option("escape", '"').csv(path))
    return df.fillna("") if blank_as_empty else df


def ingest_all(spark: SparkSession, folders: Mapping[str, str], fmt: str = "csv",
               multi_line: bool = True, split: bool = False) -> dict[str, DataFrame]:
    """One lazily-read frame per worksheet folder (survey + SQL export)."""
    return {name: read_sheet_export(spark, path, fmt, multi_line=multi_line, split=split) for name, path in folders.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: a parquet object or folder."""
    return spark.read.parquet(path)


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header whose quoted cells may hold line breaks, read in
    as many tasks as they have splits, with the rows that ``multiLine`` gives
    (lines may end in \\n or \\r\\n).

    Whether a split begins inside a quoted cell is the parity of the quotes
    before it: quotes are counted per split (a scan that shuffles one number
    each), added up over the file, and sent along for the splits that begin
    inside one.  Each task then puts its lines together to records; a record
    that runs over a split's end leaves a fragment on either side, and those
    few are put together by file.  Quotes stand around cells and, doubled, inside them, as
    spreadsheets export them; a single quote inside an unquoted cell is not such a file.
    """
    columns = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    counted = _written(lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes")), "csv-quotes")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = _written(counted.select("file", "block", (F.sum("quotes").over(before) % 2 == 1).alias("inside")).where("inside"),
                      "csv-inside")
    if inside.count() <= BROADCAST_ROWS:
        inside = F.broadcast(inside)
    pieces = lines.join(inside, ["file", "block"], "left").select(
        "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "value").mapInArrow(
        _records, "file string, block long, place int, text string")
    pieces = _written(pieces, "csv-records")
    whole = pieces.where(F.col("place") == _WHOLE).select("text")
    # fragments: at most one that ends and one that begins in each split
    parts = pieces.where(F.col("place") != _WHOLE)
    begun = F.max(F.when(F.col("place") == _BEGINS, F.col("block"))).over(Window.partitionBy("file").orderBy("block", "place"))
    joined = (parts.withColumn("record", begun).groupBy("file", "record")
              .agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts"))
              .select(F.array_join("parts.text", "\n").alias("text")))
    names = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    cells = F.from_csv(F.regexp_replace("text", "\r$", ""), names, {"escape": '"', "multiLine": "true"})
    records = whole.unionByName(joined).where(F.regexp_replace("text", "\r$", "") != "")
    return records.select(cells.alias("r")).select("r.*")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ENDS, _BEGINS, _WHOLE = 0, 1, 2   # the order of a split's fragments


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, place, text): the records of each split, and its fragments
    of records that begin before it or end after it.  A file's first record is
    its header and left out."""
    at, held, first, inside = None, [], False, False   # the split, lines of the record that is open

    def fragment():
        place = _ENDS if inside_at_start and not closed else _BEGINS
        return [(*at, place, "\n".join(held))] if held else []

    inside_at_start, closed = False, False
    for batch in batches:
        out = []
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts_inside = batch.column(2).to_pylist()
        odd = (pc.count_substring(batch.column(3), '"').to_numpy(zero_copy_only=False) % 2).astype(bool)
        values = batch.column(3).to_pylist()
        change = np.flatnonzero([True] + [a != b or c != d for a, b, c, d in zip(files[1:], files, blocks[1:], blocks)])
        for a, b in zip(change, [*change[1:], len(values)]):
            if (files[a], blocks[a]) != at:
                if at is not None:
                    out += fragment()
                at, held, inside = (files[a], blocks[a]), [], starts_inside[a]
                inside_at_start, closed, first = inside, False, blocks[a] == 0
            for k in range(a, b):
                held.append(values[k])
                inside ^= bool(odd[k])
                if not inside:
                    if inside_at_start and not closed:
                        out.append((*at, _ENDS, "\n".join(held)))
                    elif first:
                        first = False
                    else:
                        out.append((*at, _WHOLE, "\n".join(held)))
                    closed, held = True, []
        yield _batch(out)
    if at is not None:
        yield _batch(fragment())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
                                      ["file", "block", "place", "text"])
