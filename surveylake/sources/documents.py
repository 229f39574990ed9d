"""Landed XML files and JSON envelopes of base64 XML documents.

Both readers return ``(doc_key, payload)`` rows ready for
``operators.nested.decode_documents``; ``doc_key`` is stable (file path, or
file path + position in the envelope), which is what the deterministic ids
of the decoded rows hang on.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleanse import encode_base64_text, ts_lit
from ..session import scratch_path

CORRUPT = "_corrupt_record"
ENVELOPE_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(T.StructType([
    T.StructField("interfaceValue", T.StringType())]))), T.StructField(CORRUPT, T.StringType())])
#: Rows of a small side that may be sent to every executor (about 100 bytes each).
BROADCAST_ROWS = 100_000


def landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of every file under ``path``; no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def literal_path(path: str) -> str:
    """``path`` with its glob characters escaped: the file of that very name."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_xml_folder(spark: SparkSession, path: str, glob: str = "*.xml",
                    as_base64: bool = False) -> DataFrame:
    """Every matching file under ``path`` (recursively), whole text.

    ``as_base64`` wraps the text like the API payload (only needed when the
    payload is archived in that form; decoding takes plain text too).
    """
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).text(path))
    payload = encode_base64_text("value") if as_base64 else F.col("value")
    return df.select(F.col("_metadata.file_path").alias("doc_key"), payload.alias("payload"))


def read_envelope(spark: SparkSession, path: str | Sequence[str], glob: str = "*.json",
                  multi_line: bool = True, modified_from: dt.datetime | None = None,
                  modified_until: dt.datetime | None = None) -> DataFrame:
    """JSON responses ``{"data": [{"interfaceValue": <base64 XML>}, ...]}``
    of files modified in ``[modified_from, modified_until)``.

    One row (doc_key, payload, reason) per document, reason being null.  A
    response that is cut off or broken, or has no ``data`` list, is one row with
    its text and the reason ``envelope``: none of its documents counts, and the
    document load lists it among its rejects.  With one response per file the
    key is the file and the document's position in its ``data`` list.
    ``multi_line=False`` reads files that hold one response per line (JSON
    lines), which Spark can split; there the key is the file, a hash of the
    line, its number among equal lines of the file, and the position.
    """
    if multi_line:
        df = (spark.read.schema(ENVELOPE_SCHEMA).option("multiLine", True)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", True).json(path))
        rows = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("at"),
                         "data", F.coalesce(F.col(CORRUPT), F.to_json(F.struct("data"))).alias("response"),
                         (F.col(CORRUPT).isNotNull() | F.col("data").isNull()).alias("broken"))
    else:
        lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
                 .text(path if isinstance(path, str) else list(path)))
        lines = lines.where(F.trim("value") != "").select(
            F.col("_metadata.file_path").alias("name"), F.col("_metadata.file_modification_time").alias("at"),
            F.col("value").alias("response"))
        lines = _modified(lines, modified_from, modified_until)
        found = F.from_json("response", ENVELOPE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT})
        rows = (with_number(lines, "name", F.sha2("response", 256))
                .select(F.concat_ws("#", "name", "content", F.col("number").cast("string")).alias("file"), "at", "response",
                        found.alias("r"))
                .select("file", "at", "response", F.col("r.data").alias("data"),
                        (F.col("r").getField(CORRUPT).isNotNull() | F.col("r.data").isNull()).alias("broken")))
    rows = _modified(rows, modified_from, modified_until)
    reason = F.lit("envelope")
    documents = F.when(F.col("broken"), F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.col("response").alias("payload"),
                                                         reason.alias("reason")))).otherwise(
        F.transform("data", lambda d, i: F.struct(i.alias("pos"), d["interfaceValue"].alias("payload"),
                                                  F.lit(None).cast("string").alias("reason"))))
    return rows.select("file", F.explode(documents).alias("d")).select(
        F.concat_ws("#", "file", F.col("d.pos").cast("string")).alias("doc_key"), "d.payload", "d.reason")


def _modified(rows: DataFrame, since: dt.datetime | None, until: dt.datetime | None) -> DataFrame:
    if since is not None:
        rows = rows.where(F.col("at") >= ts_lit(since))
    return rows if until is None else rows.where(F.col("at") < ts_lit(until))


def with_number(rows: DataFrame, name: str, content: Column) -> DataFrame:
    """``rows`` with ``content`` and ``number``, 0, 1, ... among the rows alike
    in both ``name`` and ``content``.

    Hardly any row has an equal in its file, and only those need a number: the
    pairs are counted (partial aggregation, hashes alone are shuffled), the
    repeated ones numbered in the order of the scan, and joined back by the
    row's place in it.  While they are few they are sent to every task, so no
    payload is shuffled; beyond ``BROADCAST_ROWS`` the join shuffles.
    """
    keyed = rows.withColumn("content", content).withColumn("place", F.monotonically_increasing_id())
    ids = keyed.select(name, "content", "place")
    pairs = ids.groupBy(name, "content").agg(F.count("*").alias("n")).where("n > 1").select(name, "content")
    spark = rows.sparkSession
    written = scratch_path(spark, "repeated-rows")
    pairs.write.mode("overwrite").parquet(written)
    pairs = spark.read.schema(pairs.schema).parquet(written)
    if pairs.isEmpty():
        return keyed.drop("place").withColumn("number", F.lit(0))
    number = F.row_number().over(Window.partitionBy(name, "content").orderBy("place")) - 1
    numbers = ids.join(pairs, [name, "content"], "left_semi").select("place", number.alias("number"))
    written = scratch_path(spark, "row-numbers")
    numbers.write.mode("overwrite").parquet(written)
    numbers = spark.read.schema(numbers.schema).parquet(written)
    if numbers.count() <= BROADCAST_ROWS:
        numbers = F.broadcast(numbers)
    return keyed.join(numbers, "place", "left").drop("place").withColumn("number", F.coalesce("number", F.lit(0)))
