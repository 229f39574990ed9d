"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.session import scratch_path

#: Words by white space: runs of anything but space, \t, \n, \v, \f and \r.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken: list[str], *names: str) -> list[str]:
    """Each name, with as many underscores added as no column has it yet."""
    have, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def packed_row(df: DataFrame) -> Column:
    """All columns as one struct, out of the way of an operator's own names."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def unpacked(row: str, df: DataFrame) -> list[Column]:
    """The columns of ``df`` out of its ``packed_row``."""
    return [F.col(row).getField(c).alias(c) for c in df.columns]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the session's shared checkpoint folder and
    read it back: the lineage is cut and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give Arrow's freed memory back: a Python worker shares its executor's
    memory with the JVM and outlives the task."""
    pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)
            release()

    return df.mapInArrow(run, schema)


def blocks_of(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(begin, end) of rows that hold up to ``most`` bytes of text together (a
    longer text is alone)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


#: Latin-1 letters, then a full stop or comma or not.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"


def chunked(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Texts cut at every space and newline: (index of each chunk among the
    distinct ones, the distinct chunks, where each text's chunks begin and the
    last one's end).  A null text is cut like an empty one."""
    lists = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
    coded = lists.flatten().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, lists.offsets.to_numpy()


def strings(values: pa.Array) -> list[str]:
    """A string column as a list, without a scalar object for each value."""
    return values.to_numpy(zero_copy_only=False).tolist()
