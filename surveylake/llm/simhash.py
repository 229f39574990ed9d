"""Near-duplicates by SimHash and tiled exact comparison of fingerprints.

Texts become 64-bit fingerprints inside Arrow tasks.  The distinct
fingerprints are laid out in tiles by the population counts of their four
16-bit quarters; the summed difference of those counts is a lower bound of the
Hamming distance, so a pair of tiles whose counts differ by more than the
radius is never formed.  Every remaining pair of tiles is compared in full with
numpy exclusive-or and bit counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, map_batches, materialise, packed_row, unpacked
from .components import connected_components

SEED = 42
QUARTERS, QUARTER_BITS = 4, 16
_DIGIT = 32  # a quarter's count (0 to 16) plus the radius on either side
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of one text: bit i is set if it is set in over half the hashes
    of its word shingles (repeats counted).  A text of fewer words is one
    shingle; one without words, or null, has fingerprint zero."""
    words = text.translate(_TO_LOWER).split() if text else []
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), itertools.repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a very long text is counted in slices
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, row_key, fp long) of every row, one pass, no shuffle; row_key is a
    128-bit hash of id and text; the id keeps its type."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], ["id", "row_key", "fp"])

    of_id = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                       F.col(text_col).cast("binary").alias("text"))
    return map_batches(rows, run, f"id {of_id}, row_key binary, fp long")


def row_key(id_col: str, text_col: str) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), text_col)))


def _tiles(fps: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Distinct fingerprints as (key, part, fps): one key per vector of quarter
    counts, cut into parts of about ``tile_rows`` by a hash."""
    key = sum((F.bit_count(F.shiftrightunsigned("fp", QUARTER_BITS * i).bitwiseAND(F.lit((1 << QUARTER_BITS) - 1)))
               + radius).cast("long") * _DIGIT ** i for i in range(QUARTERS))
    keyed = fps.select("fp", key.alias("key"))
    # at most 17^4 = 83,521 keys exist, whatever the input: this side may be broadcast
    parts = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).alias("parts"))
    return (keyed.join(F.broadcast(parts), "key")
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
            .groupBy("key", "part").agg(F.collect_list("fp").alias("fps")))


def _offsets(radius: int) -> list[int]:
    """Steps to the keys within the radius, one of each opposite pair."""
    steps = range(-radius, radius + 1)
    near = (d for d in itertools.product(steps, repeat=QUARTERS) if sum(map(abs, d)) <= radius)
    return sorted({s for d in near if (s := sum(x * _DIGIT ** i for i, x in enumerate(d))) >= 0})


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> Iterator[tuple[int, int]]:
    """Links between (or within) two tiles, as a spanning forest: connectivity
    is all that a component needs, so a tile of k copies yields k - 1 links."""
    close = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if same:
        np.fill_diagonal(close, False)
    if not close.any():
        return
    # breadth first; nodes 0..len(a)-1 are rows, the rest columns
    n = len(a)
    left_rows, left_cols = close.any(axis=1), np.ones(len(b), bool)
    for start in np.flatnonzero(left_rows):
        if not left_rows[start]:
            continue
        left_rows[start] = False
        if same:
            left_cols[start] = False
        todo = [int(start)]
        while todo:
            x = todo.pop()
            if x < n:
                new = np.flatnonzero(close[x] & left_cols)
                left_cols[new] = False
                if same:
                    left_rows[new] = False
                yield from ((x, int(y)) for y in new)
                todo += (new if same else new + n).tolist()
            else:
                new = np.flatnonzero(close[:, x - n] & left_rows)
                left_rows[new] = False
                yield from ((int(y), x - n) for y in new)
                todo += new.tolist()


def links(fps: DataFrame, radius: int = 3, tile_rows: int = 1024) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fps`` (fp long) at
    ``radius`` or fewer differing bits, as a spanning forest of each pair of
    tiles: their components are those of all links."""
    tiles = materialise(_tiles(fps, radius, tile_rows), "simhash-tiles")
    steps = F.explode(F.array(*(F.lit(s).cast("long") for s in _offsets(radius))))
    a = tiles.select("key", "part", F.col("fps").alias("a"), steps.alias("step")).withColumn(
        "near", F.col("key") + F.col("step"))
    b = tiles.select(F.col("key").alias("near"), F.col("part").alias("part_b"), F.col("fps").alias("b"))
    pairs = (a.join(b, "near").filter("step <> 0 OR part <= part_b")
             .select("a", "b", F.expr("step = 0 AND part = part_b").alias("same")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = batch.column(0), batch.column(1)
        (va, oa), (vb, ob) = ((x.values.to_numpy(zero_copy_only=False).view(np.uint64), x.offsets.to_numpy())
                              for x in (left, right))
        us, vs = [], []
        for i, same in enumerate(batch.column(2).to_pylist()):
            ta, tb = va[oa[i]:oa[i + 1]], vb[ob[i]:ob[i + 1]]
            for x, y in _forest(ta, tb, same, radius):
                us.append(ta[x])
                vs.append(tb[y])
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (us, vs)],
                                          ["u", "v"])

    return map_batches(pairs, run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3, tile_rows: int = 1024) -> DataFrame:
    """One row per row of ``docs``: (id, row_key, fp, component_id, root).

    component_id is the smallest id reachable over links of at most ``radius``
    differing bits, root the smallest fingerprint of the component.  Copies
    share a fingerprint and are folded before any comparison; only distinct
    fingerprints meet.  A null or wordless text has fingerprint zero and links
    like any other.  A null id stays null and is never a component_id, unless
    its whole component has none.  Repeated ids keep their rows; ids may be of
    any ordered type.  An empty table gives an empty one; other columns are not
    read.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    fps = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = connected_components(links(fps.select("fp"), radius, tile_rows))
    linked = roots.join(fps.withColumnRenamed("fp", "node"), "node")
    least = linked.groupBy("root").agg(F.min("least").alias("of_component"))
    linked = linked.join(least, "root").select(F.col("node").alias("fp"), "root", "of_component")
    named = fps.join(linked, "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("of_component")).alias("component_id"),
        F.coalesce("root", "fp").alias("root"))
    # written, so that the join below is of two plain exchanges and AQE may split a hot fingerprint
    return rows.join(materialise(named, "simhash-components"), "fp")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: that with the
    smallest id (a null id last), of rows alike in id and text one of them; all
    columns, whatever their names."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    stays = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")).alias("best"))
    keyed = docs.select(packed_row(docs).alias("row"), row_key(id_col, text_col).alias("row_key"))
    return (keyed.join(stays.select(F.col("best.row_key").alias("row_key")), "row_key", "left_semi")
            .dropDuplicates(["row_key"]).select(*unpacked("row", docs)))
