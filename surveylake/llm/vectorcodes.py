"""Vectors as short codes: parts, each the index of its codebook's nearest entry.

Components become integers, so every distance, mean and tie is exact.  The
distinct parts of each position are counted once (folded in every batch before
the shuffle) and written in lexicographic order.  A batch of them is a trie: a
depth-first traversal adds one dimension's squared differences to all entries to
the vector that its prefix has accumulated, so parts with a common prefix share
the work; a leaf takes the nearest entry and adds its part to that entry's sums,
as often as it occurs.  The driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, release
from .vectors import as_numbers, binaries, matrices

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_RUN, _BLOCK = 8192, 512  # parts to a trie, nodes of one depth taken together
_MOST = 2.0 ** 62
_LONG = 2 ** 63 - 1


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, the lower of ties; its squared distance) of
    every row of ``parts``, integers sorted by columns, first to last."""
    index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), parts.dtype)
    for at in range(0, len(parts) if parts.shape[1] else 0, _RUN):
        end = min(at + _RUN, len(parts))
        # (depth, where the prefixes begin, where the last one ends, their accumulated distances)
        stack = [(0, np.array([at]), end, np.zeros((1, len(entries)), parts.dtype))]
        while stack:
            depth, begins, end, sums = stack.pop()
            column = parts[begins[0]:end, depth]
            turns = np.append(True, column[1:] != column[:-1])
            turns[begins - begins[0]] = True
            child = np.flatnonzero(turns) + begins[0]
            parent = np.searchsorted(begins, child, "right") - 1
            found = sums[parent] + (parts[child, depth][:, None] - entries[:, depth]) ** 2
            if depth + 1 < parts.shape[1]:
                ends = np.append(child[_BLOCK::_BLOCK], end)
                stack += [(depth + 1, child[b:b + _BLOCK], e, found[b:b + _BLOCK])
                          for b, e in reversed(list(zip(range(0, len(child), _BLOCK), ends)))]
            else:  # equal rows end in one leaf
                best = found.argmin(axis=1)
                often = np.diff(np.append(child, end))
                index[child[0]:end] = np.repeat(best, often)
                distance[child[0]:end] = np.repeat(found[np.arange(len(child)), best], often)
    return index, distance


def _cuts(size: int, parts: int) -> list[int]:
    return [size * i // parts for i in range(parts + 1)]


def exact(values: np.ndarray, most: float | None = None) -> np.ndarray:
    """Whole numbers as 64-bit integers, or as Python's where squares would not fit."""
    most = np.abs(values).max(initial=0) if most is None else most
    if 4 * most * most * max(values.shape[1], 1) < _MOST:
        return values.astype(np.int64)
    return np.array([[int(v) for v in row] for row in values], object).reshape(values.shape)


def _whole(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, str]:
    """(id, label, size, vector: floor(scale * x)) of the rows that count."""
    numbers, dtype = as_numbers(vectors, vector_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        with np.errstate(over="ignore"):
            found = [(rows, np.floor(x * np.array(scale, dtype)) + 0) for rows, x in matrices(batch.column(2))]
        found = [(rows[fine], x[fine]) for rows, x in found for fine in [(np.abs(x) < _MOST).all(axis=1)]]
        at = pa.array(np.concatenate([rows for rows, _ in found] + [np.empty(0, np.int64)]))
        kept = pa.concat_arrays([binaries(x) for _, x in found] + [pa.array([], pa.binary())])
        sizes = np.concatenate([np.full(len(x), x.shape[1], np.int64) for _, x in found] + [np.empty(0, np.int64)])
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(sizes), kept],
                                          ["id", "label", "size", "vector"])

    of_id, of_label = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), numbers.alias("vector"))
    return map_batches(rows, run, f"id {of_id}, label {of_label}, size long, vector binary"), dtype


def _distinct(rows: DataFrame, cuts: list[int], dtype: str) -> DataFrame:
    """(position, part, n): the distinct parts, in lexicographic order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype).reshape(batch.num_rows, -1)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                parts, n = np.unique(_one(x[:, a:b]), return_counts=True)
                width = max(1, b - a) * x.itemsize
                flat = parts.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(parts), p, np.int32)),
                     pa.array([flat[i:i + width] for i in range(0, len(flat), width)], pa.binary()), pa.array(n)],
                    ["position", "part", "n"])
            release()

    counted = (rows.select("vector").mapInArrow(run, "position int, part binary, n long")
               .groupBy("position", "part").agg(F.sum("n").alias("n")))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def _one(x: np.ndarray) -> np.ndarray:
    """Each row as one value, ordered by its bytes: equal prefixes lie together."""
    x = np.ascontiguousarray(x) if x.shape[1] else np.zeros((len(x), 1), x.dtype)
    return x.view(f"V{x.shape[1] * x.itemsize}").ravel()


def _means(parts: DataFrame, codebooks: list[np.ndarray], dtype: str) -> list[np.ndarray]:
    """The codebooks after one round: every entry the mean of its parts."""
    shared = parts.sparkSession.sparkContext.broadcast(codebooks)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        position, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        out = []
        for p in np.unique(position):
            entries, own = shared.value[p], np.flatnonzero(position == p)
            if not entries.shape[1]:
                continue
            x = np.frombuffer(b"".join(batch.column(1).take(pa.array(own)).to_pylist()), dtype).reshape(len(own), -1)
            x = exact(x, _most(x, entries))
            index, _ = nearest(x, entries.astype(x.dtype))
            for e in np.unique(index):
                mine, times = x[index == e].astype(object), n[own][index == e].astype(object)
                sums = (mine * times[:, None]).sum(axis=0)
                out += [(int(p), int(e), d, str(s), int(times.sum())) for d, s in enumerate(sums)]
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()))], ["position", "entry", "dim", "s", "n"])

    # parts * entries * dimensions of a part: as many rows as the codebooks have numbers
    sums = (map_batches(parts, run, "position int, entry int, dim int, s string, n long")
            .groupBy("position", "entry", "dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")))
    new = [c.astype(object) for c in codebooks]
    for r in sums.collect():
        new[r.position][r.entry, r.dim] = int(r.s) // r.n
    return [exact(c) for c in new]


def _most(x: np.ndarray, entries: np.ndarray) -> float:
    return max(float(np.abs(x).max(initial=0)), float(max(map(abs, entries.ravel().tolist()), default=0)))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of every row that counts, and the codebooks:
    for each part an array of entries by dimensions.

    A component x counts as floor(scale * x).  Rows go whose vector is null or
    empty, holds null or non-finite components or some of 2^62 or more (so
    scaled), or has another length than that of the smallest id.  A length that
    ``parts`` does not divide is cut at its multiples of length / parts, rounded
    down.  Codebooks begin as the vectors of the smallest ids (as many as there
    are, equal ids by their bytes, null ids last); an entry no part is nearest to stays.
    ``code`` has two hexadecimal digits a part (more from 257 entries on), ``error`` is the summed
    squared distance, 2^63 - 1 at most.  Repeated rows count as often as they
    occur.  No row that counts: no rows and no codebooks.  Other columns are not read.
    """
    rows, dtype = _whole(vectors, id_col, vector_col, label_col, scale)
    rows = materialise(rows, "codes-rows")
    first = rows.orderBy(F.col("id").isNull(), "id", "vector").select("size").limit(1).collect()
    if not first:
        return rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    rows = rows.filter(F.col("size") == first[0].size)
    seeds = rows.orderBy(F.col("id").isNull(), "id", "vector").select("vector").limit(entries).collect()
    cuts = _cuts(first[0].size, parts)
    start = exact(np.array([np.frombuffer(r.vector, dtype) for r in seeds]))
    codebooks = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    distinct = materialise(_distinct(rows, cuts, dtype), "codes-parts")
    for _ in range(rounds):
        codebooks = _means(distinct, codebooks, dtype)
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype).reshape(batch.num_rows, -1)
        codes, errors = np.empty((len(x), parts), np.int64), np.zeros(len(x), object)
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            _, at, inverse = np.unique(_one(x[:, a:b]), return_index=True, return_inverse=True)
            own = exact(x[at, a:b], _most(x[at, a:b], shared.value[p]))
            index, distance = nearest(own, shared.value[p].astype(own.dtype))
            codes[:, p] = index[inverse]
            errors = errors + distance.astype(object)[inverse]
        written = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(written, pa.string()), pa.array([min(e, _LONG) for e in errors], pa.int64())],
            ["id", "label", "code", "error"])

    of_id, of_label = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    coded = map_batches(rows.select("id", "label", "vector"), run, f"id {of_id}, label {of_label}, code string, error long")
    return coded, codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and dimension, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for c in codebooks for v in c.ravel()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors summed over equal labels (nulls
    together; 2^63 - 1 at most)."""
    coded = materialise(coded, "codes-coded")
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(materialise(sums, "codes-labels"), F.col("label").eqNullSafe(F.col("of"))).drop("of")
