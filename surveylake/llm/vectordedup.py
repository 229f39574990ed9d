"""Near-duplicate vectors by cross-polytope hashing and verified pairs.

A hash function turns a vector by three rounds of random signs and a fast
Hadamard transform and names the axis it is nearest to (the cross-polytope's
vertex).  Each of ``tables`` tables joins ``functions`` of them; a vector enters
the ``probes`` buckets of a table whose axes it is nearest to, so two vectors
meet if any of their buckets agree.  Every pair of a bucket is verified by its
cosine in double precision.

Equal vectors are folded first, and buckets of one vector dropped before any
vector travels.  A bucket beyond ``tile`` vectors is cut into parts by a hash
and every pair of parts is a group of its own, so no task holds more than two
parts and nothing is left out.  A pair that shares several buckets counts in
the one with the smallest key alone: links are summed where they are found, and
a spanning forest goes to the components; pairs are never listed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, release
from .components import connected_components
from .vectors import as_numbers, binaries, matrices, unbinaries

COSINE = 0.95
TABLES, FUNCTIONS, PROBES = 4, 3, 8
ROUNDS, CHOICES, SEED = 3, 4, 42
TILE, SMALL = 1024, 48
_SLICE = 2048  # vectors hashed, rows of a product, and pairs compared at a time


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row (a power of two long)."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


class Hasher:
    """Bucket keys of vectors of one length."""

    def __init__(self, size: int, tables: int = TABLES, functions: int = FUNCTIONS, probes: int = PROBES):
        self.size, self.tables, self.functions = size, tables, functions
        self.width = 1 << (size - 1).bit_length()
        self.signs = np.random.default_rng([SEED, size]).choice([-1.0, 1.0], (tables, functions, ROUNDS, self.width))
        choices = min(CHOICES, self.width)
        self.choices = choices
        self.combos = np.array(list(itertools.product(range(choices), repeat=functions)))
        self.probes = min(probes, len(self.combos))

    def _axes(self, x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest axes, nearest first, and how much farther than that each is."""
        for s in signs:
            x = hadamard(x * s)
        far = np.abs(x)
        top = np.argsort(-far, axis=1, kind="stable")[:, :self.choices]
        near = np.take_along_axis(far, top, 1)
        return 2 * top + (np.take_along_axis(x, top, 1) < 0), (near[:, :1] - near) ** 2

    def _slice(self, x: np.ndarray) -> np.ndarray:
        x = np.pad(unit(x), ((0, 0), (0, self.width - self.size)))
        out = np.empty((len(x), self.tables, self.probes), np.uint64)
        for t in range(self.tables):
            axes, farther = zip(*(self._axes(x, s) for s in self.signs[t]))
            cost = sum(farther[f][:, self.combos[:, f]] for f in range(self.functions))
            best = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
            key = np.full(best.shape, self.size * 64 + t, np.uint64)
            for f in range(self.functions):
                code = np.take_along_axis(axes[f], self.combos[best, f], 1).astype(np.uint64)
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + code
            out[:, t] = key ^ (key >> np.uint64(32))
        return out.view(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(vector, table, probe) -> key."""
        return np.concatenate([np.empty((0, self.tables, self.probes), np.int64)] + [
            self._slice(x[i:i + _SLICE]) for i in range(0, len(x), _SLICE)])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors whose squares would leave the range of doubles, made of length about one."""
    x = x.astype(np.float64)
    most = np.abs(x).max(axis=1, keepdims=True)
    return np.where((most > 1e100) | (most < 1e-100), x / most, x)


def pairs_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within groups of these sizes that lie one after another."""
    begins = np.cumsum(sizes) - sizes
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size in np.unique(sizes[sizes > 1]):
        a, b = np.triu_indices(size, 1)
        at = begins[sizes == size][:, None]
        left.append((at + a).ravel())
        right.append((at + b).ravel())
    return np.concatenate(left), np.concatenate(right)


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of the graph to the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            break
        low = new
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


class Verifier:
    """Links of groups of vectors of one length."""

    def __init__(self, cosine: float, size: int, *hashing: int):
        self.cosine, self.hasher = cosine, Hasher(size, *hashing)

    def _near(self, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        norms = np.linalg.norm(x, axis=1)
        near = np.zeros(len(a), bool)
        for i in range(0, len(a), _SLICE):
            u, v = a[i:i + _SLICE], b[i:i + _SLICE]
            near[i:i + _SLICE] = np.einsum("ij,ij->i", x[u], x[v]) >= self.cosine * (norms[u] * norms[v])
        return near

    def _product(self, x: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of ``left`` and ``right`` (row numbers) by blocks of a matrix product."""
        norms = np.linalg.norm(x, axis=1)
        for i in range(0, len(left), 256):
            rows = left[i:i + 256]
            near = x[rows] @ x[right].T >= self.cosine * (norms[rows][:, None] * norms[right])
            r, c = np.nonzero(near)
            yield rows[r], right[c]

    def _first(self, x: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``key`` is the smallest bucket that the pair shares."""
        used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        keys, a, b = self.hasher(x[used]), at[:len(a)], at[len(a):]
        out = np.zeros(len(a), bool)
        for i in range(0, len(a), _SLICE):
            ka, kb = keys[a[i:i + _SLICE]], keys[b[i:i + _SLICE]]
            shared = (ka[:, :, :, None] == kb[:, :, None, :]).any(axis=3)
            out[i:i + _SLICE] = np.where(shared, ka, np.iinfo(np.int64).max).min(axis=(1, 2)) == key[i:i + _SLICE]
        return out

    def __call__(self, x: np.ndarray, key: np.ndarray, i: np.ndarray, j: np.ndarray, part: np.ndarray,
                 begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs of rows; groups begin at ``begins``."""
        x, sizes = scaled(x), np.diff(np.append(begins, len(x)))
        few = (sizes <= SMALL) & (i[begins] == j[begins])
        kept = np.repeat(few, sizes)
        a, b = pairs_of(sizes[few])
        rows = np.flatnonzero(kept)
        a, b = rows[a], rows[b]
        near = self._near(x, a, b)
        found = [(a[near], b[near])]
        for at, size in zip(begins[~few], sizes[~few]):
            rows = np.arange(at, at + size)
            if i[at] == j[at]:
                found += ((u[u < v], v[u < v]) for u, v in self._product(x, rows, rows))
            else:
                found += self._product(x, rows[part[rows] == i[at]], rows[part[rows] == j[at]])
        a, b = (np.concatenate(side) for side in zip(*found))
        first = self._first(x, key[a], a, b)
        return a[first], b[first]


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(id, digest, vector) of every row; both null if it links with nothing."""
    numbers, dtype = as_numbers(vectors, vector_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, kept = (np.full(batch.num_rows, None, object) for _ in range(2))
        for rows, x in matrices(batch.column(1)):
            some = x.any(axis=1)
            for row, b in zip(rows[some], binaries((x[some] + 0).astype(dtype)).to_pylist()):
                digests[row], kept[row] = xxhash.xxh3_128_digest(b), b
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())],
                                          ["id", "digest", "vector"])

    of_id = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), numbers.alias("vector"))
    return map_batches(rows, run, f"id {of_id}, digest binary, vector binary"), dtype


def _keys(distinct: DataFrame, dtype: str, *hashing: int) -> DataFrame:
    """(key, node): the buckets of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            node, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for of in np.unique(size):
                rows = np.flatnonzero(size == of)
                for at in range(0, len(rows), _SLICE):
                    some = rows[at:at + _SLICE]
                    x = unbinaries(batch.column(2).take(pa.array(some)), dtype)
                    hasher = hashers.setdefault(int(of), Hasher(x.shape[1], *hashing))
                    keys = hasher(x).reshape(len(x), -1)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(node[some], keys.shape[1]))],
                                                     ["key", "node"])
            release()

    return distinct.select("node", "size", "vector").mapInArrow(run, "key long, node long")


def _members(distinct: DataFrame, dtype: str, tile: int, *hashing: int) -> DataFrame:
    """(key, i, j, part, node): every bucket of two or more vectors, by pairs of parts."""
    keys = materialise(_keys(distinct, dtype, *hashing), "vectors-keys")
    shared = materialise(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "vectors-buckets")
    parts = F.ceil(F.col("n") / tile)
    # both sides are plain exchanges of written rows, so AQE may split a hot bucket
    found = (keys.join(shared, "key").withColumn("parts", parts)
             .withColumn("part", F.expr("pmod(xxhash64(node), parts)"))
             .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))))
    return found.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node")


def _links(members: DataFrame, distinct: DataFrame, dtype: str, cosine: float, *hashing: int) -> DataFrame:
    """(u, v, n): u has n more links (v null), or lies in v's component (n zero)."""
    order = ["size", "key", "i", "j"]
    width = np.dtype(dtype).itemsize
    groups = (members.join(distinct.select("node", "copies", "size", "vector"), "node")
              .select(*order, "part", "node", "copies", "vector")
              .repartition(*order).sortWithinPartitions(*order))

    def verify(table: pa.RecordBatch, verifiers: dict[int, Verifier]) -> Iterator[pa.RecordBatch]:
        size, key, i, j, part, node, copies = (table.column(c).to_numpy() for c in range(7))
        change = np.ones(len(size), bool)
        change[1:] = np.any([x[1:] != x[:-1] for x in (size, key, i, j)], axis=0)
        begins = np.flatnonzero(change)
        for of in np.unique(size):  # sorted by size: one run of rows each
            a, b = np.searchsorted(size, [of, of + 1])
            own = begins[(begins >= a) & (begins < b)] - a
            verifier = verifiers.setdefault(int(of), Verifier(cosine, int(of) // width, *hashing))
            x = unbinaries(table.column(7).slice(a, b - a), dtype)
            u, v = verifier(x, key[a:b], i[a:b], j[a:b], part[a:b], own)
            if len(u):
                u, v = u + a, v + a
                ends, at = np.unique(np.concatenate([node[u], node[v]]), return_inverse=True)
                more = np.zeros(len(ends), np.int64)
                np.add.at(more, at, np.concatenate([copies[v], copies[u]]))
                low, high = forest(node[u], node[v])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([ends, low])), pa.concat_arrays([pa.nulls(len(ends), pa.int64()), pa.array(high)]),
                    pa.array(np.concatenate([more, np.zeros(len(low), np.int64)]))], ["u", "v", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verifiers: dict[int, Verifier] = {}
        rest = None  # the last group seen may go on in the next batch; it has two parts at most
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            last = np.ones(batch.num_rows, bool)
            for c in range(4):
                column = batch.column(c).to_numpy()
                last &= column == column[-1]
            cut = batch.num_rows - int(last.sum())
            if cut:
                yield from verify(batch.slice(0, cut), verifiers)
            rest = batch.slice(cut)
            release()
        if rest is not None:
            yield from verify(rest, verifiers)

    return groups.mapInArrow(run, "u long, v long, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    tables: int = TABLES, functions: int = FUNCTIONS, probes: int = PROBES, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: (id, n_links, component_id, kept).

    n_links counts the other rows whose vector has a cosine of ``cosine`` or
    more with this one's; component_id is the smallest id reachable over such
    links, itself included; kept says that it is its own.  Pairs are found if
    they share a bucket: with the defaults 0.9999 of those at the threshold in
    64 dimensions, more of closer ones (tests measure it).  Links are never
    wrong, and equal vectors always link.

    A vector that is null, empty, all zeros, or holds null or non-finite
    components links with nothing, vectors of different lengths neither: n_links
    0, component_id its own id.  A null id is never a component_id unless the
    whole component has none, and is not kept.  Repeated ids keep their rows.
    Ids may be of any ordered type.  An empty table gives an empty one; other
    columns are not read.
    """
    hashing = (tables, functions, probes)
    rows, dtype = _rows(vectors, id_col, vector_col)
    rows = materialise(rows, "vectors-rows")
    folded = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    distinct = materialise(folded.select(F.monotonically_increasing_id().alias("node"), "digest", "least", "copies",
                                         F.octet_length("vector").cast("long").alias("size"), "vector"), "vectors-distinct")
    members = _members(distinct, dtype, tile, *hashing)
    found = materialise(_links(members, distinct, dtype, cosine, *hashing), "vectors-links")
    links = found.filter("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    roots = connected_components(found.filter("v IS NOT NULL").select("u", "v"))
    nodes = distinct.select("node", "digest", "least", "copies").join(roots, "node", "left").join(links, "node", "left")
    nodes = materialise(nodes, "vectors-nodes")
    least = nodes.filter("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("of_component"))
    # written, so that the join below is of two plain exchanges and AQE may split a hot vector
    named = materialise(nodes.join(least, "root", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("of_component", "least").alias("component")), "vectors-components")
    out = rows.select("id", "digest").join(named, "digest", "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
