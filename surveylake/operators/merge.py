"""Month replacement, key upsert and change detection.

Month keys.  Every month operator compares ``trunc(to_date(m), 'MM')``.  The
set of distinct month keys of a source is bounded by its type: a DATE
truncated to the month has at most 12 x 9,999 values, so the month relation
is at most ~120k tiny rows whatever the data volume.  That bound is what
makes the explicit ``broadcast`` below safe; the big side (the destination
table) is then filtered map-side, with no shuffle of its rows.  A NULL month
never matches, so NULL-month rows are always kept (anti) / never kept (semi).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "__month"
HIT = "__hit"

# --- fixed values -----------------------------------------------------------
# NULL sentinel per master type used by the change predicate (sentinel mode).
CHANGE_SENTINELS = {
    "INT64": 0,
    "FLOAT64": 0,
    "DATETIME": "9999-12-31 00:00:00",
    "DATE": "9999-12-31",
    "BOOL": False,
}
CHANGE_SENTINEL_OTHER = ""
# ----------------------------------------------------------------------------


def month_key(df: DataFrame, column: str) -> Column:
    """``trunc(DATE(m), 'MM')`` for a DATE, TIMESTAMP or text month column.

    Text that is not a date gives a NULL month (kept by anti joins) rather
    than failing the job.
    """
    name = next((f.name for f in df.schema.fields if f.name.lower() == column.lower()), column)
    c = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        d = F.try_to_date(c)
    elif isinstance(dtype, T.DateType):
        d = c
    else:
        d = F.to_date(c)
    return F.trunc(d, "MM")


def distinct_months(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL month keys (partial aggregation before the shuffle)."""
    return df.select(month_key(df, column).alias(MONTH)).where(F.col(MONTH).isNotNull()).distinct()


def _months_of(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    parts = [distinct_months(df, col) for df, col in sources]
    return reduce(DataFrame.union, parts).distinct() if len(parts) > 1 else parts[0]


def _month_join(df: DataFrame, column: str, months: DataFrame, how: str) -> DataFrame:
    m = F.broadcast(months.alias("__m"))
    return df.join(m, month_key(df, column) == F.col(f"__m.{MONTH}"), how)


def drop_months(dest: DataFrame, dest_month: str, source: DataFrame | Sequence[tuple[DataFrame, str]],
                source_month: str | None = None) -> DataFrame:
    """Rows of ``dest`` whose month is absent from the source(s).

    Same rows as ``DELETE FROM dest WHERE EXISTS (same calendar month in
    source)``; plans as a broadcast hash LeftAnti join.
    """
    sources = [(source, source_month or dest_month)] if isinstance(source, DataFrame) else list(source)
    return _month_join(dest, dest_month, _months_of(sources), "left_anti")


def keep_months(dest: DataFrame, dest_month: str, source: DataFrame,
                source_month: str | None = None) -> DataFrame:
    """Rows of ``dest`` whose month is present in ``source`` (LeftSemi)."""
    return _month_join(dest, dest_month, distinct_months(source, source_month or dest_month), "left_semi")


def update_months(dest: DataFrame, dest_month: str, source: DataFrame,
                  assignments: Mapping[str, Column], source_month: str | None = None) -> DataFrame:
    """``UPDATE dest SET c = v WHERE EXISTS (same month in source)``.

    Left join to the (distinct, so non-duplicating) month set; matched rows
    take the new values, all other rows pass through unchanged.
    """
    months = distinct_months(source, source_month or dest_month).withColumn(HIT, F.lit(True))
    j = _month_join(dest.alias("__d"), dest_month, months, "left")
    hit = F.coalesce(F.col(f"__m.{HIT}"), F.lit(False))
    cols = []
    for c in dest.columns:
        cur = F.col(f"__d.`{c}`")
        cols.append((F.when(hit, assignments[c]).otherwise(cur) if c in assignments else cur).alias(c))
    return j.select(*cols)


def month_replace(dest: DataFrame | None, sources: Sequence[tuple[DataFrame, str]],
                  dest_month: str | None = None, tag: str | None = None,
                  tags: Sequence[str] | None = None) -> DataFrame:
    """C4: replace whole calendar months of ``dest`` by the sources, in order.

    Equivalent to running, for each source in turn, "delete the source's
    months from dest; insert the source" -- so when several sources hold the
    same month only the *last* one survives -- but computed in one plan:

        dest |> months(all sources)  U  src_i |> months(src_{i+1..n})  U  src_n

    NULL-month rows are never deleted and always appended.  ``tag`` adds a
    column naming where each row came from (``tags`` = names, dest first).
    """
    if not sources:
        raise ValueError("month_replace needs at least one source")
    names = list(tags) if tags else ["dest"] + [f"source{i + 1}" for i in range(len(sources))]
    parts: list[DataFrame] = []
    if dest is not None:
        part = drop_months(dest, dest_month or sources[0][1], list(sources))
        parts.append(part.withColumn(tag, F.lit(names[0])) if tag else part)
    for i, (src, col) in enumerate(sources):
        later = list(sources[i + 1:])
        part = drop_months(src, col, later) if later else src
        parts.append(part.withColumn(tag, F.lit(names[i + 1])) if tag else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def upsert_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7: replace rows of ``old`` by key with the rows of ``new``.

    ``DELETE FROM old WHERE key IN new; INSERT new`` as one plan: a
    LeftAnti join on the keys then a union.  Only the *distinct* key columns
    of ``new`` are shuffled (duplicates collapse map-side, so a key repeated
    in a third of the new rows costs one row); a hot key on the ``old`` side
    is split by AQE's skew-join handling.  A NULL key never matches, so such
    old rows are kept.
    """
    nk = (new.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
          .distinct().alias("__nk"))
    cond = reduce(lambda a, b: a & b, [F.col(f"__old.`{k}`") == F.col(f"__nk.__k{i}")
                                       for i, k in enumerate(keys)])
    kept = old.alias("__old").join(nk, cond, "left_anti")
    return kept.unionByName(new.select(*[f"`{c}`" for c in old.columns]))


def key_condition(a: str, b: str, keys: Sequence[str]) -> Column:
    """``A.k1 = B.k1 AND A.k2 = B.k2 ...`` over two frame aliases."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.`{k}`") == F.col(f"{b}.`{k}`") for k in keys])


def change_predicate(a: str, b: str, fields: Mapping[str, str],
                     mode: str = "sentinel") -> Column:
    """OR over non-key columns of "value differs".

    ``sentinel``: ``COALESCE(A.c, s) <> COALESCE(B.c, s)`` with a per-type
    sentinel (so NULL and the sentinel compare equal, as in the source
    system).  ``null_safe``: ``NOT (A.c <=> B.c)``.
    """
    terms = []
    for name, master in fields.items():
        ca, cb = F.col(f"{a}.`{name}`"), F.col(f"{b}.`{name}`")
        if mode == "null_safe":
            terms.append(~ca.eqNullSafe(cb))
        else:
            terms.append(comparable(ca, master, mode) != comparable(cb, master, mode))
    return reduce(lambda x, y: x | y, terms) if terms else F.lit(False)


def comparable(c: Column, master: str, mode: str) -> Column:
    """A compared value: NULL stands for the type's sentinel, or for itself."""
    if mode == "null_safe":
        return c
    s = F.lit(CHANGE_SENTINELS.get(master.upper(), CHANGE_SENTINEL_OTHER))
    if master.upper() == "DATE":
        s = s.cast("date")
    elif master.upper() == "DATETIME":
        s = s.cast(T.TimestampNTZType())
    return F.coalesce(c, s)


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Mapping[str, str],
                 mode: str = "sentinel") -> DataFrame:
    """J4+J5: rows of ``new`` whose key exists in ``old`` with different values.

    The old side is reduced to one row per key before the join, with partial
    aggregation: the smallest and the largest of its versions (compared
    columns, with the mode's stand-ins for NULL).  A new row differs from some
    version if it differs from the smallest or the largest -- if these are not
    the same, every row does.  So no key ever brings more than one old row,
    each new row is returned at most once, and each side is exchanged once.
    With unique keys this is exactly the ``A JOIN B ON keys WHERE <change>`` of
    the source system.
    """
    if not fields:
        return new.where(F.lit(False))
    version = F.struct(*[comparable(F.col(f"`{c}`"), t, mode).alias(f"v{i}") for i, (c, t) in enumerate(fields.items())])
    versions = old.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min(version).alias("__lo"), F.max(version).alias("__hi"))
    own = F.struct(*[comparable(F.col(f"__new.`{c}`"), t, mode).alias(f"v{i}") for i, (c, t) in enumerate(fields.items())])
    cond = reduce(lambda a, b: a & b, [F.col(f"__new.`{k}`") == F.col(f"__old.__k{i}") for i, k in enumerate(keys)])
    differs = ~own.eqNullSafe(F.col("__old.__lo")) | ~own.eqNullSafe(F.col("__old.__hi"))
    return new.alias("__new").join(versions.alias("__old"), cond & differs, "left_semi")


def changed_pairs(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Mapping[str, str],
                  mode: str = "sentinel") -> DataFrame:
    """J4 + J5 as the source system states them, for keys that are unique in
    both: ``A JOIN B ON keys WHERE <change>``; the key columns, and of every
    compared field the old value, as ``old_<field>``, and the new one."""
    joined = old.alias("__a").join(new.alias("__b"), key_condition("__a", "__b", keys) & change_predicate("__a", "__b", fields, mode))
    return joined.select(*[F.col(f"__b.`{k}`") for k in keys],
                         *[F.col(f"__a.`{c}`").alias(f"old_{c}") for c in fields], *[F.col(f"__b.`{c}`") for c in fields])
