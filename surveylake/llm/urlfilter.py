"""URL filter: prefix rules, then an exact Bloom filter cascade.

Level 0 is a Bloom filter of the listed keys.  Its false positives among the
corpus's complete key universe are encoded by level 1, the listed keys which
level 1 wrongly claims by level 2, and so on until a level makes no mistake.
For every key of the universe the first level that misses it tells exactly
whether it is listed, so urls are judged in the scan, without a join.

A cascade is as large as an expression may carry.  More listed keys than that
are dealt to shards by a hash of the key, each with a cascade of its own over
its part of the universe; keys are then judged shard by shard.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.session import scratch_path

from .common import LOWER, UPPER, materialise

#: Bits of level 0 that an expression may carry (4 MB; the other levels are a few per cent more).
MAX_BITS = 1 << 25
FIRST_RATE, NEXT_RATE = 0.01, 0.5


@dataclass
class Rule:
    host: str
    path: str
    verdict: str

    @classmethod
    def of(cls, text: str, verdict: str) -> "Rule":
        host, _, path = text.partition("/")
        return cls(host, "/" + path, verdict)

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains_of(host: Column) -> Column:
    """A host and every parent domain, longest first."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(labels, i, size - i + 1), ".")))


def keys_of(host: Column, path: Column) -> Column:
    """The keys a list may name a page by: its host, every parent domain, and
    its address, ``host/path`` (a host without a path has the address ``host/``)."""
    address = F.concat(host, F.when(path == "", "/").otherwise(path))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(domains_of(host), F.array(address)))


def named_keys(pages: DataFrame, names: list[str], url_col: str = "url") -> DataFrame:
    """(key): every domain of the pages' urls whose first label is one of
    ``names``, whatever follows, and the address of every page below such a
    domain.  It grows with the pages."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    named = F.filter(domains_of(F.col("host")), lambda d: F.substring_index(d, ".", 1).isin(names))
    return (rows.withColumn("named", named).filter(F.size("named") > 0)
            .select(F.explode(F.concat("named", F.slice(F.reverse(keys_of(F.col("host"), F.col("path"))), 1, 1))).alias("key"))
            .distinct())


@dataclass
class Level:
    bits: int
    hashes: int
    seed: int
    words: list[int]

    def _spots(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed), F.lit(i), key), F.lit(self.bits).cast("long"))
                for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")  # folded once, by the optimizer
        found = F.lit(True)
        for spot in self._spots(key):
            word = F.get(words, F.shiftright(spot, 6).cast("int"))
            found = found & (F.getbit(word, spot.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found


def _size(n: int, rate: float) -> tuple[int, int]:
    """(bits, hashes) of a level of ``n`` keys."""
    hashes = max(1, round(-math.log2(rate)))
    return 64 * math.ceil(max(64, n * hashes / math.log(2)) / 64), hashes


def _level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    level = Level(*_size(n, rate), seed, [])
    spots = keys.select(F.explode(F.array(*level._spots(F.col("key")))).alias("spot"))
    found = (spots.groupBy(F.shiftright("spot", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 AS INT))")).alias("word")).toArrow())
    words = np.zeros(level.bits // 64, np.int64)
    words[found.column("at").to_numpy()] = found.column("word").to_numpy()
    level.words = words.tolist()
    return level


@dataclass
class Cascade:
    levels: list[Level]

    def holds(self, key: Column) -> Column:
        """Whether ``key``, one of the universe, is listed."""
        found = F.lit(len(self.levels) % 2 == 1)  # held by every level
        for i, level in reversed(list(enumerate(self.levels))):
            found = F.when(~level.holds(key), i % 2 == 1).otherwise(found)
        return found


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade over (key) tables.

    Only bit words reach the driver.  Each level holds a fixed share of the one
    before, so the number of levels is logarithmic; null keys are never listed.
    """
    universe = universe.select("key").dropna().distinct().cache()
    listed = listed.select("key").dropna().distinct()
    sides = [universe.join(listed, "key", "left_semi"), universe.join(listed, "key", "left_anti")]
    levels: list[Level] = []
    while n := sides[len(levels) % 2].count():  # a cascade is exact only when no key is left
        turn, rate = len(levels) % 2, NEXT_RATE if levels else FIRST_RATE
        levels.append(_level(sides[turn], n, rate, len(levels)))
        # the other side's keys that this level wrongly holds come next
        sides[1 - turn] = sides[1 - turn].filter(levels[-1].holds(F.col("key")))
    universe.unpersist()
    return Cascade(levels)


def shards_of(n_listed: int, max_bits: int = MAX_BITS) -> int:
    """Cascades that hold so many listed keys with at most ``max_bits`` bits of
    level 0 each, a quarter to spare for uneven shards."""
    return max(1, math.ceil(1.25 * _size(n_listed, FIRST_RATE)[0] / max_bits)) if n_listed else 1


def listed_keys(universe: DataFrame, listed: DataFrame, shards: int) -> DataFrame:
    """(key) of the universe that are listed, told by a cascade for each shard.
    Keys are written by shard, so each cascade reads its own."""
    shard = F.pmod(F.xxhash64(F.lit(-1), F.col("key")), F.lit(shards).cast("long")).alias("shard")
    path = scratch_path(universe.sparkSession, "urlfilter-shards")
    sides = []
    for name, keys in (("universe", universe), ("listed", listed)):
        keys.select("key", shard).dropna().distinct().write.partitionBy("shard").parquet(f"{path}/{name}")
        sides.append(universe.sparkSession.read.schema("key string, shard long").parquet(f"{path}/{name}"))
    found = None
    for s in range(shards):
        own, mine = (side.filter(F.col("shard") == s).select("key") for side in sides)
        part = own.filter(build_cascade(mine, own).holds(F.col("key")))
        found = part if found is None else found.unionByName(part)
    return found


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<rule, verdict> of the longest rule that fits (of two as long, the
    one with the longer host), or null."""
    ordered = sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text), reverse=True)
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
          max_bits: int = MAX_BITS) -> DataFrame:
    """One row per page: (id_col, host, path, rule, verdict).

    A fitting rule decides; else the page is blocked if its host, a parent
    domain or its address is listed (``listed``: key), else allowed.  A null
    url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed.  Repeated rows and null ids are kept; an empty table gives an empty
    one.  ``max_bits`` sets how many cascades share the listed keys, and changes
    no verdict.
    """
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = keys_of(F.col("host"), F.col("path"))
    universe = rows.select("host", "path").distinct().select(F.explode(keys).alias("key")).distinct()
    listed = materialise(listed.select("key").dropna().distinct(), "urlfilter-listed")
    shards = shards_of(listed.count(), max_bits)
    if shards == 1:
        judged = rows.withColumn("hit", F.exists(keys, build_cascade(listed, universe).holds))
    else:
        # each page asks for its keys where their cascade is
        hit = materialise(listed_keys(universe, listed, shards), "urlfilter-hits")
        pairs = rows.select("host", "path").distinct().select("host", "path", F.explode(keys).alias("key"))
        blocked = materialise(pairs.join(hit, "key", "left_semi").select("host", "path").distinct(), "urlfilter-blocked")
        judged = rows.join(blocked.withColumn("hit", F.lit(True)), ["host", "path"], "left")
    judged = judged.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    return judged.select(id_col, "host", "path", "best.rule", F.coalesce(
        "best.verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))
