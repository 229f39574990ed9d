"""The cascade is exact over its universe, and rules win over it."""

import random

from pyspark.sql import functions as F

from surveylake.llm import urlfilter
from surveylake.llm.queries import NAMES, RULES


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_cascade_is_exact(spark):
    rng = random.Random(9)
    universe = [f"{rng.getrandbits(40):x}.example.org" for _ in range(6000)]
    for share in (0, 1, 30, 3000, 6000):
        listed = set(universe[:share])
        cascade = urlfilter.build_cascade(keys(spark, [*listed, "elsewhere", None, *list(listed)[:5]]),
                                          keys(spark, [*universe, universe[0], None]))
        found = keys(spark, universe).select("key", cascade.holds(F.col("key")).alias("hit")).collect()
        assert {r.key for r in found if r.hit} == listed
        if share == 3000:
            assert len(cascade.levels) > 3


def test_shards_change_no_verdict(spark):
    pages = spark.createDataFrame([(1, "http://a.b.c/x"), (1, "http://a.b.c/x"), (2, "https://b.c"), (3, "http://xb.c/"), (5, "http://p.q/r?s"),
                                   (6, "http://p.q/rr"), (4, None), (None, "ftp://Q.B.C?x")], "page_id long, url string")
    listed = keys(spark, ["b.c", "zzz", None, "p.q/r", *(f"k{i}.net" for i in range(40))])
    assert urlfilter.shards_of(41, 1 << 20) == 1 and urlfilter.shards_of(41, 128) > 3
    found = [sorted(urlfilter.judge(pages, [], listed, max_bits=bits).collect(), key=str) for bits in (1 << 20, 128)]
    assert found[0] == found[1]
    assert {(r.page_id, r.verdict) for r in found[0]} == {(1, "block"), (2, "block"), (3, "allow"), (5, "block"), (6, "allow"),
                                                          (4, "allow"), (None, "block")}


def test_listed_keys_of_shards_are_exact(spark):
    rng = random.Random(9)
    universe = [f"{rng.getrandbits(40):x}.example.org" for _ in range(3000)]
    listed = set(universe[:700])
    found = urlfilter.listed_keys(keys(spark, universe), keys(spark, [*listed, "elsewhere", None]), 3)
    assert sorted(r.key for r in found.collect()) == sorted(listed)


def test_listed_keys_come_from_the_pages(spark):
    """All domains of a name whatever follows, and the pages below them; the list
    grows with the table, and its cascade has several levels."""
    pages = spark.createDataFrame([("http://m.free-bets.a.example.net/x?q",), ("http://free-bets.org",), ("http://x.org/free-bets",), (None,)],
                                  "url string")
    got = {r.key for r in urlfilter.named_keys(pages, NAMES).collect()}
    assert got == {"free-bets.a.example.net", "m.free-bets.a.example.net/x", "free-bets.org", "free-bets.org/"}
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    listed = urlfilter.named_keys(pages, NAMES)
    rows = pages.select(urlfilter.host_of(F.col("url")).alias("h"), urlfilter.path_of(F.col("url")).alias("p"))
    universe = rows.select(F.explode(urlfilter.keys_of(F.col("h"), F.col("p"))).alias("key")).distinct()
    cascade = urlfilter.build_cascade(listed, universe)
    assert listed.count() > 100 and len(cascade.levels) > 1
    assert universe.filter(cascade.holds(F.col("key"))).exceptAll(listed).count() == 0


def test_hosts_paths_and_rules(spark):
    rows = [("http://Example.ORG/es/x?q#f", "example.org", "/es/x", "example.org/es/", "block"),
            ("http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
            ("http://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
            ("http://notexample.org", "notexample.org", "", None, "allow"),
            ("http://spam-farm.example.org?x=/", "spam-farm.example.org", "", None, "block"),
            ("http://spam-farm.example.org/", "spam-farm.example.org", "/", "org/", "allow"),
            ("x://www.free-bets.example.net#/", "www.free-bets.example.net", "", None, "block"),
            ("x://a.com/de/", "a.com", "/de/", "com/de/", "block"), ("x://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"),
            ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"), ("a.com/de/", "", "", None, "allow"), ("", "", "", None, "allow"),
            ("://", "", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"), (None, "", "", None, "allow")]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string").withColumn(
        "host", F.lit("clash")).withColumn("verdict", F.lit(0))
    got = {r.page_id: tuple(r[1:]) for r in urlfilter.judge(pages, RULES, urlfilter.named_keys(pages, NAMES)).collect()}
    assert got == {i: r[1:] for i, r in enumerate(rows)}


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge(pages, RULES, urlfilter.named_keys(pages, NAMES)).collect() == []
