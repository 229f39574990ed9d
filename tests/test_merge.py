import datetime as dt
import random

from pyspark.sql import functions as F

from surveylake.operators import merge as Mg

SCHEMA = "id bigint, m date, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def naive_replace(dest, sources):
    """The source system's sequence: per source, delete its months, insert it."""
    table = list(dest)
    for src in sources:
        months = {(r[1].year, r[1].month) for r in src if r[1] is not None}
        table = [r for r in table if r[1] is None or (r[1].year, r[1].month) not in months]
        table += list(src)
    return sorted(table, key=repr)


def rand_rows(rng, n, tag):
    out = []
    for i in range(n):
        m = None if rng.random() < 0.1 else dt.date(2024, rng.randint(1, 6), rng.randint(1, 28))
        out.append((i, m, f"{tag}{i}"))
    return out


def test_month_replace_equals_sequential_deletes(spark):
    rng = random.Random(7)
    for _ in range(25):
        dest = rand_rows(rng, rng.randint(0, 12), "d")
        raw = rand_rows(rng, rng.randint(0, 8), "r")
        sql = rand_rows(rng, rng.randint(0, 8), "s")
        got = Mg.month_replace(frame(spark, dest), [(frame(spark, raw), "m"), (frame(spark, sql), "m")], "m")
        assert sorted(map(tuple, got.collect()), key=repr) == naive_replace(dest, [raw, sql])


def test_second_source_wins_shared_month(spark):
    d = frame(spark, [(1, dt.date(2024, 1, 3), "d")])
    r = frame(spark, [(2, dt.date(2024, 1, 9), "r"), (3, dt.date(2024, 2, 9), "r")])
    s = frame(spark, [(4, dt.date(2024, 1, 20), "s")])
    got = {tuple(x) for x in Mg.month_replace(d, [(r, "m"), (s, "m")], "m", tag="o").select("id", "o").collect()}
    assert got == {(3, "source1"), (4, "source2")}


def test_month_ops_plan_broadcasts_months(spark):
    d = frame(spark, [(1, dt.date(2024, 1, 3), "d")])
    s = frame(spark, [(4, dt.date(2024, 1, 20), "s")])
    plan = Mg.drop_months(d, "m", s)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_keep_and_update_months_with_text_month(spark):
    d = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-02-03"), (3, "bad"), (4, None)], "id int, m string")
    s = spark.createDataFrame([("2024-01-30",)], "m string")
    assert [r.id for r in Mg.keep_months(d, "m", s).orderBy("id").collect()] == [1]
    assert [r.id for r in Mg.drop_months(d, "m", s).orderBy("id").collect()] == [2, 3, 4]
    up = Mg.update_months(d, "m", s, {"m": F.lit("X")}).orderBy("id").collect()
    assert [r.m for r in up] == ["X", "2024-02-03", "bad", None]


def test_upsert_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    got = sorted(map(tuple, Mg.upsert_by_key(old, new, ["k"]).collect()), key=repr)
    assert got == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n")], key=repr)


def test_changed_rows_sentinel_vs_null_safe(spark):
    old = spark.createDataFrame([(1, 0, "x"), (2, 5, "y"), (3, 1, None)], "k int, n bigint, s string")
    new = spark.createDataFrame([(1, None, "x"), (2, 6, "y"), (3, 1, "")], "k int, n bigint, s string")
    types = {"n": "INT64", "s": "STRING"}
    sent = sorted(r.k for r in Mg.changed_rows(old, new, ["k"], types).collect())
    safe = sorted(r.k for r in Mg.changed_rows(old, new, ["k"], types, mode="null_safe").collect())
    assert sent == [2]
    assert safe == [1, 2, 3]


def test_hot_key_does_not_multiply_rows(spark):
    old = spark.range(3000).selectExpr("1 AS k", "5 AS n", "'x' AS s")   # one key, 3000 identical copies
    new = spark.createDataFrame([(1, 6, "x"), (2, 1, "y")], "k int, n int, s string")
    got = Mg.changed_rows(old, new, ["k"], {"n": "INT64", "s": "STRING"}).collect()
    assert [tuple(r) for r in got] == [(1, 6, "x")]
    hot_new = spark.range(3000).selectExpr("1 AS k", "CAST(id AS STRING) AS v")
    old2 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = Mg.upsert_by_key(old2, hot_new, ["k"])
    assert out.count() == 3001 and out.where("k = 2").count() == 1


def test_keep_months_prunes_month_partitions(spark, tmp):
    from surveylake.sinks.writers import with_month_partition
    rows = [(i, dt.date(2024, 1 + i % 6, 1 + i % 27), "x") for i in range(60)]
    with_month_partition(frame(spark, rows), "m").write.partitionBy("month_key").parquet(f"{tmp}/t")
    dest = spark.read.parquet(f"{tmp}/t")
    frame(spark, [(1, dt.date(2024, 2, 10), "s"), (2, dt.date(2024, 9, 1), "t")]).write.parquet(f"{tmp}/s")
    src = spark.read.parquet(f"{tmp}/s").where(F.col("v") == "s")   # a selective source, as a load is
    out = Mg.keep_months(dest, "month_key", src, "m")
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "dynamicpruningexpression" in plan          # only February's partition is read
    assert {r.m.month for r in out.collect()} == {2}
