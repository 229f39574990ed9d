"""The registered queries against their SQL, and the pipeline stage by stage."""

import re

import pyarrow as pa
import pytest
from helpers import SF, nasty
from pyspark.sql import functions as F

import corpus_pipeline
from surveylake.llm import queries
from surveylake.plans.verify import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    ok, message = compare(queries.queries()[name](spark, SF), duckdb_connection(SF), queries.oracle_sql()[name])
    assert ok, message


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]


def stages(spark, docs, keep=lambda df, name: df):
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, docs, SF), name)
        yield name, docs, out
        docs = out


def test_pipeline(spark):
    from surveylake.llm.common import materialise
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, before, after in stages(spark, docs, materialise):
        seen.append(name)
        if name == "packing":
            assert after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).filter(
                "n <> m").count() == 0
            assert after.select("doc_id").distinct().count() == before.count()
        else:
            assert after.columns == docs.columns and 0 < after.count() <= before.count()
            assert after.join(before, "doc_id", "left_anti").count() == 0
    assert seen == ["language", "lines", "near_duplicates", "decontamination", "packing"]


def test_pipeline_keeps_what_brute_force_keeps(spark):
    """Rows and texts after each stage, from the same input: language by its
    definition, lines and benchmark passages by SQL, near copies by all pairs."""
    import duckdb
    from test_simhash import components, plain_fingerprint

    from surveylake.llm import langid
    from surveylake.llm.common import materialise
    word = re.compile(r"[^\x20\x09-\x0D]+")
    n_words = lambda t: len(word.findall(t))

    def sql(rows, text):
        con = duckdb.connect()
        con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": pa.array([t for _, t in rows], pa.string())}))
        con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
        return con.execute(text).fetchall(), [c[0] for c in con.description]

    def lines(rows):
        found, names = sql(rows, queries.OP9_SQL)
        of = {r[names.index("doc_id")]: (r[names.index("text")], r[names.index("n_deleted")]) for r in found}
        return [(i, of[i][0]) for i, t in rows if not of[i][1] or n_words(t) - n_words(of[i][0]) < 0.8 * n_words(t)]

    def near(rows):
        fps = {i: plain_fingerprint(t) for i, t in rows}
        root = components(set(fps.values()), 3)
        least = {}
        for i, f in fps.items():
            least[root[f]] = min(i, least.get(root[f], i))
        return [(i, t) for i, t in rows if least[root[fps[i]]] == i]

    def clean(rows):
        found, names = sql(rows, queries.OP3_SQL)
        hit = {r[names.index("doc_id")]: r[names.index("contaminated")] for r in found}
        return [(i, t) for i, t in rows if not hit[i]]

    plain = {"language": lambda rows: [(i, t) for i, t in rows if t and langid.WORD.search(t.lower())], "lines": lines,
             "near_duplicates": near, "decontamination": clean}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, before, after in stages(spark, docs, materialise):
        if name in plain:
            pairs = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
            assert sorted(pairs(after)) == sorted(plain[name](pairs(before))), name


def test_pipeline_on_nasty_rows(spark):
    for name, before, after in stages(spark, nasty(spark)):
        assert name == "packing" or after.columns == before.columns
    assert after.count() > 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, _, after in stages(spark, docs):
        assert after.count() == 0
