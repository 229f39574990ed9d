"""Loads that must lose nothing and double nothing."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.operators.nested import DocumentLayout, decode_children, decode_documents, read_xml_children, rejected_rows
from surveylake.plans import flows
from surveylake.plans import incremental as I
from surveylake.schema import Field, SchemaDocument
from surveylake.sources.documents import landed_files, literal_path, read_envelope, with_number

S = T.StringType()
LAYOUT = DocumentLayout("R", "S", ["H"], ["B"], [], T.StructType([
    T.StructField("H", T.StructType([T.StructField("ID", S)])),
    T.StructField("B", T.ArrayType(T.StructType([T.StructField("V", S)])))]))
TABLES = {"H": SchemaDocument("T_HEAD", [Field("ID")])}


def child(i, more=""):
    return f"<n0:S><H><ID>{i}</ID></H>{more}</n0:S>"


def encoded(text):
    return base64.b64encode(text.encode()).decode()


DOCUMENTS = {
    "good": (f"<n0:R>{child(1)}{child(2)}</n0:R>", None),
    "comment": (f"<?xml version='1.0'?><n0:R>{child(3)}</n0:R>\n<!-- a > b --><?x y?> ", None),
    "ampersand": (f"<n0:R>{child(4)}{child('a & b')}</n0:R>", "xml"),
    "other tag": (f"<n0:R>{child(5)}<n0:S><H><ID>6</ID></G></n0:S></n0:R>", "xml"),
    "not declared": (f"<n0:R>{child(7)}<X>a & b</X></n0:R>", "xml"),
    "in a body": (f"<n0:R>{child(8)}{child(9, '<B><V>x < y</V></B>')}</n0:R>", "xml"),
    "cut off": (f"<n0:R>{child(10)}{child(11)}", "xml"),
    "junk after": (f"<n0:R>{child(12)}</n0:R>junk", "xml"),
    "second root": (f"<n0:R>{child(13)}</n0:R><n0:R>{child(14)}</n0:R>", "xml"),
    "no child": ("<n0:R></n0:R>", "xml"), "empty": ("", "xml"),
}


def test_a_document_counts_as_a_whole_or_not_at_all(spark):
    rows = [(k, encoded(x)) for k, (x, _) in DOCUMENTS.items()] + [("no base64", "%%%"), ("null", None)]
    docs = spark.createDataFrame(rows, "doc_key string, payload string")
    for tables in (None, ["H"]):
        decoded = decode_documents(docs, LAYOUT, tables=tables)
        assert sorted(int(r.ID) for r in decoded["H"].collect()) == [1, 2, 3]
        found = {r.doc_key: (r.reason, r.payload) for r in rejected_rows(decoded["__parsed"]).collect()}
        want = {k: (why, dict(rows)[k]) for k, (_, why) in DOCUMENTS.items() if why}
        assert found == want | {"no base64": ("base64", "%%%"), "null": ("base64", None)}
    with pytest.raises(Exception, match="does not decode"):
        decode_documents(docs.where("doc_key = 'ampersand'"), LAYOUT, strict=True)["H"].collect()


def test_rows_of_one_file_are_told_apart_without_shuffling_them(spark, tmp):
    os.makedirs(f"{tmp}/x")
    with open(f"{tmp}/x/a.xml", "w") as f:
        f.write("<R>" + "".join(f"<S><H><ID>{i % 7}</ID></H></S>" for i in range(20)) + "<S><H><ID>a & b</ID></H></S></R>")
    with open(f"{tmp}/x/b.xml", "w") as f:
        f.write("<R><S><H><ID>0</ID></H></S></R>")
    subs = read_xml_children(spark, f"{tmp}/x", LAYOUT)
    head = decode_children(subs, LAYOUT)["H"]
    rows = head.select("UUID", "ID").collect()
    assert len(rows) == len({r.UUID for r in rows}) == 21
    assert [r.rejected is not None for r in subs.where("rejected IS NOT NULL").collect()] == [True]
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    with pytest.raises(Exception, match="broken child"):
        decode_children(read_xml_children(spark, f"{tmp}/x", LAYOUT, strict=True), LAYOUT)["H"].collect()


def test_numbers_of_equal_rows(spark, tmp):
    spark.createDataFrame([("f" if i % 2 else "g", "abcab"[i % 5]) for i in range(40)], "name string, t string").repartition(3) \
        .write.parquet(f"{tmp}/t")
    out = with_number(spark.read.parquet(f"{tmp}/t"), "name", F.col("t"))
    got = sorted((r.name, r.t, r.number) for r in out.collect())
    assert got == sorted((n, t, k) for n in "fg" for t, m in (("a", 8), ("b", 8), ("c", 4)) for k in range(m))
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def land(path, texts):
    os.makedirs(path, exist_ok=True)
    for name, (text, when) in texts.items():
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
        at = when.replace(tzinfo=dt.timezone.utc).timestamp()
        os.utime(f"{path}/{name}", (at, at))


def response(*ids):
    return json.dumps({"data": [{"interfaceValue": encoded(f"<R><S><H><ID>{i}</ID></H></S></R>")} for i in ids]})


def test_broken_envelopes_are_rows(spark, tmp):
    day = dt.datetime(2024, 1, 2)
    cut = response(5, 6)[:-20]
    land(f"{tmp}/in", {"a.json": (response(1, 2), day), "cut.json": (cut, day), "other.json": ('{"error": 1}', day),
                       "text.json": ('{"data": "x"}', day), "none.json": ('{"data": []}', day)})
    rows = read_envelope(spark, f"{tmp}/in").collect()
    broken = {r.doc_key.rsplit("/", 1)[1]: r.payload for r in rows if r.reason == "envelope"}
    assert set(broken) == {"cut.json", "other.json", "text.json"} and broken["cut.json"] == cut
    assert len([r for r in rows if r.reason is None]) == 2
    land(f"{tmp}/lines", {"a.json": ("\n".join([response(1, 2), cut, response(3), response(3), "", '{"x": 1}']), day)})
    rows = read_envelope(spark, f"{tmp}/lines", multi_line=False).collect()
    assert sorted(str(r.reason) for r in rows) == ["None"] * 4 + ["envelope"] * 2
    assert len({r.doc_key for r in rows}) == 6
    decoded = decode_documents(read_envelope(spark, f"{tmp}/lines", multi_line=False), LAYOUT)
    assert sorted(r.ID for r in decoded["H"].collect()) == ["1", "2", "3", "3"]
    assert [r.reason for r in rejected_rows(decoded["__parsed"]).collect()] == ["envelope"] * 2


def api(spark, tmp, day, **more):
    first = {"fecinicio_query": "20240101", "fecfin_query": "20240105", "interfaz_query": "I"}
    return flows.run_api_documents(spark, f"{tmp}/landing", LAYOUT, TABLES, f"{tmp}/raw", f"{tmp}/exp", f"{tmp}/state", "API",
                                   first, today=dt.date(2024, 1, day), **more)


def loaded(spark, tmp):
    return sorted((r.ID, r.load_id) for r in spark.read.parquet(f"{tmp}/raw/T_HEAD").collect())


def cursor(spark, tmp):
    return I.load_watermark(spark, f"{tmp}/state", "API")[I.CURSOR_KEY]


def test_api_loads(spark, tmp):
    """Late files, odd names, empty windows, broken responses, retries, a clock set back."""
    land(f"{tmp}/landing", {"a[1].json": (response(1), dt.datetime(2024, 1, 4)), "old.json": (response(9), dt.datetime(2023, 12, 1))})
    assert api(spark, tmp, 5) == {"T_HEAD": 1, "__rejected": 0}
    land(f"{tmp}/landing", {"late {x}.json": (response(2), dt.datetime(2024, 1, 3)), "cut.json": (response(7, 8)[:-30], dt.datetime(2024, 1, 5))})
    assert api(spark, tmp, 6) == {"T_HEAD": 1, "__rejected": 1}
    assert [r.reason for r in spark.read.parquet(f"{tmp}/raw/API_REJECTS").where("load_id = 'API-2'").collect()] == ["envelope"]
    assert loaded(spark, tmp) == [("1", "API-1"), ("2", "API-2")]
    at = cursor(spark, tmp)
    assert at == "2024-01-06T00:00:00"
    for day in (8, 2):  # nothing new, and a clock that was set back
        assert api(spark, tmp, day) == {} and cursor(spark, tmp) == at
    # a load that fails after RAW was written is taken up under its own number
    land(f"{tmp}/landing", {"b.json": (response(3), dt.datetime(2024, 1, 8))})
    enter = I.enter_files
    I.enter_files = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            api(spark, tmp, 9)
    finally:
        I.enter_files = enter
    land(f"{tmp}/landing", {"c.json": (response(4), dt.datetime(2024, 1, 8))})
    assert cursor(spark, tmp) == at and api(spark, tmp, 9) == {"T_HEAD": 2, "__rejected": 0}
    assert loaded(spark, tmp) == [("1", "API-1"), ("2", "API-2"), ("3", "API-3"), ("4", "API-3")]
    # a clock that was set back: the cursor stays
    land(f"{tmp}/landing", {"d.json": (response(5), dt.datetime(2024, 1, 7))})
    assert api(spark, tmp, 3)["T_HEAD"] == 1 and cursor(spark, tmp) == "2024-01-09T00:00:00"


def test_two_landings_and_an_api_share_raw(spark, tmp):
    for x in "ab":
        os.makedirs(f"{tmp}/in_{x}")
        with open(f"{tmp}/in_{x}/d.xml", "w") as f:
            f.write(f"<n0:R>{child(x)}</n0:R>")
    land(f"{tmp}/landing", {"a.json": (response("c"), dt.datetime(2024, 1, 4))})
    for _ in range(2):
        for x in "ab":
            flows.stream_document_etl(spark, f"{tmp}/in_{x}", f"{tmp}/ckpt_{x}", LAYOUT, TABLES, f"{tmp}/raw", f"{tmp}/exp", "MANUAL")
        api(spark, tmp, 5)
    assert [x for x, _ in loaded(spark, tmp)] == ["a", "b", "c"]


def test_landed_files_and_literal_paths(spark, tmp):
    land(f"{tmp}/x", {"a[b]*{c}?.txt": ("hello", dt.datetime(2024, 1, 1)), "plain.txt": ("no", dt.datetime(2024, 1, 1))})
    rows = landed_files(spark, f"{tmp}/x", "*.txt").collect()
    assert len(rows) == 2
    odd = next(r.path for r in rows if "plain" not in r.path)
    assert [r.value for r in spark.read.text([literal_path(odd)]).collect()] == ["hello"]


def test_state_versions_and_compaction(spark, tmp):
    path = f"{tmp}/state"
    for day in ("2024-02-01", "2024-01-10", "2024-02-03"):
        I.save_watermark(spark, path, "api", {I.CURSOR_KEY: f"{day}T00:00:00", "day": day})
    I.save_watermark(spark, path, "other", {"k": "v"})
    want = {I.CURSOR_KEY: "2024-02-03T00:00:00", I.START_KEY: "20240201", "day": "2024-02-03"}
    held = I.load_watermark(spark, path, "api")
    assert held | {I.START_KEY: None} == want | {I.START_KEY: None}
    # a row of a clock that ran ahead does not outrank a later save
    ahead = [("api", "day", "ahead", 1, dt.datetime(2099, 1, 1))]
    spark.createDataFrame(ahead, I.WATERMARK_SCHEMA).write.mode("append").parquet(path)
    assert I.load_watermark(spark, path, "api")["day"] == "2024-02-03"
    assert I.compact_state(spark, path) >= 5
    assert len(spark.read.parquet(path).inputFiles()) == 1 and I.load_watermark(spark, path, "api") == held
    assert I.compact_state(spark, path) == 0
    I.save_watermark(spark, path, "api", {"day": "next"})
    assert I.load_watermark(spark, path, "api")["day"] == "next"


def test_cursor_never_moves_back():
    saved = {I.CURSOR_KEY: "2024-02-01T00:00:00"}
    w = I.request_window(saved, dt.date(2024, 1, 10))
    assert w.end == dt.datetime(2024, 2, 1) and w.start < w.end
    assert I.advance_watermark(saved, w, dt.date(2024, 1, 10))[I.CURSOR_KEY] == saved[I.CURSOR_KEY]
    early = I.Window(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert I.advance_watermark(saved, early)[I.CURSOR_KEY] == saved[I.CURSOR_KEY]


SHEET = SchemaDocument("SHEET", [Field("identificador_unico", "STRING", True, "X0"), Field("Mes_Encuesta", "DATE", True, "0001-01-01")])


def sheets(spark, tmp, names):
    for name in names:
        for side in (name, f"{name}_SQL"):
            with open(f"{tmp}/{side}.input.schema", "w") as f:
                f.write(SHEET.dumps())
            spark.createDataFrame([(f"{side}-1", "2024-01-05"), (f"{side}-2", "")], "identificador_unico string, Mes_Encuesta string") \
                .write.parquet(f"{tmp}/raw/{side}")
    return spark.createDataFrame([("D", f"T_{n};{n};{n}_SQL", "raw", "prc") for n in names],
                                 "DOMINIO string, TABLA string, DATASET_STAGE string, DATASET_DESTINO string")


def test_a_killed_domain_loop_goes_on(spark, tmp, monkeypatch):
    config = sheets(spark, tmp, "ABC")
    run = lambda: flows.process_domain(spark, config, "D", tmp, tmp, "u")
    replace, calls = flows.W.replace_months, []

    def dies(*a):  # after table B's history, before its months
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return replace(*a)

    monkeypatch.setattr(flows.W, "replace_months", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run()
    monkeypatch.setattr(flows.W, "replace_months", replace)
    assert [r["table"] for r in run()] == ["T_B", "T_C"]
    keys = set()
    for n in "ABC":
        history = spark.read.parquet(f"{tmp}/prc/T_{n}_HISTORY")
        assert history.count() == 4
        keys |= {r.load_key for r in history.collect()}
        assert spark.read.parquet(f"{tmp}/prc/T_{n}").count() == 3   # January of the export, and both rows without a month
    assert len(keys) == 1
    assert [r["table"] for r in run()] == ["T_A", "T_B", "T_C"]       # the next run is a new one
    assert spark.read.parquet(f"{tmp}/prc/T_A_HISTORY").count() == 8


def test_a_killed_table_load_replaces_itself(spark, tmp, monkeypatch):
    sheets(spark, tmp, "A")
    cfg = flows.TableConfig("A", f"{tmp}/raw/A", f"{tmp}/raw/A_SQL", SHEET, SHEET, f"{tmp}/p", f"{tmp}/h", f"{tmp}/e", f"{tmp}/log", "D")
    replace = flows.W.replace_months
    monkeypatch.setattr(flows.W, "replace_months", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="killed"):
            flows.process_table(spark, cfg, "u")
    monkeypatch.setattr(flows.W, "replace_months", replace)
    flows.process_table(spark, cfg, "u")
    assert spark.read.parquet(f"{tmp}/h").count() == 4
    flows.process_table(spark, cfg, "u")
    assert spark.read.parquet(f"{tmp}/h").count() == 8


def partitions(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def test_publish_writes_what_changed(spark, tmp, monkeypatch):
    from surveylake.plans.q_models import ORG_CODES, model_sources
    path, target = f"{tmp}/model", "ReasonDissatisfaction"
    sources = model_sources(spark, "/root/testdata/sf0.001", target)
    publish = lambda s: flows.publish_models(s, target, path, ORG_CODES)
    first = publish(sources)
    before = partitions(path)
    rows = spark.read.parquet(path).count()
    assert first == spark.read.parquet(path).select("Domain", "origin", "survey_month").distinct().count()
    assert publish({k: v.repartition(5) for k, v in sources.items()}) == 0 and partitions(path) == before
    key = sorted(sources)[0]
    one = sources[key].orderBy(*sources[key].columns).limit(1)
    assert publish(sources | {key: sources[key].unionByName(one)}) == 1
    assert spark.read.parquet(path).count() == rows + 1
    # a publish that dies half-way withdraws its partitions' digests: the same rows as before are written again
    replace = flows.W.replace_partitions
    monkeypatch.setattr(flows.W, "replace_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        publish(sources)
    monkeypatch.setattr(flows.W, "replace_partitions", replace)
    assert publish(sources | {key: sources[key].unionByName(one)}) == 1 and publish(sources) == 1
    assert spark.read.parquet(path).count() == rows


def test_a_document_load_caches_nothing_and_writes_compressed(spark, tmp, monkeypatch):
    docs = spark.createDataFrame([("a", encoded(f"<R>{child(1)}</R>")), ("b", "%%%")], "doc_key string, payload string")
    monkeypatch.setattr(type(docs), "persist", lambda *a: pytest.fail("texts are cached"))
    counts = flows.run_document_etl(docs, LAYOUT, TABLES, f"{tmp}/raw", f"{tmp}/exp", "A", dt.datetime(2024, 1, 2))
    assert counts["__rejected"] == 1
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith((".csv.gz", ".json.gz", ".zstd.parquet")) for f in files)
    assert {f.rsplit("/part-", 1)[0].removeprefix(tmp).split("/")[1] for f in files} == {"raw", "exp"}


def test_every_table_of_a_document_load_is_de_duplicated(spark, tmp, monkeypatch):
    from surveylake.operators import nested
    tables = {"H": SchemaDocument("T_HEAD", [Field("UUID"), Field("ID")]),
              "B": SchemaDocument("T_BODY", [Field("UUID"), Field("UUID_HEAD"), Field("V")])}
    body = lambda *vs: f"<R>{child(1, ''.join(f'<B><V>{v}</V></B>' for v in vs))}</R>"
    rows = [("alone", body("a", "a")), ("twice", body("a")), ("twice", body("a")), ("grown", body("a")), ("grown", body("a", "b")),
            ("changed", body("a")), ("changed", body("c")), (None, body("a")), (None, body("a")), ("twice", "<R>")]
    docs = spark.createDataFrame([(k, encoded(x)) for k, x in rows], "doc_key string, payload string")
    for turn, limit in enumerate((10, 0)):   # few keys are shared; more than may be sent to every task
        monkeypatch.setattr(nested, "SHARED_KEYS", limit)
        base = f"{tmp}/{turn}"
        counts = flows.run_document_etl(docs, LAYOUT, tables, f"{base}/raw", f"{base}/exp", "A", dt.datetime(2024, 1, 2))
        assert counts == {"T_HEAD": 9, "T_BODY": 11, "__rejected": 1}
        for name, n in (("T_HEAD", 5), ("T_BODY", 8)):
            raw = spark.read.parquet(f"{base}/raw/{name}")
            assert raw.count() == raw.distinct().count() == n
            assert spark.read.option("header", True).csv(f"{base}/exp/CSV/{name}/*").count() == n
    parsed = nested.parse_documents(docs.where("doc_key = 'alone'"), LAYOUT)
    assert nested.split_by_key(parsed) == (parsed, None)   # no row is shuffled where no key is shared


def test_document_etl_drops_the_rows_of_an_order_that_comes_twice(spark, tmp):
    from surveylake.plans.catalog import oracle_sql, queries
    from surveylake.plans.verify import compare
    import duckdb
    day = dt.datetime(1996, 1, 2)
    sf = orders(spark, tmp, [(k, 7, s, 1.5, day, "4-NOT SPECIFIED") for k, s in ((1, "F"), (1, "F"), (2, "O"), (2, "P"))])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{sf}/orders.parquet/*.parquet'")
    got = queries()["document_etl"](spark, sf)
    assert got.count() == 9
    ok, said = compare(got, con, oracle_sql()["document_etl"])
    assert ok, said


def test_a_document_load_spares_room(spark, tmp, monkeypatch):
    n = 20_000
    xml = F.concat(F.lit("<R>"), F.lit(child("x")), F.lit("</R>"))
    docs = spark.range(n).coalesce(2).select(F.concat(F.lit("d"), "id").alias("doc_key"), F.base64(F.encode(xml, "UTF-8")).alias("payload"))
    tables, seen = {"H": SchemaDocument("T_HEAD", [Field("UUID"), Field("DOCUMENTE_XML_ID")])}, []
    size = lambda path: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-"))
    decode, archive = flows.decode_documents, flows.W.archive_json

    def decoded(docs, layout, parsed_path, strict):
        out = decode(docs, layout, parsed_path=parsed_path, strict=strict)
        seen.extend((parsed_path.removeprefix("file:"), spark.read.parquet(parsed_path).columns))
        return out

    def archived(*a):
        seen.append(os.path.exists(seen[0]))
        return archive(*a)

    monkeypatch.setattr(flows, "decode_documents", decoded)
    monkeypatch.setattr(flows.W, "archive_json", archived)
    flows.run_document_etl(docs, LAYOUT, tables, f"{tmp}/raw", f"{tmp}/exp", "A", dt.datetime(2024, 1, 2))
    # the parsed documents lie aside without the ids that do not compress, and are gone before the archives
    assert seen[1] == ["doc_key", "doc", "reason", "rejected"] and seen[2] is False
    # two ids a row, of 32 bytes if each of 64 hex digits takes four bits
    assert size(f"{tmp}/raw/T_HEAD") < 2 * 34 * n and size(f"{tmp}/exp/CSV") < 2 * 36 * n
    assert spark.read.parquet(f"{tmp}/raw/T_HEAD").distinct().count() == n


def test_documents_are_dealt_out_only_where_few_tasks_would_read_them(spark, tmp):
    from surveylake.plans.q_documents import order_documents
    day = dt.datetime(1996, 1, 2)
    rows = [(k, 7, "F", 1.5, day, "2-HIGH") for k in range(800)]
    shuffled = lambda sf: "Exchange" in order_documents(spark, sf)._jdf.queryExecution().executedPlan().toString()
    even, one, none = (orders(spark, f"{tmp}/{name}", some, files) for name, some, files in (("even", rows, 8), ("one", rows, 1), ("none", [], 1)))
    assert [shuffled(sf) for sf in (even, one, none)] == [False, True, True]
    assert sorted(r.o_orderkey for r in order_documents(spark, even).collect()) == [r[0] for r in rows]


def orders(spark, tmp, rows, files=1):
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp_ntz, o_orderpriority string").repartition(files).write.parquet(f"{tmp}/orders.parquet")
    return tmp


def test_responses_are_dealt_before_their_texts_are_rendered(spark, tmp):
    from surveylake.plans.q_documents import responses
    day = dt.datetime(1996, 1, 2)
    sf = orders(spark, tmp, [(k, 7, s, 1.5, day, "2-HIGH") for k, s in ((1, "F"), (1, "F"), (1, "O"), (None, "F"), (70, "F"), (71, "P"))])
    found = responses(spark, sf, "F")
    # as a join of the documents with the keys of that status has it: three rows of key 1 meet two
    assert sorted((r.response, len(r.data)) for r in found.collect()) == [(0, 6), (1, 1)]
    plan = responses(spark, sf, "F")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RepartitionByExpression") + plan.count("Exchange ") == 1 and "Join" not in plan


def test_own_ids(spark):
    from surveylake.plans.q_loads import _with_own_id
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "UUID string, n int")
    got = _with_own_id(rows)
    assert sorted((r.n, r.own_id) for r in got.collect()) == [(1, False), (2, False), (3, True), (4, True)]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_a_sheet_is_exported_by_as_many_tasks_as_there_are_splits(spark, tmp, monkeypatch):
    from surveylake.plans.q_reloads import q_split_sheet
    from surveylake.sources import sheets as S
    spark.createDataFrame([(i, "en", f'a "b"\n{i}', "web") for i in range(40)], "doc_id long, lang string, text string, source string"
                          ).repartition(8).write.parquet(f"{tmp}/documents.parquet")
    paths, read = [], S.read_split_csv
    monkeypatch.setattr(S, "read_split_csv", lambda s, path: paths.append(path) or read(s, path))
    got = q_split_sheet(spark, tmp)
    assert sorted(r.text for r in got.collect()) == sorted(f'a "b"\n{i}' for i in range(40))
    assert len([f for f in os.listdir(paths[0].removeprefix("file:")) if f.endswith(".csv")]) > 2
