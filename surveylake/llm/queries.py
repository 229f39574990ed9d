"""The registered query of each operator, with production parameters, and its
DuckDB SQL where SQL can express it (the others have brute-force tests)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.session import scratch_path

from . import (
    chat, decontam, langid, licenses, linededup, packing, quality, simhash, tokenspans, urlfilter, vectorcodes, vectordedup,
    warc,
)
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that imitates control strings, formatted and
    read back."""
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                              F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                              F.lit(said).alias("text")))
    found = chat.format_conversations(rows)
    read = found.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                        chat.read_loss(F.col("segments")).alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratios of every document against those
    labelled good, and those labelled toxic."""
    labels = table(spark, sf_dir, "labels")
    return quality.judge(table(spark, sf_dir, "documents"), labels.filter("quality = 1 AND toxic = 0"),
                         labels.filter("toxic = 1"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    revisit = F.col("type") == "revisit"
    return warc.read_pages(spark, path).select(
        "page_id", F.when(revisit, F.col("payload_bytes")).otherwise(F.octet_length("payload")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(warc.sha1_base32(F.col("payload"))).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        capacity=2048, end_id=1)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, as a file of a tree: 64 documents to a
    directory, 64 directories to one above, by source; the first document of
    each directory is its licence file."""
    folder = F.concat_ws("/", "source", F.expr("concat('d', doc_id div 4096)"))
    path = (F.when(F.expr("doc_id % 4096 = 0"), F.concat_ws("/", folder, F.lit("LICENSE")))
            .when(F.expr("doc_id % 64 = 0"), F.concat_ws("/", folder, F.expr("concat('d', doc_id div 64)"), F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", folder, F.expr("concat('d', doc_id div 64)"), F.expr("concat(doc_id, '.txt')"))))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    found = licenses.scan(files, "doc_id")
    return found.select(F.col("id").alias("doc_id"), "path", "license", F.round("score", 9).alias("score"), "how",
                        "licence_folder")


RULES = [urlfilter.Rule.of(*r) for r in (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
    ("com/de/", "block"))]
#: Names of which every domain is listed (name.whatever.follows), with the pages on it.
NAMES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def op8_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: prefix rules, then the cascade of the listed
    domains and addresses, which come from the pages themselves."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, RULES, urlfilter.named_keys(pages, NAMES))


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of 50 words or more that it repeats."""
    found = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50)
    return found.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__deleted").alias("n_deleted"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector, its error, and the codebooks' digest."""
    coded, codebooks = vectorcodes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return vectorcodes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(vectorcodes.digest(codebooks)).alias("codebooks_sha256"))


def op12_tokenspans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, aligned."""
    found = tokenspans.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"),
                             keep=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)))
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def op13_vectordedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return vectordedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95).withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_chat, op3_decontam, op4_quality, op5_warc, op6_packing, op7_licenses, op8_urlfilter,
                                    op9_linededup, op10_langid, op11_vectorcodes, op12_tokenspans, op13_vectordedup)}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": OP2_SQL, "op3_decontam": OP3_SQL, "op5_warc": OP5_SQL, "op8_urlfilter": OP8_SQL, "op9_linededup": OP9_SQL,
            "op11_vectorcodes": OP11_SQL}


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), runs AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS begins,
         length(regexp_replace(text, '<(\\*/?turn)', '<\\\1', 'g')) AS text_chars,
         length(regexp_replace(role, '<(\\*/?turn)', '<\\\1', 'g')) AS role_chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       -- '<turn>' ROLE '<turn:>' TEXT '</turn>' and a newline; '<turn+>' between merged texts
       sum(text_chars + CASE WHEN begins THEN 6 + role_chars + 7 + 8 ELSE 7 END)::BIGINT AS formatted_chars
FROM runs GROUP BY conv_id
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (  -- every window of 10 words; a shorter item is one window
  SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM (SELECT *, least(10, len(w)) AS size FROM i WHERE len(w) > 0))
), dw AS (
  SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)
), hit AS (
  SELECT doc_id, k, size, item_id FROM dw JOIN iw USING (size, g)
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hit) GROUP BY 1
), m AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hit) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP5_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       -- base32: character k is bits 5k to 5k + 4, taken out of the five hex digits (20 bits) that hold it
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(hex, (5 * (k // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31)::INT, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d
"""

OP8_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(rule, rhost, rpath, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')
), names(name) AS (VALUES ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')
), domains AS (
  SELECT DISTINCT array_to_string(labels[k:], '.') AS domain FROM (
    SELECT string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM u WHERE host <> '')
), b AS (SELECT domain AS name FROM domains WHERE string_split(domain, '.')[1] IN (SELECT name FROM names)
), best AS (
  SELECT u.*, (SELECT arg_max(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule) * 1000 + length(r.rhost))
               FROM r WHERE (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)) AS best
  FROM u
)
SELECT page_id, host, path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.verdict
            WHEN EXISTS (SELECT 1 FROM b WHERE host = name OR ends_with(host, '.' || name)) THEN 'block'
            ELSE 'allow' END AS verdict
FROM best
"""

OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents
), c AS (
  SELECT *, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n FROM l
), s AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM c WHERE n > 0
), f AS (  -- the fewest lines of 50 words or more that open, or close, at each line
  SELECT doc_id, i AS a, max(i) OVER w AS z, max(b) OVER w - (b - n) AS words, list(t) OVER w AS content
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY b - n RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(i) OVER w, i, b - min(b - n) OVER w, list(t) OVER w
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY b RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS k FROM f WHERE words >= 50)
  WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS i FROM later
), kept AS (
  SELECT c.doc_id, count(*) AS n_lines, count(g.i) AS n_deleted,
         coalesce(string_agg(t, chr(10) ORDER BY c.i) FILTER (g.i IS NULL), '') AS text
  FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i GROUP BY c.doc_id
)
SELECT d.doc_id, kept.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN kept USING (doc_id)
"""

_OP11_ROUND = """
, n{k} AS (
  SELECT vec_id, p, min(dist * 64 + e) AS best FROM (
    SELECT vec_id, p, e, sum((x - c) * (x - c))::BIGINT AS dist FROM x JOIN c{k} USING (p, d) GROUP BY ALL) GROUP BY ALL
), c{next} AS (
  SELECT p, e, d, coalesce(m, c)::BIGINT AS c FROM c{k} LEFT JOIN (
    SELECT p, best % 64 AS e, d, floor(sum(x) / count(*))::BIGINT AS m FROM x JOIN n{k} USING (vec_id, p) GROUP BY ALL)
    USING (p, e, d)
)
"""
OP11_SQL = """
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(256 * v)::BIGINT) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, i // (len(v) // 16) AS p, i % (len(v) // 16) AS d, v[i + 1] AS x FROM (SELECT *, unnest(range(len(v))) AS i FROM k)
), c0 AS (
  SELECT p, e, d, x AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (vec_id)
  WHERE e < 64
)""" + "".join(_OP11_ROUND.format(k=k, next=k + 1) for k in range(3)) + """
, coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
  FROM n2 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, d)) FROM c2) AS codebooks_sha256
FROM coded JOIN k USING (vec_id)
"""
