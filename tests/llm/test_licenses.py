"""License scan against plain TF-IDF and a walk up the directories."""

import math
import random
import re
import textwrap
from collections import Counter

from helpers import SF, nasty
from pyspark.sql import functions as F

from surveylake.llm import licenses
from surveylake.llm.queries import op7_licenses

TOKEN = re.compile(r"[^\W_]+")


def vector(text, n, df):
    return {w: c * (math.log((1 + n) / (1 + df.get(w, 0))) + 1) for w, c in Counter(TOKEN.findall(text.lower())).items()}


def cosine(a, b):
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0.0


def brute(files):
    vocabulary = {w for _, t in licenses.TEMPLATES for w in TOKEN.findall(t.lower())}
    df = Counter(w for _, _, t in files for w in vocabulary & set(TOKEN.findall((t or "").lower())))
    n = len(files)
    templates = [(name, vector(t, n, df)) for name, t in licenses.TEMPLATES]
    own = []
    for key, path, text in files:
        is_file = bool(re.match(licenses.LICENCE_FILE, (path or "").split("/")[-1]))
        units = (text or "").split("\n") + ([text or ""] if is_file else [])
        score, name = max(((cosine(vector(u, n, df), v), name) for u in units for name, v in templates),
                          key=lambda x: x[0], default=(0, None))
        own.append((key, path, name if score >= licenses.THRESHOLD else None, score, is_file))
    given = {}
    for _, path, name, score, is_file in own:
        if is_file and name:
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, (1, "")), (-score, name))
    out = []
    for key, path, name, score, _ in own:
        how, at = ("own" if name else None), None
        if not name and path is not None:
            folder = path
            while folder:
                folder = folder.rpartition("/")[0]
                if folder in given:
                    name, how, at = given[folder][1], "inherited", folder
                    break
        out.append((key, path, name, round(score, 6), how, at))
    return sorted(out, key=str)


def check(spark, files):
    rows = [tuple(r) for r in files.select("id", "path", "text").collect()]
    got = sorted(((r.id, r.path, r.license, round(r.score, 6), r.how, r.licence_folder)
                  for r in licenses.scan(files).collect()), key=str)
    assert got == brute(rows)
    return got


def test_tree(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = spark.createDataFrame([
        (1, "a/LICENSE", mit), (2, "a/b/COPYING.txt", apache + "\n" + apache), (3, "a/b/c/d/x.py", "code"),
        (4, "a/x.py", "# " + apache), (5, "a/y.py", "no notice"), (6, "z/y.py", None), (7, None, "text"), (7, None, mit),
        (8, "a/b/license.md", "nothing here"), (9, "top.py", ""), (9, "top.py", ""), (10, "q/LICENCE", "Released under\nthe MIT"
         " License."), (11, "q/LICENSE.old", mit), (12, "q/r/s", "x"), (13, "ab/y.py", "x"), (14, "", "x"),
    ], "id long, path string, text string").withColumn("score", F.lit(1)).withColumn("folder", F.lit("a"))
    got = {r[0]: r for r in check(spark, files)}
    assert got[3][2:] == ("Apache-2.0", got[3][3], "inherited", "a/b") and got[5][2] == "MIT" and got[13][2] is None
    assert got[4][4] == "own" and got[10][2] == "MIT"


def test_nasty_rows(spark):
    check(spark, nasty(spark).select(F.col("doc_id").alias("id"), F.concat(F.lit("a/b/"), "doc_id").alias("path"), "text"))
    assert licenses.scan(spark.createDataFrame([], "id long, path string, text string")).collect() == []


def test_documents(spark):
    got = {r.doc_id: r for r in op7_licenses(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert (got[r.doc_id].how == "own") == bool(re.search("^(Licensed|Released|This work is lic)", r.text, re.M))


def test_headers_over_lines_and_whole_licences(spark):
    texts = dict(licenses.TEXTS)
    wrap = lambda name, mark, at: "import x\n" + "\n".join(
        f"{mark} {line}" for line in textwrap.wrap([t for n, t in licenses.TEMPLATES if n == name][at], 60)) + "\nx = 1\n" * 50
    cut = texts["Apache-2.0"].split("END OF TERMS AND CONDITIONS")[0]
    prose = ["the sun goes down behind the hills and the fox sleeps in a den"] * 40
    rows = [(1, "a.py", wrap("MIT", "#", 1), "MIT"), (2, "b.c", wrap("BSD-3-Clause", "//", 0), "BSD-3-Clause"),
            (3, "c.c", wrap("GPL-3.0", " *", 1), "GPL-3.0"), (4, "d.js", wrap("Apache-2.0", "//", 1), "Apache-2.0"),
            (5, "e.js", "x\n// Released under the MIT License. Copyright (c) 2019 A. Body and others\ny", "MIT"),
            (6, "f/LICENSE", "The MIT License\n\nCopyright (c) 2019 A. Body\n\n" + texts["MIT"], "MIT"),
            (7, "g/COPYING", texts["GPL-3.0"].split("END OF TERMS")[0], "GPL-3.0"), (8, "h/LICENSE", cut, "Apache-2.0"),
            (9, "i/LICENSE.txt", "Copyright 2019 A. Body\n" + texts["BSD-3-Clause"], "BSD-3-Clause"),
            (10, "f/x.py", "x = 1", "MIT"), (11, "h/x/y.py", "y = 1", "Apache-2.0"), (12, "j.py", "z = 1", None),
            (13, "k.py", "# Released under the terms of\n# the Other\n# License.", None),
            *((20 + i, f"z/{i}.txt", t, None) for i, t in enumerate(prose))]
    files = spark.createDataFrame([r[:3] for r in rows], "id long, path string, text string")
    got = {r.id: r for r in licenses.scan(files).collect()}
    assert {i: r.license for i, r in got.items()} == {r[0]: r[3] for r in rows}
    assert [got[i].how for i in (1, 5, 6, 8, 10, 11)] == ["own"] * 4 + ["inherited"] * 2


def test_runs_against_every_window(spark):
    rng = random.Random(3)
    match = licenses.Matcher(1000, {"the": 900, "of": 800, "license": 30})
    words = [w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)]
    for n in (0, 3, 30, 200):
        text = rng.choices(words, k=n)
        at = rng.randrange(n + 1)
        text = text[:at] + licenses.words_of(licenses.TEMPLATES[-2][1])[2:] + text[at:]
        for i, (name, template) in enumerate(licenses.TEMPLATES):
            weigh = lambda x: {w: c * match.weights.get(w, match.unseen) for w, c in Counter(x).items()}
            size = len(licenses.words_of(template))
            want = max(cosine(weigh(text[k:k + size]), weigh(licenses.words_of(template)))
                       for k in range(max(1, len(text) - size + 1)))
            assert math.isclose(match._run(text, i), want, abs_tol=1e-9)
