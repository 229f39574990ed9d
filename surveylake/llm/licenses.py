"""License scan: TF-IDF cosine to templates, then inheritance by directory.

Every line of a file (a header or notice), every run of as many adjacent words
as a template has (a header wrapped over lines, or with more on its line), and
the whole text of a licence file, is compared with the templates as sparse
TF-IDF vectors; a licence file also with whole licence texts.  Files without a
match of their own take the licence of the licence file in the nearest
directory above, found by joins on paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise

# The wording of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
)
#: Whole licence texts, for licence files.
TEXTS = tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
THRESHOLD = 0.75
#: A run of words must equal a template of fewer words than this, in any order:
#: two short notices may differ in nothing but the licence's name.
SHORT = 10
LICENCE_FILE = r"(?i)^(licen[sc]e|copying)(\..*)?$"
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def document_frequencies(files: DataFrame, text_col: str, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """(files, for each word of a template the number of files with it); all
    files are counted, and the driver gets a row per template word."""
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = Counter(w for t in batch.column(0).to_pylist() if t for w in vocabulary.intersection(words_of(t)))
        counts[""] = batch.num_rows
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                                          ["word", "n"])

    found = map_batches(files.select(F.col(text_col).alias("text")), run, "word string, n long")
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return counts.pop("", 0), counts


class Matcher:
    """Best template for a text by cosine of TF-IDF vectors.  The weight of a
    word is ln((1 + files) / (1 + files with it)) + 1; a word of no template
    weighs as one that no file has."""

    def __init__(self, n_files: int, frequencies: dict[str, int], templates=TEMPLATES):
        self.unseen = math.log(1 + n_files) + 1
        self.weights = {w: math.log((1 + n_files) / (1 + frequencies.get(w, 0))) + 1
                        for _, t in templates for w in words_of(t)}
        self.names = [name for name, _ in templates]
        self.sizes = [len(words_of(t)) for _, t in templates]
        #: word -> (template, its normalised weight there)
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, (_, text) in enumerate(templates):
            counts = Counter(words_of(text))
            norm = math.sqrt(sum((n * self.weights[w]) ** 2 for w, n in counts.items()))
            for w, n in counts.items():
                self.postings.setdefault(w, []).append((i, n * self.weights[w] / norm))

    def __call__(self, words: list[str]) -> tuple[float, str | None]:
        """(cosine, name) of the closest template; the first of several."""
        known = [w for w in words if w in self.postings]
        if not known:
            return 0.0, None
        square, dots = 0.0, [0.0] * len(self.names)
        for w, n in Counter(words).items():
            weight = n * self.weights.get(w, self.unseen)
            square += weight * weight
            for i, other in self.postings.get(w, ()):
                dots[i] += weight * other
        best = max(range(len(dots)), key=lambda i: (dots[i], -i))
        return dots[best] / math.sqrt(square), self.names[best]

    def _run(self, words: list[str], i: int) -> float:
        """The best cosine of template ``i`` and as many adjacent words (all, of fewer)."""
        mine = {w: x for w, xs in self.postings.items() for at, x in xs if at == i}
        counts: Counter = Counter()
        best = square = dot = 0.0
        size = self.sizes[i]
        for at, w in enumerate(words):
            weight = self.weights.get(w, self.unseen)
            square += weight * weight * (2 * counts[w] + 1)
            dot += weight * mine.get(w, 0.0)
            counts[w] += 1
            if at >= size:
                old = words[at - size]
                weight = self.weights.get(old, self.unseen)
                counts[old] -= 1
                square -= weight * weight * (2 * counts[old] + 1)
                dot -= weight * mine.get(old, 0.0)
            if at >= size - 1 or at == len(words) - 1:
                best = max(best, dot / math.sqrt(square))
        return min(best, 1.0)

    def runs(self, words: list[str], threshold: float) -> tuple[float, str | None]:
        """(cosine, name) of the closest template to any run of as many adjacent
        words, (0, None) below ``threshold``."""
        held = [0.0] * len(self.names)
        for w in self.postings.keys() & set(words):
            for i, x in self.postings[w]:
                held[i] += x * x
        found: tuple[float, str | None] = (0.0, None)
        for i, name in enumerate(self.names):
            least = threshold if self.sizes[i] >= SHORT else max(threshold, 1 - 1e-9)
            # no run has a greater cosine than the norm of the template's words in the text
            if held[i] >= least * least - 1e-9 and (score := self._run(words, i)) >= least and score > found[0]:
                found = score, name
        return found


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _direct(files: DataFrame, id_col: str, path_col: str, text_col: str, threshold: float, templates, texts) -> DataFrame:
    """(id, path, licence_file, license, score): each file's own best match."""
    shared = files.sparkSession.sparkContext.broadcast(document_frequencies(files, text_col, (*templates, *texts)))
    id_type = files.schema[id_col].dataType.simpleString()
    rows = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"),
                        F.coalesce(_name(F.col(path_col)).rlike(LICENCE_FILE), F.lit(False)).alias("licence_file"),
                        F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, match_text = Matcher(*shared.value, templates), Matcher(*shared.value, texts)
        for batch in batches:
            names, scores = [], []
            for is_file, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines = [words_of(x) for x in text.split("\n")] if text else []
                whole = [w for x in lines for w in x]
                units = lines + [whole] if is_file else lines
                score, name = max(map(match, units), key=lambda x: x[0], default=(0.0, None))
                more = [match.runs(whole, threshold), *([match_text(whole)] if is_file else [])]
                best = max(more, key=lambda x: x[0])
                if best[0] >= threshold and best[0] > score + 1e-9:
                    score, name = best
                names.append(name if score >= threshold else None)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "path", "licence_file", "license", "score"])

    return rows.mapInArrow(run, f"id {id_type}, path string, licence_file boolean, license string, score double")


def scan(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text",
         threshold: float = THRESHOLD, templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """One row per file: (id, path, license, score, how, licence_folder).

    ``how`` is ``own`` for a match of the file itself, ``inherited`` for that of
    the licence file in ``licence_folder``, the nearest directory at or above
    the file's, else null with a null license; ``score`` is the file's own best
    cosine, in which runs of words and whole licence texts count from ``threshold``
    on (a template of fewer than SHORT words only with all its words).  Of several licence files in a directory the best score counts, then
    the licence that sorts first.  A null or empty text matches nothing; a file
    with a null path inherits nothing.  Repeated rows stay; an empty table gives
    an empty one; other columns are not read.  Inheritance is worked out for
    distinct directories, so one that holds most files is one row there.
    """
    own = materialise(_direct(files, id_col, path_col, text_col, threshold, templates, texts), "licenses-own")
    own = own.withColumn("folder", _folder(F.col("path")))
    given = (own.filter("licence_file AND license IS NOT NULL").groupBy("folder", "license").agg(F.max("score").alias("s"))
             .groupBy(F.col("folder").alias("licence_folder"))
             .agg(F.min(F.struct((-F.col("s")).alias("s"), "license"))["license"].alias("given")))
    folders = own.filter("license IS NULL").select("folder").dropna().distinct()
    parts = F.when(F.col("folder") == "", F.array().cast("array<string>")).otherwise(F.split("folder", "/"))
    above = F.transform(F.sequence(F.lit(0), F.size("parts")), lambda n: F.array_join(F.slice("parts", 1, n), "/"))
    nearest = (folders.withColumn("parts", parts).select("folder", F.posexplode(above).alias("depth", "licence_folder"))
               .join(given, "licence_folder").groupBy("folder")
               .agg(F.max_by(F.struct("licence_folder", "given"), "depth").alias("by")))
    # written, so that the join is of two plain exchanges and AQE may split a directory with many files
    found = own.join(materialise(nearest, "licenses-nearest"), "folder", "left")
    inherits = F.col("license").isNull() & F.col("by").isNotNull()
    return found.select(
        "id", "path", F.coalesce("license", "by.given").alias("license"), "score",
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").alias("how"),
        F.when(inherits, F.col("by.licence_folder")).alias("licence_folder"))
