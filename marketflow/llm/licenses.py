"""License scans: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance. DataFrame operations only.

A notice may be wrapped over lines, so a file's header candidates are all windows of
1 to ``WRAP`` consecutive lines; a licence file is compared as a whole as well. Signs
that are no letters or digits, such as comment marks, separate terms. Only windows
whose known terms weigh enough beside their others that the cosine could reach the
threshold are built. A window is compared with every
template where it lies, in array functions over its terms, so no term is
shuffled: the vocabulary is the templates' own terms, a small fixed set, with
inverse document frequencies counted over all files. A template also names terms
a window must or must not hold, which tell near-equal licences apart; a licence found
more exactly (a version, a further clause) takes the place of its family's less exact
one. An SPDX line is taken by its word. Files without a licence of
their own inherit from the nearest directory above them that holds a licence
file, by joins on directory paths: first each distinct directory finds its
nearest licensed ancestor, then files join their directory, so a directory with
very many files costs one row in the first join.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import add, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise


class Template(NamedTuple):
    license: str
    text: str
    needs: tuple[str, ...] = ()
    forbids: tuple[str, ...] = ()


NO_GPL = ("lesser", "affero", "library")  # terms of its sister licences
# The wording of licence notices, with the terms that tell like ones apart.
TEMPLATES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache", "2")),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                           "compliance with the License.", ("apache", "2")),
    Template("Apache", "Licensed under the Apache License.", ("apache",)),
    Template("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                             "promote products derived from this software without specific prior written permission.", ("neither", "endorse")),
    Template("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                             "following disclaimer in the documentation and/or other materials provided with the distribution.", ("reproduce",)),
    Template("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted.", ("redistribution",)),
    Template("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met:", ("redistribution",)),
    Template("CC-BY-4.0", "Licensed under CC BY 4.0.", ("cc", "by", "4"), ("nc", "sa", "nd")),
    Template("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("cc", "nc", "4"), ("sa", "nd")),
    Template("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("cc", "sa", "4"), ("nc", "nd")),
    Template("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", ("cc", "nd", "4"), ("nc", "sa")),
    Template("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", ("cc", "nc", "sa", "4"), ("nd",)),
    Template("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", ("cc", "nc", "nd", "4"), ("sa",)),
    Template("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal.", ("cc0",)),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("general", "2"), NO_GPL + ("3",)),
    Template("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("general", "3"), NO_GPL + ("2",)),
    Template("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 "
                        "of the License, or (at your option) any later version.", ("general", "2"), NO_GPL + ("3",)),
    Template("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
                        "of the License, or (at your option) any later version.", ("general", "3"), NO_GPL + ("2",)),
    Template("GPL", "This work is licensed under the GNU General Public License.", ("gnu", "general"), NO_GPL),
    Template("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", ("affero", "3")),
    Template("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
                         "version 3 of the License, or (at your option) any later version.", ("affero", "3")),
    Template("AGPL", "This work is licensed under the GNU Affero General Public License.", ("affero",)),
    Template("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", ("lesser", "3"), ("2",)),
    Template("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1.", ("lesser", "2", "1"), ("3",)),
    Template("LGPL-2.0", "This work is licensed under the GNU Library General Public License, version 2.", ("library", "general", "2"), ("3",)),
    Template("LGPL", "This work is licensed under the GNU Lesser General Public License.", ("lesser",)),
    Template("MIT", "Released under the MIT License.", ("mit",)),
    Template("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", ("granted", "charge")),
    Template("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
             ("granted", "fee")),
    Template("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, Version 2.0.", ("mozilla", "2")),
    Template("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "2")),
    Template("MPL", "This file is subject to the terms of the Mozilla Public License.", ("mozilla",)),
    Template("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0.", ("eclipse", "2")),
    Template("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", ("boost",)),
    Template("Unlicense", "This is free and unencumbered software released into the public domain.", ("unencumbered",)),
    Template("all-rights-reserved", "All rights reserved.", ("reserved",)),
)
# What a more exact finding replaces in the same file.
LESS_EXACT = {"BSD-3-Clause": ("BSD-2-Clause", "BSD"), "BSD-2-Clause": ("BSD",), "GPL-2.0": ("GPL",), "GPL-3.0": ("GPL",),
              "AGPL-3.0": ("AGPL",), "LGPL-3.0": ("LGPL",), "LGPL-2.1": ("LGPL",), "LGPL-2.0": ("LGPL",), "Apache-2.0": ("Apache",),
              "MPL-2.0": ("MPL",)}
NOT_TERM = "[^a-z0-9]+"
THRESHOLD = 0.6
WRAP = 3  # lines that a notice may be wrapped over
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([^/]*)$"
SPDX = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+)"
SPDX_ENDING = r"(-only|-or-later|\+)$"


def terms_of(text: str) -> list[str]:
    return [t for t in re.split(NOT_TERM, text.lower()) if t]


VOCABULARY = sorted({t for template in TEMPLATES for t in terms_of(template.text)})
_RANK = {name: i for i, name in enumerate(dict.fromkeys(t.license for t in TEMPLATES))}  # ties go to the first


def _frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """Files, and files with each vocabulary term."""
    words = F.array_distinct(F.split(F.lower("text"), NOT_TERM))
    found = files.select(F.explode(F.array_intersect(words, F.array(*map(F.lit, VOCABULARY)))).alias("term"))
    return files.count(), {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}


def _idf(total: int, df: int) -> float:
    return math.log((total + 1) / (df + 1)) + 1


def _literal_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _lines(text: Column, idf: dict[str, float]) -> Column:
    """The lines' terms ``t``, with the summed weights of the known ones and the number of the others in ``s``."""
    start = F.struct(F.lit(0.0).alias("known"), F.lit(0).alias("others"))
    weigh = lambda a, x: (F.when(x == "", a)
                          .when(x.isin(VOCABULARY), F.struct((a["known"] + F.element_at(_literal_map(idf), x)).alias("known"), a["others"].alias("others")))
                          .otherwise(F.struct(a["known"].alias("known"), (a["others"] + 1).alias("others"))))
    lines = F.transform(F.split(text, "\n"), lambda x: F.split(F.lower(x), NOT_TERM))
    return F.transform(lines, lambda t: F.struct(t.alias("t"), F.aggregate(t, start, weigh).alias("s")))


def _windows(lines: str, rare: float, threshold: float) -> Column:
    """The term lists of the windows of 1 to ``WRAP`` lines that could reach the threshold.

    A cosine is at most sqrt(V / (V + O)), the squared weights of known and other
    terms. V is at most the square of the known terms' summed weights, O at least
    the other terms' number times their squared weight.
    """
    least = max(0.0, threshold - 1e-6) ** 2

    def window(*parts: Column) -> Column:
        """The terms of these lines, in an array of one, or none if the cosine can't reach the threshold."""
        known, others = (reduce(add, (p["s"][name] for p in parts)) for name in ("known", "others"))
        enough = (known > 0) & ((1 - least) * known * known >= least * others * rare ** 2)
        enough &= parts[-1].isNotNull()  # the text's last lines have none behind them
        return F.when(enough, F.array(F.concat(*[p["t"] for p in parts]))).otherwise(F.array().cast("array<array<string>>"))

    # Every line beside the next ones.
    names = [f"l{k}" for k in range(WRAP)]
    beside = F.arrays_zip(*[F.slice(lines, k, F.size(lines)).alias(n) for k, n in enumerate(names, 1)])
    each = lambda z: F.concat(*[window(*[z[n] for n in names[:k]]) for k in range(1, WRAP + 1)])
    return F.flatten(F.transform(beside, each))


def _own(files: DataFrame, total: int, df: dict[str, int], threshold: float) -> DataFrame:
    """``path, text_key, license, score`` of files whose best candidate reaches the threshold."""
    key = ["path", "text_key"]
    idf, rare = {t: _idf(total, df.get(t, 0)) for t in VOCABULARY}, _idf(total, 0)
    known = lambda x: x.isin(VOCABULARY)
    candidates = _windows("lines", rare, threshold)
    whole = F.array(F.split(F.lower("text"), NOT_TERM))
    candidates = F.when(F.col("is_licence"), F.concat(whole, candidates)).otherwise(candidates)
    parts = (files.withColumn("lines", _lines(F.col("text"), idf)).select(*key, F.explode(candidates).alias("terms"))
             .withColumn("hits", F.filter("terms", known)).where(F.size("hits") > 0)
             .withColumn("others", F.array_sort(F.filter("terms", lambda x: ~known(x) & (x != "")))))
    # Squared counts of the other terms, by runs of equal ones in sorted order.
    first = F.struct(F.lit("").alias("term"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("sum"))
    runs = F.aggregate("others", first, lambda a, x: F.when(
        x == a["term"], F.struct(x.alias("term"), (a["run"] + 1).alias("run"), (a["sum"] + 2 * a["run"] + 1).alias("sum")))
        .otherwise(F.struct(x.alias("term"), F.lit(1).cast("bigint").alias("run"), (a["sum"] + 1).alias("sum"))))
    weight = lambda t: F.size(F.filter("hits", lambda x: x == t)) * F.element_at(_literal_map(idf), t)
    parts = (parts.withColumn("others", runs["sum"] * F.lit(rare ** 2))
             .withColumn("w", F.transform(F.array_distinct("hits"), lambda t: F.struct(t.alias("t"), weight(t).alias("w")))))
    total_of = lambda f: F.aggregate("w", F.lit(0.0), lambda s, x: s + f(x))
    parts = parts.withColumn("norm", F.sqrt(total_of(lambda x: x["w"] * x["w"]) + F.col("others")))
    scores = []
    for name, text, needs, forbids in TEMPLATES:
        vector = {t: n * idf[t] for t, n in Counter(terms_of(text)).items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        share = _literal_map({t: w / norm for t, w in vector.items()})
        dot = total_of(lambda x, share=share: x["w"] * F.coalesce(F.try_element_at(share, x["t"]), F.lit(0.0)))
        fits = F.lit(True)
        for t in needs:
            fits &= F.array_contains("hits", t)
        for t in forbids:
            fits &= ~F.array_contains("hits", t)
        scores.append(F.struct(F.when(fits, F.round(dot / F.col("norm"), 6)).alias("score"), F.lit(name).alias("license")))
    reached = F.filter(F.array(*scores), lambda s: s["score"] >= threshold)
    found = parts.select(*key, F.explode(reached).alias("s")).groupBy(*key, "s.license").agg(F.max("s.score").alias("score"))
    spdx = F.regexp_replace(F.regexp_extract("text", SPDX, 1), SPDX_ENDING, "")
    told = files.select(*key, spdx.alias("license"), F.lit(2.0).alias("score")).where("license <> ''").distinct()
    # At most a row a licence of the templates, and an SPDX line's.
    rank = F.coalesce(F.try_element_at(_literal_map(_RANK), F.col("license")), F.lit(len(_RANK)))
    entry = F.struct((-F.col("score")).alias("minus"), rank.alias("rank"), "license")
    all_ = found.unionByName(told).groupBy(*key).agg(F.collect_list(entry).alias("all"))
    replaces = lambda y, x: reduce(or_, ((y["license"] == more) & x["license"].isin(*less) for more, less in LESS_EXACT.items()))
    replaced = lambda x: F.exists("all", lambda y: replaces(y, x))
    best = F.array_min(F.filter("all", lambda x: ~replaced(x)))
    return all_.select(*key, best.alias("best")).select(*key, "best.license", F.least(F.lit(1.0), -F.col("best.minus")).alias("score"))


def scan_licenses(docs: DataFrame, path_col: str = "path", text_col: str = "text",
                  threshold: float = THRESHOLD, id_col: str | None = None) -> DataFrame:
    """One row per input row: ``path, license, score, found_in, origin``, and first the ``id_col`` if one is named.

    ``origin`` is ``own`` (the file's best window of lines, or the whole of a licence
    file, has cosine ``threshold`` or more to a template and holds its telling terms, or
    the file has an SPDX line: score 1), ``inherited`` (from the
    licence file ``found_in`` of the nearest directory above; among several there
    the best score, then the first path) or null, with no licence. A file is a
    licence file by its name. A null path is a file outside any directory, which
    inherits nothing; a null text is empty. Rows that repeat path and text are
    one file with as many rows; rows that repeat only a path are scanned apart.
    An empty table gives no rows; further columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.col(path_col).cast("string")
    files = docs.select(*([F.col(id_col).alias("row_id")] if id_col else []),
                        path.alias("path"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    files = files.withColumn("is_licence", F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE), F.lit(False)))
    # The root directory is "", everything else "a/b"; a path without "/" lies in the root.
    files = files.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))
    total, df = _frequencies(files)
    # The path may be null and is a grouping key, so it is compared null-safely below.
    own = materialise(_own(files, total, df, threshold), "license-own")
    light = materialise(files.drop("text"), "license-files")
    same = lambda a, b: a["path"].eqNullSafe(b["path"]) & (a["text_key"] == b["text_key"])
    marked = light.join(own, same(light, own), "left").select(light["*"], own["license"], own["score"])
    marked = materialise(marked, "license-marked")

    best_first = F.struct((-F.col("score")).alias("s"), F.col("path").alias("p"), F.col("license").alias("l"))
    held = (marked.where(F.col("is_licence") & F.col("license").isNotNull()).groupBy("dir")
            .agg(F.min(best_first).alias("best")).select("dir", F.col("best.p").alias("from_path"),
                                                         F.col("best.l").alias("from_license"), (-F.col("best.s")).alias("from_score")))
    dirs = marked.where("dir is not null").select("dir").distinct()
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(F.split("dir", "/")))
    above = dirs.withColumn("level", F.explode(F.sequence(F.lit(0), depth))).withColumn(
        "ancestor", F.expr("substring_index(dir, '/', level)"))
    nearest = (above.join(held.withColumnRenamed("dir", "ancestor"), "ancestor").groupBy("dir")
               .agg(F.max(F.struct("level", "from_path", "from_license", "from_score")).alias("up")).select("dir", "up.*").drop("level"))
    nearest = materialise(nearest, "license-dirs")
    out = marked.join(nearest, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        *([F.col("row_id").alias(id_col)] if id_col else []),
        "path", F.coalesce("license", "from_license").alias("license"),
        F.when(mine, F.col("score")).otherwise(F.col("from_score")).alias("score"),
        F.when(mine, F.col("path")).otherwise(F.col("from_path")).alias("found_in"),
        F.when(mine, "own").when(F.col("from_license").isNotNull(), "inherited").alias("origin"))
