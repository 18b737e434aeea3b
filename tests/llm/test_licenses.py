import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketflow.llm.licenses import LESS_EXACT, TEMPLATES, THRESHOLD, VOCABULARY, WRAP, scan_licenses, terms_of
from marketflow.llm.queries import op9_licenses

PATHS = "path string, text string, n long, dir string, license string, term string, line string"


def scan(spark, files, **kwargs):
    df = spark.createDataFrame([(p, t, 1, "x", "x", "x", "x") for p, t in files], PATHS)
    return {r.path: r for r in scan_licenses(df, **kwargs).collect()}


def test_every_template_is_found_as_itself(spark):
    files = [(f"{i}.py", f"# code\n  {t.text.upper()} \nmore code") for i, t in enumerate(TEMPLATES)]
    out = scan(spark, files)
    for i, (name, *_) in enumerate(TEMPLATES):
        assert out[f"{i}.py"].license == name and out[f"{i}.py"].score > 0.99 and out[f"{i}.py"].origin == "own"


def test_near_notices_and_plain_prose(spark):
    out = scan(spark, [("a", "This project is licensed under the terms of the Apache License, Version 2.0"),
                       ("b", "we talked under the free version of the work with all and any form"),
                       ("c", "the apache warriors had a license plate and reserved a table for all rights of way"), ("d", "")])
    assert out["a"].license == "Apache-2.0" and 0.6 <= out["a"].score < 1
    assert [out[x].license for x in "bcd"] == [None] * 3


def test_inheritance_from_the_nearest_directory(spark):
    mit, apache, gpl = "Released under the MIT License.", TEMPLATES[0].text, "This work is licensed under the GNU General Public License, version 3."
    out = scan(spark, [("LICENSE", mit), ("a/x.txt", "t"), ("a/b/COPYING", apache), ("a/b/x.txt", "t"), ("a/b/c/d/x.txt", "t"),
                       ("a/b/c/own.txt", f"t\n{gpl}"), ("a/notice.txt.bak", "no licence here"), ("x.txt", "t"), ("ab/x.txt", "t"),
                       ("a/b/LICENSE.txt", mit + " and other words that make the cosine smaller"), ("a/x2.txt", gpl)])
    got = {p: (r.license, r.found_in, r.origin) for p, r in out.items()}
    assert got["x.txt"] == got["ab/x.txt"] == got["a/x.txt"] == ("MIT", "LICENSE", "inherited")
    assert got["a/b/x.txt"] == got["a/b/c/d/x.txt"] == ("Apache-2.0", "a/b/COPYING", "inherited")
    assert got["a/b/c/own.txt"] == ("GPL-3.0", "a/b/c/own.txt", "own")  # a header is no licence file for others
    assert got["a/notice.txt.bak"] == ("MIT", "LICENSE", "inherited")


def test_no_licence_file_no_inheritance(spark):
    out = scan(spark, [("a/x", "t"), ("a/y", "All rights reserved.")])
    assert (out["a/x"].license, out["a/x"].origin, out["a/y"].license) == (None, None, "all-rights-reserved")


def test_odd_rows(spark, odd_docs):
    notice = "Released under the MIT License."
    df = (odd_docs.drop("path").withColumn("path", F.concat_ws("/", "source", "doc_id")).unionByName(
        odd_docs.drop("path").limit(2).withColumn("path", F.lit(None).cast("string")).withColumn("text", F.lit(notice))))
    out = scan_licenses(df)
    assert out.columns == ["path", "license", "score", "found_in", "origin"] and out.count() == df.count()
    assert [r.license for r in out.where("path IS NULL").collect()] == ["MIT", "MIT"]
    assert scan_licenses(df.limit(0)).count() == 0


def test_plan_has_no_python(spark, capsys):
    op9_licenses(spark, "/root/testdata/sf0.01").explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_notices_of_plain_terms_only(spark):
    others = [(str(i), t.text) for i, t in enumerate(TEMPLATES)]
    out = scan(spark, [("a", "CC BY 4.0"), ("b", "prose\nUnder CC BY-SA 4.0\nprose"), ("c", "CC BY-NC 4.0"), *others])
    assert [out[x].license for x in "abc"] == ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"]


def test_wrapped_and_like_notices(spark):
    """Headers as they stand in files: wrapped, behind comment marks, and near-equal licences."""
    texts = {
        "gpl3": "#!/bin/sh\n# This work is licensed under the GNU General Public\n# License, version 3\necho",
        "gpl2": " * This work is licensed under the GNU General Public License,\n * version 2.\n",
        "gpl": "licensed under the GNU General Public\nLicense\n",
        "gpl3or": "// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or\n"
                  "// (at your option) any later version.",
        "lgpl": "This work is licensed under the GNU Lesser General Public License,\nversion 3.",
        "mpl": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this",
        "apache": "; Licensed under the Apache License, Version 2.0 (the \"License\");\n; you may not use this file except in compliance with the License.",
        "spdx": "int x; // SPDX-License-Identifier: Apache-2.0\nAll rights reserved.",
        "spdx2": "# SPDX-License-Identifier: GPL-3.0-or-later",
        "spdx3": "# SPDX-License-Identifier: Zlib",
        "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    }
    clause2 = ("2. Redistributions in binary form must reproduce the above copyright\nnotice, this list of conditions and the following disclaimer in the\n"
               "documentation and/or other materials provided with the distribution.")
    clause3 = ("3. Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products derived from\n"
               "this software without specific prior written permission.")
    texts["bsd2"] = f"{texts['bsd']}\n{clause2}\n"
    texts["bsd3"] = f"{texts['bsd2']}{clause3}\nAS IS"
    fill = [(f"x{i}", f"prose number {i} of other things") for i in range(60)]
    out = scan(spark, [*texts.items(), *fill])
    assert {k: out[k].license for k in texts} == {
        "gpl3": "GPL-3.0", "gpl2": "GPL-2.0", "gpl": "GPL", "gpl3or": "GPL-3.0", "lgpl": "LGPL-3.0", "mpl": "MPL-2.0", "apache": "Apache-2.0",
        "spdx": "Apache-2.0", "spdx2": "GPL-3.0", "spdx3": "Zlib", "bsd": "BSD", "bsd2": "BSD-2-Clause", "bsd3": "BSD-3-Clause"}
    assert all(out[p].license is None for p, _ in fill)


def test_sister_licences_and_versions_are_told_apart(spark):
    texts = {
        "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
        "AGPL-3.0 ": "# it under the terms of the GNU Affero General Public License as\n# published by the Free Software Foundation, either version 3 of the\n"
                     "# License, or (at your option) any later version.",
        "AGPL": "licensed under the GNU Affero General Public License",
        "LGPL-2.1": "This library is licensed under the GNU Lesser General Public\nLicense, version 2.1",
        "LGPL-2.0": "licensed under the GNU Library General Public License, version 2",
        "Apache": "Licensed under the Apache License, Version 1.1",
        "MPL": "This file is subject to the terms of the Mozilla Public License, Version 1.1",
        "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0", "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0", "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that",
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        "EPL-2.0": "// are made available under the terms of the Eclipse Public License 2.0\n// which is available at",
        "BSL-1.0": "// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file",
        "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to",
        "None": "Licensed under CC BY 3.0", "None ": "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND",
    }
    fill = [(f"x{i}", f"prose number {i} of other things, this is for the file and to use it") for i in range(60)]
    out = scan(spark, [*texts.items(), *fill])
    assert {k: str(out[k].license) for k in texts} == {k: k.strip() for k in texts}
    assert all(out[p].license is None for p, _ in fill)


def test_ids_are_carried_not_read_from_paths(spark, tmp_path):
    rows = [(None, "Released under the MIT License.", "en", "web7"), (3, "x", None, None), (64, "All rights reserved.", "en", "web7")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.license, r.origin) for r in op9_licenses(spark, str(tmp_path)).collect()}
    assert got == {None: ("MIT", "own"), 3: (None, None), 64: ("all-rights-reserved", "own")}


def test_every_window_is_compared(spark):
    """Own licences equal those from the plain cosine of every window of lines, without any filter."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    files = [(f"{r.doc_id}.txt", r.text) for r in docs if r.text]
    files += [("n1", "CC BY 4.0"), ("n2", "free of charge\nx"), ("n3", "the copy the copy"), ("n4", "GNU Lesser\n\nGeneral Public\nLicense version 3")]
    df = Counter(t for _, text in files for t in set(terms_of(text)))
    idf = lambda t: math.log((len(files) + 1) / ((df[t] if t in VOCABULARY else 0) + 1)) + 1

    def vector(text):
        return {t: n * idf(t) for t, n in Counter(terms_of(text)).items()}
    templates = [vector(t.text) for t in TEMPLATES]
    names = list(dict.fromkeys(t.license for t in TEMPLATES))
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    out = scan(spark, files)
    for path, text in files:
        best, lines = {}, text.split("\n")
        for window in (" ".join(lines[i:i + k]) for k in range(1, WRAP + 1) for i in range(len(lines) - k + 1)):
            v = vector(window)
            for t, w in zip(TEMPLATES, templates):
                score = round(sum(x * w.get(term, 0.0) for term, x in v.items()) / norm(v) / norm(w), 6) if v else 0.0
                if score >= THRESHOLD and all(n in v for n in t.needs) and not any(n in v for n in t.forbids):
                    best[t.license] = max(best.get(t.license, 0.0), score)
        best = {x: s for x, s in best.items() if not any(x in LESS_EXACT.get(more, ()) for more in best)}
        if best:
            name = min(best, key=lambda x: (-best[x], names.index(x)))
            assert (out[path].license, out[path].score) == (name, pytest.approx(best[name], abs=2e-6))
        else:
            assert out[path].license is None
    assert sum(r.license is not None for r in out.values()) > 2


def test_many_notices_in_one_long_file(spark):
    """300,000 lines that all reach the threshold: work grows with the lines."""
    row = scan(spark, [("a", "All rights reserved.\n" * 300_000 + "Licensed under the Apache License,\nVersion 2.0"), ("b", "x")])["a"]
    assert row.license == "Apache-2.0" and row.score == 1.0  # a tie, which the first template wins
