import math
import re
from collections import Counter

import pytest

from portrait.llm import licenses as L


def brute(rows, threshold=0.7):
    """(own, score, license, from) of each (id, text, path)."""
    words = lambda t: re.findall(L.WORDS, t.lower())
    notes = []
    for _, text, _ in rows:
        parts = re.split(r"\n|(?<=[.!?;])[ \t]+(?=[A-Z])", text or "")
        notes.append([re.sub(r"\s+", " ", p.lower()).strip() for p in parts if re.search(L.CUE, p)])
    flat = [n for ns in notes for n in ns]
    df = Counter()
    for n in flat + [t for _, t in L.TEMPLATES]:
        df.update(set(words(n)))
    size = len(flat) + len(L.TEMPLATES)
    vector = lambda t: {w: c * (math.log((1 + size) / (1 + df[w])) + 1) for w, c in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [(n, vector(t)) for n, t in L.TEMPLATES]
    best = {}
    for n in set(flat):
        v = vector(n)
        cosines = [(round(sum(x * k.get(w, 0) for w, x in v.items()) / (norm(v) * norm(k)), 6), name) for name, k in known] if v else []
        good = sorted(((-c, name) for c, name in cosines if c >= threshold))
        if good:
            best[n] = good[0]
    own, files = [], {}
    for (_, text, path), ns in zip(rows, notes):
        found = sorted(best[n] for n in ns if n in best)
        own.append(found[0] if found else None)
        if found and path is not None:
            mine = sum(len(n.split(" ")) for n in ns if n in best)
            if re.search(L.FILE_NAME, path) or 2 * mine >= len(text.split()):
                folder = path.rpartition("/")[0]
                files[folder] = min(files.get(folder, found[0]), found[0])
    out = []
    for (i, _, path), mine in zip(rows, own):
        parts = path.rpartition("/")[0].split("/") if path is not None else []
        above = next((d for k in range(len(parts), 0, -1) if (d := "/".join(parts[:k])) in files), None)
        if mine:
            out.append((i, path, mine[1], -mine[0], mine[1], None))
        else:
            out.append((i, path, None, None, files[above][1] if above is not None else None, above))
    return out


ROWS = [
    (1, 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation. It is provided as is.', "a/LICENSE"),
    (2, "code here", "a/b/x.py"), (3, "# Licensed under the Apache License, Version 2.0 by us\ncode\ncode", "a/b/c/y.py"), (4, None, "a/z"), (5, "x", None),
    (6, "Released under the MIT License.", "q/w/COPYING"), (7, "t", "q/u.py"), (8, "t", "q/w/e/r"), (9, "", "q/w/"),
    (10, "A license of no known kind that nobody has ever heard of", "q/v"), (11, "This work is licensed under the GNU General Public License, version 2.", "gpl/two"),
    (12, "This work is licensed under the GNU General Public License, version 3.", "gpl/three"), (13, "prose " * 3000 + "\n\tLicensed  under CC BY-NC 4.0.\n" + "prose " * 3000, "gpl/long"),
    (14, "Licensed under CC BY 4.0. Released under the MIT License.", "dual/x"), (15, "y", "dual/y"), (None, "Released under the MIT License.", None), (6, "Released under the MIT License.", "q/w/COPYING"),
    (16, "y", "ab/c"), (17, "y", "a"), (18, "SPDX-License-Identifier: MIT\n" + "code " * 50, "gpl/three/deep/er"),
]


@pytest.mark.parametrize("threshold", [0.7, 0.95])
def test_equals_brute_force(spark, threshold):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in ROWS], "doc_id long, text string, path string, license string, rid int, note string")
    got = sorted((tuple(r) for r in L.scan_licenses(df, threshold).collect()), key=str)
    assert got == sorted(brute(ROWS, threshold), key=str)


def test_every_template_finds_itself(spark):
    df = spark.createDataFrame([(i, t, None) for i, (_, t) in enumerate(L.TEMPLATES)], "doc_id long, text string, path string")
    got = {r.id: (r.own_license, r.own_score) for r in L.scan_licenses(df).collect()}
    assert got == {i: (n, 1.0) for i, (n, _) in enumerate(L.TEMPLATES)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, path string")
    assert L.scan_licenses(df).count() == 0


def test_no_python_runs_in_the_query(spark, capsys):
    L.op10_licenses(spark, "/root/testdata/sf0.001").explain("formatted")
    assert not any(x in capsys.readouterr().out for x in ("Python", "Pandas", "Arrow"))


GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
LGPL = GPL2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1")
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.\n"


def test_whole_files_and_wrapped_headers(spark):
    """Texts that have a licence over many lines, none in one line."""
    full = {name: text for name, text, header in L.full_texts() if not header}
    code = "int main() { return 0; }\n" * 40
    commented = lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */\n" + code
    rows, want = [], {}
    for name, text in full.items():
        rows += [(len(rows), f"Copyright (c) 2021 Some Body <some@body.example>\n\n{text}", f"{name}/src/7"), (len(rows) + 1, code, f"{name}/src/deep/8")]
        want |= {len(rows) - 2: (name, None), len(rows) - 1: (name, f"{name}/src")}
    for name, text in (("GPL-2.0", GPL2), ("GPL-3.0", GPL2.replace("version 2", "version 3").replace("software;", "software:")), ("LGPL-2.1", LGPL), ("MPL-2.0", MPL)):
        for made in (commented(text), "".join(f"# {x}\n" for x in text.splitlines()) + code, f"/*\n{text}*/\n{code}", f"A tool.\n\n{text}\n{code}"):
            rows += [(len(rows), made, f"code/{len(rows)}"), (len(rows) + 1, "x", "code/none")]
            want |= {len(rows) - 2: (name, None), len(rows) - 1: (None, None)}
    rows.append((len(rows), "Some tool. This work is licensed under the GNU General\nPublic License, version 3. It does things.", "code/wrapped"))
    want[len(rows) - 1] = ("GPL-3.0", None)
    rows.append((len(rows), "The history of copyright and of the public domain\nfills many books. " * 30, "code/prose"))
    want[len(rows) - 1] = (None, None)
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.id: (r.license, r.inherited_from) for r in L.scan_licenses(df).collect()}
    assert got == want
    # the score of a whole text does not depend on how many others there are
    few = L.scan_licenses(df.where("doc_id = 0")).collect()[0]
    assert few.own_license == want[0][0] and few.own_score > 0.9


def test_time_of_comment_runs(spark):
    lines = "license\n" + "# x\n" * 100_000 + "/* " * 50_000
    df = spark.createDataFrame([(1, lines, "a/b"), (2, "license " + "\n" * 200_000, "a/b")], "doc_id long, text string, path string")
    assert [r.own_license for r in L.scan_licenses(df).collect()] == [None, None]
