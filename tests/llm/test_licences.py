import math
import re

import duckdb

from daybook.llm import licences


def cosine(unit, number):
    known = licences.idf()
    words = [w for w in re.findall(licences.WORD, unit.lower()) if w not in licences.STOP_WORDS]
    mine = {w: words.count(w) * known.get(w, licences.UNKNOWN) for w in words}
    norm = math.sqrt(sum(x * x for x in mine.values())) or 1.0
    return sum(mine.get(w, 0) * x for n, _, w, x in licences.template_weights() if n == number) / norm


def brute(files):
    own = {}
    for path, text in files:
        named = bool(re.match(licences.LICENCE_FILE, path.rsplit("/", 1)[-1].lower()))
        units = (text or "").split("\n") + [text or ""] * named
        scores = [(round(cosine(u, i), 6), -i) for u in units for i in range(len(licences.TEMPLATES))]
        best = max(scores)
        if best[0] >= licences.THRESHOLD:
            own[path] = (licences.TEMPLATES[-best[1]][0], best[0], "licence file" if named else "header", path)
    out = []
    for path, _ in files:
        found = own.get(path)
        at = path
        while not found and at:
            at = at.rsplit("/", 1)[0] if "/" in at else ""
            held = sorted((-s, p, lic) for p, (lic, s, o, _) in own.items() if o == "licence file" and (p.rsplit("/", 1)[0] if "/" in p else "") == at)
            if held:
                found = (held[0][2], -held[0][0], "inherited", held[0][1])
        out.append((path, *(found or (None, None, None, None))))
    return sorted(out, key=repr)


FILES = [
    ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code\nno notice here"), ("a/b/y.py", "x\n# Licensed under the Apache License, Version 2.0."),
    ("a/b/COPYING.txt", "  This program is free software:\nyou can redistribute it and/or modify\nit under the terms of the GNU General Public License"),
    ("a/b/c/d/z.py", ""), ("ab/q.py", "All rights reserved. " * 3), ("top.py", "nothing"), ("e/LICENSE.1", "Licensed under CC BY-NC 4.0."),
    ("e/LICENSE.0", "Licensed under CC BY-NC 4.0."), ("e/f.txt", "rights"), ("e/License-notes", "just prose about the weather"), ("e/g/h/i/j.txt", "w " * 5_000),
    ("e/long.txt", "prose " * 3_000 + "\nReleased under the MIT license!\n" + "more " * 10)]


def test_scan_equals_brute_force(spark):
    df = spark.createDataFrame([(p, t, "z") for p, t in FILES], "path string, text string, licence string")
    got = sorted((tuple(r) for r in licences.scanned(df).select("path", "licence", "score", "origin", "source").collect()), key=repr)
    assert got == brute(FILES)
    assert {r[0]: r[1] for r in got}["a/b/c/d/z.py"] == "GPL-3.0" and {r[0]: r[4] for r in got}["e/g/h/i/j.txt"] == "e/LICENSE.0"


def test_edge_rows(spark):
    df = spark.createDataFrame([("x/LICENSE", "Released under the MIT License."), ("x/a", None), ("x/a", "All rights reserved."), (None, "All rights reserved."),
                                (None, None), ("y/a", None)], "path string, text string")
    got = sorted((tuple(r)[:4] for r in licences.scanned(df).collect()), key=repr)
    assert got == sorted([("x/LICENSE", "MIT", 1.0, "licence file"), ("x/a", "Proprietary", 1.0, "header"), ("x/a", "Proprietary", 1.0, "header"),
                          (None, None, None, None), (None, None, None, None), ("y/a", None, None, None)], key=repr)
    assert licences.scanned(df.limit(0)).count() == 0
    root = spark.createDataFrame([("COPYING", "Released under the MIT License."), ("p/q/r", "x")], "path string, text string")
    assert {r.licence for r in licences.scanned(root).collect()} == {"MIT"}


def test_gate_spares_no_line_that_reaches_the_threshold():
    pattern = re.compile(licences.gate())
    for _, text in licences.TEMPLATES:
        assert pattern.search(text.lower())
    for number in range(len(licences.TEMPLATES)):
        rest = sum(x * x for n, _, w, x in licences.template_weights() if n == number and not pattern.search(w))
        assert math.sqrt(rest) < licences.THRESHOLD


def test_plan_has_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licences.document_licences(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_documents_equal_duckdb(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    got = sorted((tuple(r) for r in licences.document_licences(spark.read.parquet(path)).select("doc_id", "path", "licence", "score", "origin").collect()), key=repr)
    assert got == sorted(con.execute(licences.ORACLE_SQL).fetchall(), key=repr)
    assert {r[4] for r in got} >= {"header", None}
