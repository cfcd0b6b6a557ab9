from itertools import permutations

import duckdb
import pytest

from daybook.llm import audit


def plain(rows, labels):
    """Every order applied filter by filter to every row."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    firsts = {}
    for d, _, t in rows:
        if d is not None:
            firsts[t or ""] = min(d, firsts.get(t or "", d))
    fails = []
    for d, _, t in rows:
        t = t or ""
        words = t.encode().split()
        fails.append({"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                      "D": any(c in "#$%&*|" for c in t), "E": d is not None and firsts[t] < d})
    out = {}
    for part in {s or "" for _, s, _ in rows}:
        mine = [(d, f) for (d, s, _), f in zip(rows, fails) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if x[f]]
                before, left = left, [(d, x) for d, x in left if not x[f]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(x[f] for _, x in mine) - len(gone), sum(x[f] and sum(x.values()) == 1 for _, x in mine),
                                                   sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), f]
        for order in permutations("ABCDE"):
            for step in range(1, 6):
                out[part, "".join(order), step][-1] = shapley[order[step - 1]]
    return sorted((*k, *v) for k, v in out.items())


def test_given_documents_equal_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = audit.audit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    want = con.execute(audit.ORACLE_SQL)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted(tuple(r[names.index(c)] for c in got.columns) for r in want.fetchall())
    assert sorted(tuple(r) for r in got.collect()) == rows and len(rows) == 20 * 600


def test_edge_rows_equal_brute_force(spark):
    prose = " ".join(f"word{k}" for k in range(60))
    rows = ([(k, "s", prose) for k in (5, 3, 9, 3)] + [(7, None, None), (8, "", ""), (None, "s", prose), (None, "t", ""), (11, "t", "A#" * 200), (12, "t", "é " * 70),
            (13, "u", "x " * 80_000 + "|"), (14, "u", prose + " \x85  ÀÉ A"), (15, "s", "A\x0bB\x1cC\x0c" * 30), (3, "t", prose), (16, "s", "Z" * 5 + "z" * 94), (17, "s", "Z" * 5 + "é" * 95)]
            + [(20, "hot", "same $ text")] * 40 + [(k, "hot", "same $ text") for k in range(30, 60)])
    labels = [(5, 1, 0), (5, 0, 1), (9, 1, 1), (20, 1, 0), (40, None, 1), (None, 1, 1), (99, 1, 1), (13, 1, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, unit int, part string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(docs, marks)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, labels)
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert audit.audit(docs, marks.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_prefixes_come_from_semi_and_anti_joins(spark):
    docs = spark.createDataFrame([(1, "a", "# x"), (2, "a", "# x"), (3, "b", "y")], "doc_id long, source string, text string")
    held = audit.units(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    tables = audit.id_tables(held)
    assert [t.count() for t in tables] == [3, 0, 0, 2, 1]
    alive = {r.unit: r.alive for r in audit.survivals(held, tables).collect()}
    ids = {r.doc_id: r.unit for r in held.collect()}
    for prefix in range(32):
        survivors = {d for d, u in ids.items() if alive[u] >> prefix & 1}
        want = {1, 2, 3}
        for bit, t in enumerate(tables):
            if prefix >> bit & 1:
                want -= {d for d, u in ids.items() if u in {r.unit for r in t.collect()}}
        assert survivors == want
