import csv
import random

import pytest

from daybook.sources import raw


@pytest.fixture
def small_parts(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_quoted_cells_over_part_borders(spark, tmp_path, small_parts):
    """One file in many parts, records of all sizes, some longer than several parts."""
    rng = random.Random(3)
    rows = [[str(n), "".join(rng.choice(['"', ",", "\n", "é", "x", '""', "\n\n"]) for _ in range(rng.choice([0, 1, 5, 60]))) + "." if n % 97 else "line\n\",\n" * 3_000, f"end {n}"] for n in range(1_500)]
    for name, part in (("a.csv", rows[:1_000]), ("b.csv", rows[1_000:])):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n" if name == "a.csv" else "\r\n", quoting=csv.QUOTE_ALL)
            out.writerow(["n", "te,xt", "e"])
            out.writerows(part)
    lines = raw._file_lines(spark, str(tmp_path), lineSep="\n")
    assert lines.rdd.getNumPartitions() > 50 and lines.select("_block").distinct().count() > 50
    got = raw.read_quoted_table(spark, str(tmp_path))
    assert got.columns == ["n", "te,xt", "e"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
    named = raw.read_quoted_table(spark, str(tmp_path), file_column="path")
    assert {r.path.rsplit("/", 1)[1] for r in named.select("path").distinct().collect()} == {"a.csv", "b.csv"}


def test_quoted_edges(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿a,b\n\n1,"x"\n2,\n\n"3"\n'.encode())
    assert sorted(map(tuple, raw.read_quoted_table(spark, str(tmp_path / "a.csv")).collect()), key=repr) == [("1", "x"), ("2", None), ("3", None)]
    (tmp_path / "b.csv").write_text("a,b\n")
    assert raw.read_quoted_table(spark, str(tmp_path / "b.csv")).count() == 0
    (tmp_path / "c.csv").write_text("")
    with pytest.raises(ValueError):
        raw.read_quoted_table(spark, str(tmp_path / "c.csv"))


def test_encodings_are_told_over_all_parts_of_a_file(spark, tmp_path, small_parts):
    """The one line that tells the encoding is the last of its file."""
    plain = [f"plain line {n}~x" if n % 10 else "" for n in range(2_000)]
    files = {"utf8.txt": ("utf-8", "olá €}"), "windows.txt": ("cp1252", "olá €}"), "ascii.txt": ("ascii", "end}"), "wide.txt": ("utf-16", "olá €}")}
    want = set()
    for name, (encoding, last) in files.items():
        (tmp_path / name).write_bytes("\r\n".join([*plain, last]).encode(encoding))
        want |= {(name, n, line.replace("}", ": ")) for n, line in enumerate([*plain, last], 1) if line}
    latin = b"caf\xe9 \x81}"
    (tmp_path / "latin 1+.txt").write_bytes("\n".join(plain).encode() + b"\n" + latin)
    want |= {("latin 1+.txt", n, line) for n, line in enumerate([*plain, latin.decode("latin-1").replace("}", ": ")], 1) if line}
    read = raw.read_mixed_encodings(spark, str(tmp_path))
    assert raw._file_lines(spark, str(tmp_path)).select("_file", "_block").distinct().count() > 20
    assert {(r.source_file, r.line_seq, r.line) for r in read.collect()} == want
