"""Vector code compression: a small codebook per part of the vectors, trained by active-entry Lloyd rounds in exact integers.

Each component becomes ``floor(1024 * x)``, vectors are cut into ``PARTS`` consecutive parts, and every part is coded by the number of
its nearest codebook entry. A round assigns all parts and then moves each entry to the floor of its parts' mean.

A stored row keeps its code and exact distance per part. In the next round a part whose entry stayed where it was is compared with the
entries that moved only: all others lost against the stored distance already. Parts whose entry moved are compared with every entry.
Equal distances go to the lower entry in both cases, so the outcome is that of plain Lloyd rounds.

Rows stay in their tasks: a round reads the stored rows, writes them with new codes, and adds up one partial sum per task and entry. The
driver sees the summed codebook (a fixed number of entries) and nothing else; the codebook is all that is sent to the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.operators.staging import fresh_path, materialise, remove

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
SLICE = 4_096  # rows whose distances are held at once
_LIMB = 32  # sums travel as 32-bit limbs, so that they never overflow
_FAR = -1  # stored for a distance beyond 64 bits: the part is compared with every entry


@dataclass(frozen=True)
class Book:
    """Entries per part as exact integers, and which of them moved in the last round."""

    entries: list[np.ndarray]  # part -> entries x width, int64 or Python integers
    moved: list[np.ndarray]  # part -> one truth value per entry

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for x in part.ravel()).encode()).hexdigest()


def _exact(values: list[list[int]]) -> np.ndarray:
    """int64 where it holds all values, Python integers otherwise."""
    try:
        return np.array(values, dtype=np.int64)
    except OverflowError:
        return np.array(values, dtype=object)


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(1024 * x)`` of finite numbers, exactly."""
    wide = vectors.astype(np.float64)
    if not wide.size or np.abs(wide).max() < 2.0 ** 52:
        return np.floor(wide * SCALE).astype(np.int64)
    exact = [[int(x) * SCALE if abs(x) >= 2.0 ** 53 else math.floor(x * SCALE) for x in row] for row in wide.tolist()]
    return np.array(exact, dtype=object)


def _bounds(length: int) -> list[int]:
    return [length * p // PARTS for p in range(PARTS + 1)]


def _reach(values: np.ndarray) -> int:
    return int(np.abs(values).max()) if values.size else 0


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries: float64 where every intermediate is an exact integer there, else Python integers."""
    if 4 * rows.shape[1] * max(_reach(rows), _reach(entries)) ** 2 < 1 << 53:
        a, b = rows.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    a, b = rows.astype(object), entries.astype(object)
    return np.array([[sum((x - y) ** 2 for x, y in zip(row, entry, strict=True)) for entry in b] for row in a], dtype=object).reshape(len(a), len(b))


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest nearest entry of each row and its distance, slice by slice."""
    code, distance = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for low in range(0, len(rows), SLICE):
        far = distances(rows[low:low + SLICE], entries)
        best = far.argmin(axis=1)
        least = far[np.arange(len(far)), best]
        if far.dtype == object:
            if any(x >= 1 << 63 for x in least) and distance.dtype != object:
                distance = distance.astype(object)
        code[low:low + SLICE], distance[low:low + SLICE] = best, least
    return code, distance


def reassign(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances after some entries moved; ``code`` and ``distance`` are those before."""
    code, distance = code.copy(), distance.copy()
    again = moved[code] | (distance == _FAR)
    if again.any():
        code[again], found = nearest(rows[again], entries)
        if found.dtype == object:
            distance = distance.astype(object)
        distance[again] = found
    stay, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if stay.size and active.size:
        rival, gap = nearest(rows[stay], entries[active])
        rival = active[rival]
        wins = (gap < distance[stay]) | ((gap == distance[stay]) & (rival < code[stay]))
        code[stay[wins]], distance[stay[wins]] = rival[wins], gap[wins]
    return code, distance


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length))


def _assigned(batches: Iterator[pa.RecordBatch], book: Book, length: int) -> Iterator[pa.RecordBatch]:
    bounds = _bounds(length)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = _matrix(batch.column("vector"), length)
        old = batch.column("codes").null_count == 0
        if old:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(n, PARTS).astype(np.int64)
            gaps = batch.column("gaps").flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS)
        new_codes, new_gaps, error = np.zeros((n, PARTS), dtype=np.uint8), np.zeros((n, PARTS), dtype=np.int64), np.zeros(n, dtype=object)
        for p in range(PARTS):
            part, entries = rows[:, bounds[p]:bounds[p + 1]], book.entries[p]
            if old:
                code, gap = reassign(part, entries, book.moved[p], codes[:, p], gaps[:, p])
            else:
                code, gap = nearest(part, entries)
            error += gap.astype(object)
            new_codes[:, p] = code
            new_gaps[:, p] = [x if x < 1 << 63 else _FAR for x in gap] if gap.dtype == object else gap
        total = [x if x < 1 << 63 else None for x in error.tolist()]
        data = new_codes.tobytes()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("vec_id", "label", "vector")), pa.array([data[k:k + PARTS] for k in range(0, len(data), PARTS)], pa.binary()),
             pa.ListArray.from_arrays(pa.array(np.arange(0, n * PARTS + 1, PARTS, dtype=np.int32)), pa.array(new_gaps.ravel())),
             pa.array(total, pa.int64())],
            names=["vec_id", "label", "vector", "codes", "gaps", "error"])


def _limbs(values: list[int]) -> list[list[int]]:
    """Integers as rows of limbs: the sum over k of row k times 2**(32 k)."""
    rows = []
    while any(not -(1 << 62) <= v < 1 << 62 for v in values):
        rows.append([v & ((1 << _LIMB) - 1) for v in values])
        values = [v >> _LIMB for v in values]
    return [*rows, [v & ((1 << _LIMB) - 1) for v in values], [v >> _LIMB for v in values]]


def _sums(batches: Iterator[pa.RecordBatch], amounts: list[int], length: int) -> Iterator[pa.RecordBatch]:
    """Per part and entry the count and summed components of this task's rows."""
    bounds = _bounds(length)
    counts = [np.zeros(k, dtype=np.int64) for k in amounts]
    totals = [np.zeros((k, bounds[p + 1] - bounds[p]), dtype=object) for p, k in enumerate(amounts)]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _matrix(batch.column("vector"), length)
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(-1, PARTS)
        small = rows.dtype != object and _reach(rows) * len(rows) < 1 << 62
        for p in range(PARTS):
            part = rows[:, bounds[p]:bounds[p + 1]]
            counts[p] += np.bincount(codes[:, p], minlength=amounts[p])
            added = np.zeros(totals[p].shape, dtype=np.int64 if small else object)
            np.add.at(added, codes[:, p], part if small else part.astype(object))
            totals[p] += added.astype(object)
    out = [(p, int(k), limb, int(counts[p][k]) if limb == 0 else 0, row)
           for p in range(len(amounts)) for k in np.flatnonzero(counts[p]) for limb, row in enumerate(_limbs(totals[p][k].tolist()))]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)],
                                         names=["part", "entry", "limb", "n", "sums"])


def _moved(state: DataFrame, book: Book, length: int) -> Book:
    """The codebook with every used entry at the floor of its parts' mean."""
    amounts = [len(e) for e in book.entries]
    partial = state.select("vector", "codes").mapInArrow(lambda b: _sums(b, amounts, length), "part int, entry int, limb int, n long, sums array<long>")
    cells = (partial.select("part", "entry", "limb", "n", F.posexplode("sums").alias("place", "value"))
             .groupBy("part", "entry", "limb", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value")))
    bounds = _bounds(length)
    sums = [[[0] * (bounds[p + 1] - bounds[p]) for _ in range(k)] for p, k in enumerate(amounts)]
    counts = [[0] * k for k in amounts]
    for row in cells.collect():  # entries x places, whatever the number of vectors
        sums[row.part][row.entry][row.place] += row.value << (_LIMB * row.limb)
        if row.limb == 0:
            counts[row.part][row.entry] = row.n
    entries = [_exact([[s // n for s in sums[p][k]] if (n := counts[p][k]) else [int(x) for x in book.entries[p][k]] for k in range(amounts[p])])
               .reshape(amounts[p], bounds[p + 1] - bounds[p]) for p in range(PARTS)]
    return Book(entries, [(new != old).any(axis=1) if new.shape[1] else np.zeros(len(new), dtype=bool) for new, old in zip(entries, book.entries, strict=True)])


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty and holds finite numbers only."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES,
               rounds: int = ROUNDS) -> tuple[DataFrame, Book]:
    """The coded rows (vec_id, label, vector, codes, gaps, error) and the codebook they refer to.

    Rows without a usable vector go; of vectors of several lengths those of the most frequent length stay (of equally frequent ones the
    longest). Equal rows are coded one by one. The codebook starts from the rows of the smallest ids, equal ids by vector, rows
    without an id last; with fewer rows than ``entries`` it has one entry per row. Lengths that four does not divide give parts that
    differ by one. ``error`` is null where it exceeds 64 bits. An empty table gives no rows and an empty codebook.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).filter(usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    coded = rows.withColumns({"codes": F.lit(None).cast("binary"), "gaps": F.lit(None).cast("array<long>"), "error": F.lit(None).cast("long")})
    if common is None:
        empty = [np.zeros((0, 0), dtype=np.int64)] * PARTS
        return coded.limit(0), Book(empty, [np.zeros(0, dtype=bool)] * PARTS)
    length = int(common.length)
    coded = coded.filter(F.size("vector") == length)
    first = coded.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    start = integers(np.array([r.vector for r in first], dtype=np.float64))
    bounds = _bounds(length)
    book = Book([start[:, bounds[p]:bounds[p + 1]] for p in range(PARTS)], [np.ones(len(start), dtype=bool)] * PARTS)
    held = None
    for turn in range(rounds + 1):
        path = fresh_path(spark)
        coded = materialise(coded.mapInArrow(lambda b, book=book: _assigned(b, book, length), coded.schema), path)
        if held:
            remove(spark, held)  # nothing reads the rows of the round before any more
        held = path
        if turn < rounds:
            book = _moved(coded, book, length)
    return coded, book


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error and codebooks_sha256 of every coded row.

    label_error adds up the errors of a label's rows, rows without a label together; it is null if one of them or the sum is.
    """
    coded, book = compressed(vectors)
    rows = coded.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error")
    labels = rows.groupBy("label").agg(F.when(F.count("*") == F.count("error"), F.expr("try_sum(error)")).alias("label_error"))
    return (rows.alias("r").join(labels.alias("l"), F.col("r.label").eqNullSafe(F.col("l.label")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(book.digest()).alias("codebooks_sha256")))


def _round_sql(turn: int) -> str:
    """Assignment number ``turn`` and the codebook after it."""
    return f"""
nearest{turn} as materialized (
  select rid, part, min({{'d': n + m - 2 * list_inner_product(v, c), 'e': entry}}) as best from parts join book{turn} using (part) group by rid, part),
means{turn} as (
  select part, best.e as entry, i, floor(sum(v[i]) / count(*)) as x
  from nearest{turn} join parts using (rid, part), lateral (select unnest(range(1, len(v) + 1)) as i) group by part, best.e, i),
book{turn + 1} as materialized (
  select part, entry, coalesce(x.c, b.c) as c, list_inner_product(coalesce(x.c, b.c), coalesce(x.c, b.c)) as m
  from book{turn} b left join (select part, entry, list(x order by i) as c from means{turn} group by part, entry) x using (part, entry)),"""


ORACLE_SQL = f"""
with kept as materialized (
  select row_number() over (order by vec_id, embedding) as rid, vec_id, label, [floor({SCALE} * x::double) for x in embedding] as v
  from embeddings where len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
parts as materialized (
  select rid, part, v, list_inner_product(v, v) as n
  from (select rid, part, v[len(v) * part // {PARTS} + 1 : len(v) * (part + 1) // {PARTS}] as v from kept, range({PARTS}) r(part))),
book0 as materialized (select part, rid - 1 as entry, v as c, n as m from parts where rid <= {ENTRIES}),
{"".join(_round_sql(t) for t in range(ROUNDS))}
final as materialized (
  select rid, part, min({{'d': n + m - 2 * list_inner_product(v, c), 'e': entry}}) as best from parts join book{ROUNDS} using (part) group by rid, part),
codes as (
  select rid, string_agg(lower(format('{{:02x}}', best.e::bigint)), '' order by part) as code, sum(best.d)::bigint as error from final group by rid),
digest as (
  select sha256(string_agg(x::bigint::varchar, ',' order by part, entry, i)) as codebooks_sha256
  from (select part, entry, unnest(c) as x, generate_subscripts(c, 1) as i from book{ROUNDS}))
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from kept join codes using (rid), digest
"""
