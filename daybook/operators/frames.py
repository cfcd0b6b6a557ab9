"""Reusable relational shapes.

Rules kept everywhere: one shuffle per key where possible, partial aggregation before a shuffle,
no per-key collection, a full tie-break in every ordering, and joins left to Spark's own
size-checked broadcast choice. The only forced broadcasts are tables written out in code.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StructType

from daybook.operators.staging import materialise


def latest(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], cols: Mapping[str, Column],
           key_names: Sequence[str] = ("key",)) -> DataFrame:
    """One row per key: the row with the greatest ``order``, nulls lowest.

    ``max_by`` combines on the map side, so a hot key never meets in one task row by row. The
    selected values themselves end the ordering, which makes ties deterministic.
    """
    picked = F.struct(*[c.alias(n) for n, c in cols.items()])
    keyed = df.select(*[c.alias(n) for n, c in zip(key_names, keys)], picked.alias("_v"), F.struct(*order).alias("_o"))
    # one struct comparison: ordering first, then the values themselves as the tie-break
    best = keyed.groupBy(*key_names).agg(F.max(F.struct("_o", "_v")).alias("_b"))
    return best.select(*key_names, "_b._v.*")


def earliest(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], cols: Mapping[str, Column],
             key_names: Sequence[str] = ("key",)) -> DataFrame:
    """One row per key: the row with the smallest ``order``."""
    picked = F.struct(*[c.alias(n) for n, c in cols.items()])
    keyed = df.select(*[c.alias(n) for n, c in zip(key_names, keys)], picked.alias("_v"), F.struct(*order).alias("_o"))
    best = keyed.groupBy(*key_names).agg(F.min(F.struct("_o", "_v")).alias("_b"))
    return best.select(*key_names, "_b._v.*")


def constants(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Small table written out in code; it stays in the JVM and is safe to broadcast."""
    return F.broadcast(with_rows(spark.range(1), rows, names).select(*names))


def _literal(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "r'" + value + "'" if "'" not in value and "\\" in value else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def with_rows(df: DataFrame, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Every row of ``df`` combined with every row of a small fixed table (a report skeleton)."""
    cells = ", ".join("struct(" + ", ".join(f"{_literal(v)} as `{n}`" for n, v in zip(names, r)) + ")" for r in rows)
    return df.select("*", F.expr(f"inline(array({cells}))"))


SLICE = "_slice"
SAMPLED = 20  # rows per slice in the sample that the bounds are taken from


@dataclass(frozen=True)
class Slices:
    """Bounds that cut the keys that are longer than a slice into slices of their order; all other keys stay whole.

    The slice of a row follows from its own key and order, so rows that are computed again stay where they were and what the slices
    of a key add up to is aggregated from ``rows``, the frame as it was cut, without a second copy of it. False if no key is cut.
    """

    rows: DataFrame
    keys: Sequence[str]
    fields: StructType
    bounds: Sequence[tuple]

    def __bool__(self) -> bool:
        return bool(self.bounds)

    def _literal(self, values: tuple, start: int = 0) -> list[Column]:
        return [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, self.fields[start:])]

    def _is(self, key: tuple) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(v) for c, v in zip(self.keys, self._literal(key))])

    def number(self, df: DataFrame) -> DataFrame:
        """Rows with their slice: the number of their key's bounds up to them, looked up in two steps."""
        if SLICE in df.columns:
            return df
        first = len(self.keys)
        inside: dict[tuple, list[Column]] = {}
        for bound in self.bounds:
            inside.setdefault(bound[:first], []).append(F.struct(*self._literal(bound[first:], first)))
        step = math.isqrt(max(map(len, inside.values()), default=0)) + 1
        at = F.struct(*[F.col(f.name) for f in self.fields[first:]])
        kind = ArrayType(StructType(self.fields[first:]))
        mine = reduce(lambda out, key: out.when(self._is(key), F.struct(
            F.array(*inside[key][step - 1::step]).cast(kind).alias("steps"), F.array(*inside[key]).cast(kind).alias("all"))),
            inside, F.when(F.lit(False), F.lit(None)))
        found = F.transform(F.array(F.struct(mine.alias("of"), at.alias("at"))), lambda x: F.struct(
            x["of"]["all"].alias("all"), x["at"].alias("at"), (F.size(F.filter(x["of"]["steps"], lambda b: b <= x["at"])) * step).alias("n")))
        place = F.transform(found, lambda x: x["n"] + F.size(F.filter(F.slice(x["all"], x["n"] + 1, F.lit(step)), lambda b: b <= x["at"])))
        return df.withColumn(SLICE, F.when(mine.isNotNull(), place[0]).otherwise(0))

    def place(self, df: DataFrame) -> DataFrame:
        """Rows dealt by key and slice; they stay so in what follows as long as the slice is kept."""
        return df if SLICE in df.columns or not self else self.number(df).repartition(*self.keys, SLICE)

    def is_cut(self) -> Column:
        """Whether the key of a row is one of those that are cut."""
        keys = list(dict.fromkeys(b[:len(self.keys)] for b in self.bounds))
        if len(self.keys) == 1:
            key, known = F.col(self.keys[0]), [k for k, in keys if k is not None]
            found = key.isin(known) if known else F.lit(False)
            return F.coalesce(found, F.lit(False)) | key.isNull() if len(known) < len(keys) else found
        return reduce(lambda a, b: a | b, [self._is(k) for k in keys])

    def same(self) -> Column:
        """Join condition of a row with what its slice was handed, see ``handed``."""
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.keys)],
                      F.col(SLICE) == F.col("_s"))

    def handed(self, df: DataFrame, columns: Sequence[str], part: Column, give: Column, out: str) -> DataFrame:
        """What a slice of a cut key is handed by the others: ``part`` is aggregated per slice as ``_part``, ``give`` is taken over
        these by key. At most a row per bound and one per key, written out, as later passes read it again."""
        source = self.rows if set(columns) <= set(self.rows.columns) else df
        parts = self.number(source.filter(self.is_cut())).groupBy(*self.keys, SLICE).agg(part.alias("_part"))
        return F.broadcast(materialise(parts.select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.keys)], F.col(SLICE).alias("_s"), give.alias(out))))


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], sample: DataFrame | None = None) -> Slices:
    """Cuts keys that are longer than a slice, of which there are as many as shuffles have partitions.

    The bounds come from some rows of ``sample`` (a frame of the same keys and order that costs less to read; by default ``df``). They
    decide which task sums a row, never what comes out. Rows that would not come out the same a second time are written out first, as are
    rows that are shuffled to be made, unless there is a ``sample``: their copy is read instead of shuffling them again.
    """
    made = df._jdf.queryExecution()
    if not made.analyzed().deterministic() or sample is None and re.search(r"(?<!Broadcast)Exchange", made.executedPlan().toString()):
        df, sample = materialise(df), None
    number = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = df.select(*keys, *order).schema
    some = (df if sample is None else sample).select(*keys, *order).orderBy(F.rand(7)).limit(number * SAMPLED)
    rows = [tuple(r) for r in some.orderBy(*keys, *order).collect()]
    # leading columns of the order that tell nearly all rows apart
    apart = [len({repr(r[:n]) for r in rows}) for n in range(len(keys) + 1, len(fields) + 1)]
    width = len(keys) + next((i for i, n in enumerate(apart, 1) if 10 * n >= 9 * apart[-1]), len(order))
    found = {repr(r): r for r in (rows[len(rows) * i // number][:width] for i in range(1, number) if rows)}
    inside = Counter(repr(r[:len(keys)]) for r in found.values())
    return Slices(df, list(keys), StructType(fields.fields[:width]), [r for r in found.values() if inside[repr(r[:len(keys)])] > 1])


def group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column], hot: bool | Slices = False) -> DataFrame:
    """Aggregates of a key on each of its rows.

    A window shares the partitioning of other windows over the same keys. With ``hot`` (some key has more rows than a task should
    take) the aggregates are combined before the shuffle and joined back; if the rows are cut into ``Slices`` already, this is done
    for the keys that are cut only. ``stats`` then read columns that the rows had when they were cut.
    """
    if not hot:
        whole = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(whole) for n, c in stats.items()})
    cut = isinstance(hot, Slices)
    source = hot.rows.filter(hot.is_cut()) if cut else df
    totals = source.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]).agg(
        *[c.alias(f"_total_{n}" if cut else n) for n, c in stats.items()])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    if not cut:
        return df.join(totals, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
    inside = Window.partitionBy(*keys, SLICE)
    rows = hot.place(df).withColumns({n: c.over(inside) for n, c in stats.items()})
    totals = F.broadcast(materialise(totals.withColumn("_cut", F.lit(True))))  # at most a row per two bounds
    return rows.join(totals, same, "left").select(*df.columns, *([] if SLICE in df.columns else [SLICE]), *[
        F.when(F.col("_cut"), F.col(f"_total_{n}")).otherwise(F.col(n)).alias(n) for n in stats])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                hot: bool | Slices = False) -> DataFrame:
    """Running total per key in ``order``, which must be unique inside a key.

    A plain window puts a whole key into one task. With ``hot`` keys that are longer than a slice are cut, so a hot key
    spans many tasks; each slice is summed on its own and receives the total of the slices before it.
    """
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cuts = hot if isinstance(hot, Slices) else slices(df, keys, order) if hot else None
    rows = cuts.rows if cuts is not None and cuts is not hot else df
    if not cuts:
        return rows.withColumn(out, F.sum(value).over(whole))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = cuts.handed(rows, [value], F.sum(value), F.sum("_part").over(earlier), "_carried")
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cuts.place(rows).withColumn("_local", F.sum(value).over(inside))
    total = F.when(F.col("_local").isNull() & F.col("_carried").isNull(), F.lit(None)).otherwise(
        F.coalesce("_local", F.lit(0)) + F.coalesce("_carried", F.lit(0)))
    kind = df.select(F.sum(value).alias(out)).schema[out].dataType
    kept = [*df.columns, SLICE] if cuts is hot and SLICE not in df.columns else df.columns
    return local.join(carried, cuts.same(), "left").select(*kept, total.cast(kind).alias(out))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, hot: bool = False) -> DataFrame:
    """Row number per key; with ``hot`` keys too big for one task are numbered in slices."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return (running_sum(one, keys, order, "_one", out, hot)
            .withColumn(out, F.col(out).cast("int")).drop("_one"))


def carry(df: DataFrame, keys: Sequence[str], seq: str, col: str, out: str, backward: bool = False,
          hot: bool | Slices = False) -> DataFrame:
    """Last non-null ``col`` up to each row, or with ``backward`` the next one from it on.

    With ``hot`` keys that are longer than a slice are cut; a row without a value in its own slice takes the nearest one of the
    slices before (or after) it.
    """
    # walking backward is a descending order: a frame that looks ahead would be recomputed per row
    along = F.col(seq).desc() if backward else F.col(seq).asc()

    def fill(w, c):
        return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))

    cuts = hot if isinstance(hot, Slices) else slices(df, keys, [seq]) if hot else None
    rows = cuts.rows if cuts is not None and cuts is not hot else df
    if not cuts:
        return rows.withColumn(out, fill(Window.partitionBy(*keys).orderBy(along), col))
    named = F.when(F.col(col).isNotNull(), F.struct(F.col(seq), F.col(col).alias("v")))
    w = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc() if backward else F.col(SLICE).asc())
    near = F.last("_part", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    edges = cuts.handed(rows, [col], (F.min(named) if backward else F.max(named))["v"], near, "_near")
    local = cuts.place(rows).withColumn("_local", fill(Window.partitionBy(*keys, SLICE).orderBy(along), col))
    kept = [*df.columns, SLICE] if cuts is hot and SLICE not in df.columns else df.columns
    return local.join(edges, cuts.same(), "left").select(*kept, F.coalesce("_local", "_near").alias(out))


def parent_below(df: DataFrame, keys: Sequence[str], seq: str, header: str, out: str,
                 hot: bool = False) -> DataFrame:
    """Give each row the nearest header at or after it inside its file."""
    return carry(df, keys, seq, header, out, backward=True, hot=hot)


def global_row_number(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Row number over the whole frame without one big partition.

    A distributed sort gives every row its partition and its place in it; partition sizes (one row
    per partition) give the offsets. The sorted rows are written out so that both passes see the
    same partitions even when an executor is lost.
    """
    placed = materialise(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    slot = F.shiftrightunsigned("_place", 33)
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    numbered_rows = placed.withColumn("_slot", slot).join(F.broadcast(offsets), "_slot")
    return numbered_rows.select(*df.columns, (inside + F.col("_off") + 1).cast("bigint").alias(out))


def with_totals(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, str], marks: Mapping[str, object],
                also: Sequence[str] = (), hot: bool = False) -> DataFrame:
    """Append one total row per ``keys``: summed columns, fixed marks, everything else null.

    The totals are window sums over the group and its first row hands on the total beside itself, so ``rows`` is planned and read
    once and shuffled once, also by windows over the same keys that it has already. With ``hot`` (some group has more rows
    than a task should take) totals are aggregated before the shuffle instead, for which ``rows`` is read twice.
    """
    fields = rows.schema.fields
    if hot:
        total = rows.groupBy(*keys, *also).agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()])
        total = total.select(*keys, *also, *sums, *[F.lit(v).alias(n) for n, v in marks.items()])
        return rows.unionByName(total.select(*[
            F.col(f.name).cast(f.dataType) if f.name in total.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]))
    group = Window.partitionBy(*keys, *also)
    summed = rows.withColumns({**{f"_total_{c}": F.sum(c).over(group).cast(t) for c, t in sums.items()},
                               "_turn": F.row_number().over(group.orderBy(*keys))})  # any row of the group
    given = {**{c: F.col(c) for c in (*keys, *also)}, **{c: F.col(f"_total_{c}") for c in sums}, **{n: F.lit(v) for n, v in marks.items()}}
    own = F.struct(*[F.col(f.name) for f in fields])
    total = F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    return summed.select(F.inline(F.when(F.col("_turn") == 1, F.array(own, total)).otherwise(F.array(own))))


def listing(df: DataFrame, keys: Sequence[str], order: str, sums: Mapping[str, str], account: str = "account_no",
            also: Sequence[str] = (), hot: bool = False) -> DataFrame:
    """DATA rows numbered inside their group plus one TOTAL row per group."""
    rows = numbered(df.withColumn("row_type", F.lit("DATA")), keys, [order], "row_no", hot)
    return with_totals(rows, keys, sums, {account: "TOTAL", "row_type": "TOTAL"}, also, hot)


def pivot_sums(value: Column, by: Column, names: Mapping[str, object], dtype: str, zero: bool = True) -> list[Column]:
    """One conditional sum per target column; a single pass, no pivot shuffle."""
    nil = F.lit(0) if zero else F.lit(None)
    return [F.sum(F.when(by == F.lit(v), value).otherwise(nil.cast(dtype))).cast(dtype).alias(n)
            for n, v in names.items()]


def long_rows(df: DataFrame, keep: Sequence[str], rows: Sequence[tuple[object, ...]], names: Sequence[str],
              value: str) -> DataFrame:
    """Wide to long: each spec row names its labels and, last, the expression giving its value."""
    cells = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r[:-1])], r[-1].alias(value))
                      for r in rows])
    return df.select(*keep, F.inline(cells))


def null_safe_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]], how: str) -> DataFrame:
    return left.join(right, reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs]), how)


def range_subtotals(leaves: DataFrame, keys: Sequence[str], order: str, amount: str,
                    spec: Mapping[int, Column]) -> DataFrame:
    """Subtotal rows from leaf rows in one pass.

    ``spec`` maps a target row to the signed weight a leaf contributes to it (null or 0 for none),
    so all subtotals of all keys come from a single partial aggregation instead of one scan each.
    """
    sums = leaves.groupBy(*keys).agg(*[
        F.sum(F.col(amount) * F.coalesce(weight, F.lit(0))).alias(f"_r{row}") for row, weight in spec.items()])
    cells = F.array(*[F.struct(F.lit(row).alias(order), F.col(f"_r{row}").alias(amount)) for row in spec])
    return sums.select(*keys, F.inline(cells))


def between(col: str, lo: int, hi: int, *, but: Sequence[int] = (), sign: int = 1) -> Column:
    """Weight of a leaf whose row lies in [lo, hi] and is not excluded."""
    inside = F.col(col).between(lo, hi)
    if but:
        inside = inside & ~F.col(col).isin(*but)
    return F.when(inside, F.lit(sign))


def history_triplet(current: DataFrame, history: DataFrame | None, target: str | None, date_col: str,
                    period_col: str = "type_period") -> DataFrame:
    """Current rows plus the PREV and YOY rows found in the report's own history.

    PREV is the last load before the month of the target date; YOY the last load of the year before
    that is not after the same month start. Without history or target only CURR rows come out.
    """
    if history is None or not target:
        return current
    month = F.trunc(F.lit(target).cast("date"), "month")
    old = history.filter(F.col(period_col) == "CURR")
    loaded = F.col(date_col).cast("date")
    year_ago = F.add_months(month, -12)
    prev = old.filter(loaded < month).agg(F.max(date_col)).scalar()
    yoy = old.filter((F.year(loaded) == F.year(F.add_months(F.lit(target).cast("date"), -12)))
                     & (loaded <= year_ago)).agg(F.max(date_col)).scalar()
    out = current
    for tag, pick in (("PREV", prev), ("YOY", yoy)):
        rows = old.filter(F.col(date_col) == pick).withColumn(period_col, F.lit(tag)) \
            .withColumn(date_col, F.lit(target))
        out = out.unionByName(rows.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields]))
    return out


def year_triplet(current: DataFrame, history: DataFrame | None, year: int | None, year_col: str = "report_year",
                 period_col: str = "type_period") -> DataFrame:
    """Current rows plus the last and second-last earlier report year of the own history."""
    if history is None or year is None:
        return current
    old = history.filter((F.col(period_col) == "CURR") & (F.col(year_col) < year))
    last = old.agg(F.max(year_col)).scalar()
    second = old.filter(F.col(year_col) < last).agg(F.max(year_col)).scalar()
    out = current
    for tag, pick in (("PREV", last), ("YOY", second)):
        rows = old.filter(F.col(year_col) == pick).withColumn(period_col, F.lit(tag)).withColumn(year_col, F.lit(year))
        out = out.unionByName(rows.select(*[F.col(f.name).cast(f.dataType) for f in current.schema.fields]))
    return out
