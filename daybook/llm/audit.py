"""How filters of documents interact: what each filter of every order removes, what it would remove in vain, and which good or toxic
documents go with it.

* Every filter stores a table of the ids of the units that fail it. A unit stands for equal rows (same document id, part and text) and
  carries how many they are, so repeated rows never meet in one task as rows.
* One more table holds, for every unit, the prefixes (sets of filters) it has survived so far, as bits: at first all 32. Filter after filter,
  the left-semi join with the filter's ids finds the units that no prefix with that filter lets through, the left-anti join those that
  pass on unchanged. After the last filter the table says for each prefix who survives it.
* What a filter removes after a prefix are the units of its table that survive the prefix; those of its table that do not are
  redundant. Both are counted by part and pattern, a few rows per part, and only these are spread over the orders.

An order's numbers depend on its prefixes as sets alone, so 32 sets stand for 120 orders.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import settle, text_bytes

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5  # words; percent of the words; percent of the code points
_SYMBOL = re.compile(rb"[#$%&*|]")
_CAPITALS, _INNER = bytes(range(65, 91)), bytes(range(0x80, 0xC0))  # A-Z; bytes that do not begin a code point
_COUNTS = ("rows", "good", "toxic")

_UNIT = "doc_id long, part string, digest binary, failing int"


def failing(text: bytes) -> int:
    """Which of the filters A to D a text fails, as bits 0 to 3."""
    words = text.split()  # bytes are cut at space and \\x09-\\x0D
    n = len(words)
    points = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    checks = (n < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * points, bool(_SYMBOL.search(text)))
    return sum(1 << k for k, failed in enumerate(checks) if failed)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in text_bytes(batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array([failing(t) for t in texts], pa.int32())],
            names=["doc_id", "part", "digest", "failing"])


def units(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """unit, doc_id, part, digest, failing (A to D), rows, good, toxic: equal rows together, with the labels of their document."""
    checked = (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("text"))
               .mapInArrow(_checked, _UNIT).groupBy("doc_id", "part", "digest").agg(F.min("failing").alias("failing"), F.count("*").alias("rows")))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    held = checked.join(marks, "doc_id", "left").select(
        F.monotonically_increasing_id().alias("unit"), "doc_id", "part", "digest", "failing", "rows",
        *(F.when(F.col(c), F.col("rows")).otherwise(0).alias(c) for c in ("good", "toxic")))
    return settle(held)


def id_tables(held: DataFrame) -> list[DataFrame]:
    """One stored table of unit ids per filter, in the order of FILTERS."""
    by_text = [held.filter(F.col("failing").bitwiseAND(1 << k) != 0).select("unit") for k in range(4)]
    # a row fails E unless it has the smallest id of its text; the id is part of the key, so a text with many copies is spread
    first = held.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    copies = held.filter(F.col("doc_id").isNotNull()).join(first, ["digest", "doc_id"], "left_anti").select("unit")
    return [settle(t) for t in (*by_text, copies)]


def _without(bit: int) -> int:
    """The prefixes, one bit each, that do not hold the filter."""
    return sum(1 << s for s in range(1 << len(FILTERS)) if not s >> bit & 1)


def survivals(held: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Units with ``alive`` (bit s: survives prefix s) and ``fails`` (bit k: is in table k)."""
    state = held.select("unit", "part", *_COUNTS, F.lit((1 << (1 << len(FILTERS))) - 1).cast("long").alias("alive"), F.lit(0).alias("fails"))
    for bit, ids in enumerate(tables):
        caught = state.join(ids, "unit", "left_semi").withColumns(
            {"alive": F.col("alive").bitwiseAND(F.lit(_without(bit)).cast("long")), "fails": F.col("fails").bitwiseOR(F.lit(1 << bit))})
        state = settle(caught.unionByName(state.join(ids, "unit", "left_anti")))
    return state


def _has(column: Column, bit: Column) -> Column:
    return F.getbit(column, bit) == 1


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part (source; null as the empty string), order and step, zeros included; an empty table gives no rows. Null texts are
    empty ones, which fail A alone (and E, if another empty text has a smaller id). Rows without an id are never copies and make no
    other row one. Rows that repeat an id are judged one by one: equal ids are not smaller ids, so equal rows do not fail E for each other.
    Several labels of one document count as good or toxic if any of them says so; labels without an id count nowhere. Other columns are not read.
    """
    held = units(docs, labels)
    state = survivals(held, id_tables(held))
    cells = state.groupBy("part", "alive", "fails").agg(*(F.sum(c).alias(c) for c in _COUNTS))  # 32 patterns a part at most
    size = len(FILTERS)
    steps = [(s, k) for s in range(1 << size) for k in range(size) if not s >> k & 1]
    pairs = cells.select("*", F.explode(F.array(*(F.struct(F.lit(s).alias("prefix"), F.lit(k).alias("filter")) for s, k in steps))).alias("p")).select(
        "part", "alive", "fails", *_COUNTS, "p.prefix", "p.filter")
    hit = _has(F.col("fails"), F.col("filter"))
    lives = _has(F.col("alive"), F.col("prefix"))
    after = _has(F.col("alive"), F.col("prefix").bitwiseOR(F.expr("shiftleft(1, filter)")))

    def total(test: Column, column: str = "rows") -> Column:
        return F.sum(F.when(test, F.col(column)).otherwise(0))

    sums = pairs.groupBy("part", "filter", "prefix").agg(
        total(after).alias("kept"), total(hit & lives).alias("removed"), total(hit & ~lives).alias("redundant"),
        total(F.col("fails") == F.expr("shiftleft(1, filter)")).alias("unique_fails"),
        total(hit & lives, "good").alias("good_lost"), total(hit & lives, "toxic").alias("toxic_lost"))
    weight = F.array(*(F.lit(factorial(n) * factorial(size - 1 - n)) for n in range(size)))[F.bit_count("prefix")]  # orders that begin with the prefix
    shares = sums.groupBy("part", "filter").agg(F.sum(F.col("removed") * weight).alias("shapley"))
    where: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(size)):
        for at, k in enumerate(order):
            where.setdefault((sum(1 << x for x in order[:at]), k), []).append(("".join(FILTERS[x] for x in order), at + 1))
    places = F.explode(F.from_json(
        F.create_map(*(F.lit(x) for (s, k), found in where.items() for x in (s * size + k, "[%s]" % ",".join(f'{{"o":"{o}","s":{at}}}' for o, at in found))))
        [F.col("prefix") * size + F.col("filter")], "array<struct<o string, s int>>"))
    return (sums.join(shares, ["part", "filter"]).select("*", places.alias("at"))
            .select("part", F.col("at.o").alias("filter_order"), F.col("at.s").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
ORACLE_SQL = rf"""
with docs as materialized (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, min(doc_id) over (partition by coalesce(text, '')) as least from documents),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels where doc_id is not null group by doc_id),
counted as (select *, {_WORDS} as words from docs),
tests as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         [len(words) < {MIN_WORDS}, 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words),
          100 * len(regexp_extract_all(t, '[A-Z]')) > {MAX_CAPITALS} * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] as fails
  from counted left join marks using (doc_id)),
cells as materialized (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from tests group by part, fails),
orders(filter_order) as (values {", ".join("('" + "".join(o) + "')" for o in permutations(FILTERS))}),
steps as (select filter_order, step, [instr('{FILTERS}', x) for x in string_split(filter_order, '')] as f from orders, range(1, {len(FILTERS) + 1}) s(step)),
hits as (
  select part, filter_order, step, f[step] as filter, n, good, toxic, fails[f[step]] as hit, list_bool_or([false] || [fails[x] for x in f[1:step - 1]]) as gone,
         len([x for x in fails if x]) = 1 as alone
  from cells, steps),
sums as (
  select part, filter_order, step, filter, sum(n) filter (not hit and not gone) as kept, sum(n) filter (hit and not gone) as removed,
         sum(n) filter (hit and gone) as redundant, sum(n) filter (hit and alone) as unique_fails,
         sum(good) filter (hit and not gone) as good_lost, sum(toxic) filter (hit and not gone) as toxic_lost
  from hits group by all)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
       coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, filter), 0)::bigint as shapley
from sums
"""
