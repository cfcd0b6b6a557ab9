"""Bronze tables: state from changes, children that follow their parent, and the tables' storage.

The data work is frame to frame: ``merged`` folds changes into a state, ``children_of`` keeps what came with the winning events.
Neither depends on how often or in which order changes arrive, so a batch that is applied again, or a stream that starts over with a
new checkpoint, changes nothing. Storage only has to keep rows; ``ParquetStore`` is one, a table format's own MERGE another.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from daybook.operators.staging import names_in, remove
from daybook.sources.keyed import PREFIXES, KeyedTable

C = F.col
ORDER = ("__lsn", "__ts_ms", "__offset")


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The row with the greatest order per key; the values themselves end the order. Missing order columns count as null."""
    rest = [c for c in rows.columns if c not in keys]
    at = F.struct(*[(C(c) if c in rows.columns else F.lit(None)).alias(c) for c in order])
    best = rows.groupBy(*keys).agg(F.max(F.struct(at.alias("o"), F.struct(*rest).alias("v"))).alias("b"))
    return best.select(*keys, "b.v.*").select(*rows.columns)


def merged(state: DataFrame | None, changes: DataFrame | None, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """State after the changes: the greatest order wins whatever came first, deletes stay as marked rows.

    Only rows of touched keys are compared; the others pass through.
    """
    if changes is None:
        return state
    if state is None:
        return newest(changes, keys, order)
    touched = changes.select(*keys).distinct()
    contested = state.join(touched, list(keys), "left_semi").unionByName(changes, allowMissingColumns=True)
    return state.join(touched, list(keys), "left_anti").unionByName(newest(contested, keys, order), allowMissingColumns=True)


def living(state: DataFrame) -> DataFrame:
    """State without deleted keys; ``__op`` 'd' marks a delete."""
    return state.filter(~C("__op").eqNullSafe("d"))


def children_of(children: DataFrame, state: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The children that came with the winning event of their key; a key whose new state has none, or that was deleted, has none."""
    owner = living(state).select(*[C(c).alias(f"_{c}") for c in (*keys, *order)])
    same = None
    for c in (*keys, *order):
        equal = C(c) == C(f"_{c}") if c in keys else C(c).eqNullSafe(C(f"_{c}"))
        same = equal if same is None else same & equal
    return children.join(owner, same, "left_semi").distinct()  # a batch applied twice stored them twice


class Store(Protocol):
    """Where rows are kept. ``read`` gives the last full copy and the rows appended since; None where there are none."""

    def read(self, name: str) -> tuple[DataFrame | None, DataFrame | None]: ...

    def append(self, name: str, rows: DataFrame) -> None: ...

    def replace(self, name: str, rows: DataFrame) -> None: ...


class ParquetStore:
    """Tables as parquet below a folder that all executors share, for one writer per table.

    Appended rows belong to the generation that is current; ``replace`` writes a full copy as the next generation and then
    makes it current with one small mark, so a copy that was cut short is never read. Older generations stay for readers that
    planned on them until ``forget`` removes them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _frame(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.option("mergeSchema", True).parquet(path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _generation(self, name: str) -> int:
        marks = self._frame(f"{self.root}/{name}/marks")
        return 0 if marks is None else marks.agg(F.max("generation")).first()[0]

    def read(self, name: str) -> tuple[DataFrame | None, DataFrame | None]:
        """Only the current generation's folders are listed, and only its footers are read."""
        current = self._generation(name)
        folder = f"{self.root}/{name}/rows/generation={current}"
        return self._frame(f"{folder}/full_copy=1") if current else None, self._frame(f"{folder}/full_copy=0")

    def append(self, name: str, rows: DataFrame) -> None:
        rows.withColumns({"generation": F.lit(self._generation(name)), "full_copy": F.lit(0)}).write.mode("append") \
            .partitionBy("generation", "full_copy").parquet(f"{self.root}/{name}/rows")

    def replace(self, name: str, rows: DataFrame) -> None:
        following = self._generation(name) + 1
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/rows/generation={following}/full_copy=1")
        self.spark.range(1).select(F.lit(following).alias("generation")).write.mode("append").parquet(f"{self.root}/{name}/marks")

    def forget(self, name: str, keep: int = 1) -> int:
        """Remove generations older than the last ``keep`` before the current one, which no reader may be using; returns how many."""
        oldest, gone = self._generation(name) - keep, 0
        for folder in names_in(self.spark, f"{self.root}/{name}/rows"):
            if folder.startswith("generation=") and int(folder.partition("=")[2]) < oldest:
                remove(self.spark, f"{self.root}/{name}/rows/{folder}")
                gone += 1
        return gone


def align(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Columns of a target table in its order; missing ones are null."""
    return df.select(*[C(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in columns])


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> int:
    """Replace exactly the partitions present in ``df``; returns the row count seen while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*columns).mode("overwrite").parquet(path)
    return seen.get["n"]


def write_day(df: DataFrame, path: str, day: str, column: str = "business_date") -> int:
    """Stamp a pulled table with its day and replace that day only."""
    return overwrite_partitions(df.withColumn(column, F.lit(day).cast("date")), path, [column])


def merge_report(old: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A stored report after a load: rows whose key the load has are replaced, all others stay. Keys compare with nulls equal."""
    if old is None:
        return new
    given = new.select(*[C(k).alias(f"_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        equal = C(k).eqNullSafe(C(f"_{k}"))
        same = equal if same is None else same & equal
    return old.join(given, same, "left_anti").unionByName(new, allowMissingColumns=True)


def write_report(store: Store, name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Store a report by key and return all that is stored, which is the history the next load compares itself with.

    A second load replaces the rows of its own keys only. The load time is stamped here, so that the report itself stays reproducible.
    """
    full, _ = store.read(name)
    store.replace(name, merge_report(full, df.withColumn("updated_at", F.current_timestamp()), keys))
    return store.read(name)[0]


def upsert_report(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None,
                  prefixes: int = PREFIXES) -> DataFrame:
    """Store a report by key, rewriting only the hash prefixes that hold keys of this load, and return all that is stored.

    Placed ``by`` the load date (one of the keys), a day's load reads and writes the prefix of that day and nothing else. The load time is
    stamped here, so that the report itself stays reproducible.
    """
    stored = KeyedTable(spark, path, keys, prefixes, by)
    stored.upsert(df.withColumn("updated_at", F.current_timestamp()))
    return stored.read()


def save_partitions(df: DataFrame, name: str, columns: Sequence[str]) -> None:
    """Catalog table by partition: created if absent, else exactly the partitions present in ``df`` are replaced."""
    if df.sparkSession.catalog.tableExists(name):
        mode, conf = "spark.sql.sources.partitionOverwriteMode", df.sparkSession.conf  # inserts into tables know no such option
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)
        finally:
            conf.set(mode, before)
    else:
        df.write.partitionBy(*columns).saveAsTable(name)


def save_table(df: DataFrame, name: str) -> None:
    """Rebuild a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def merge_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], keep_old_when_null: Sequence[str] = (),
               only_if: Column | None = None) -> DataFrame:
    """Upsert as one full join: new values win, listed columns keep the old value when the new one is null.

    ``only_if`` may compare ``o.<col>`` and ``n.<col>`` to accept an update. Columns that ``new`` does not
    have stay as they are.
    """
    o, n = old.alias("o"), new.withColumn("_hit", F.lit(True)).alias("n")
    same = F.lit(True)
    for key in keys:
        same = same & (C(f"o.{key}") == C(f"n.{key}"))
    taken = C("n._hit").isNotNull()
    fresh = old.withColumn("_old", F.lit(True)).alias("o").join(n, same, "full")
    if only_if is not None:
        taken = taken & (C("o._old").isNull() | only_if)
    out = []
    for f in old.schema.fields:
        if f.name in keys:
            out.append(F.coalesce(f"n.{f.name}", f"o.{f.name}").alias(f.name))
        elif f.name not in new.columns:
            out.append(C(f"o.{f.name}").alias(f.name))
        else:
            value = F.coalesce(f"n.{f.name}", f"o.{f.name}") if f.name in keep_old_when_null else C(f"n.{f.name}")
            out.append(F.when(taken, value).otherwise(C(f"o.{f.name}")).cast(f.dataType).alias(f.name))
    return fresh.select(*out)
