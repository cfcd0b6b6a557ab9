"""Tables kept by key: rows are laid out by a hash prefix of their key, and an upsert rewrites only the prefixes its batch touches.

The layout is a partition column, so reading, merging and replacing a prefix is ordinary partition pruning and dynamic partition overwrite. Which
prefixes a batch touches is at most ``prefixes`` small numbers. Applying a batch again gives the same rows, also after a run that
was cut short between two prefixes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from daybook.operators.staging import fresh_path, materialise, names_in, remove

C = F.col
PREFIX = "_prefix"
PREFIXES = 256  # a batch of a few rows then reads and writes below one part in a hundred of the table


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [C(f"{left}.{k}").eqNullSafe(C(f"{right}.{k}")) for k in keys])


class KeyedTable:
    """One row per key below ``path``, a folder that all executors share; one writer at a time.

    ``by`` names the key columns whose hash places a row (all of them, if not given): a report that is loaded by day and keyed by day and
    account touches one prefix a load if it is placed by the day, and a few hundred accounts touch a few hundred prefixes if
    placed by the account. Nulls in keys are equal to each other. Number of prefixes and placing columns are written beside the rows
    with the first batch and hold from then on; the columns are written there too, so planning a read opens no data file.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], prefixes: int = PREFIXES, by: Sequence[str] | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.prefixes, self.by = prefixes, list(by or keys)
        if not set(self.by) <= set(self.keys):
            raise ValueError("rows are placed by key columns only")
        self.known = self._layout()
        if self.known:
            if self.known["keys"] != self.keys:
                raise ValueError(f"{path} is keyed by {self.known['keys']}")
            self.prefixes, self.by = self.known["prefixes"], self.known["by"]

    def _layout(self) -> dict | None:
        try:
            lines = self.spark.read.text(f"{self.path}/_layout").collect()  # one for each time columns were added
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return max((json.loads(line[0]) for line in lines), key=lambda known: known["version"], default=None)

    def _describe(self, columns: StructType) -> None:
        """Write down the columns if some of them are new."""
        known = self.known or {"version": 0, "keys": self.keys, "prefixes": self.prefixes, "by": self.by, "columns": StructType([]).jsonValue()}
        old = StructType.fromJson(known["columns"])
        types = {f.name: f.dataType for f in old}
        for f in columns:
            if f.name in types and types[f.name] != f.dataType:
                raise ValueError(f"{f.name} is stored as {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
        new = StructType([*old, *(StructField(f.name, f.dataType) for f in columns if f.name not in types)])
        if len(new) > len(old):
            self.known = {**known, "version": known["version"] + 1, "columns": new.jsonValue()}
            self.spark.createDataFrame([(json.dumps(self.known),)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/_layout")

    def prefix(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.prefixes)).cast("int")

    def _stored(self, prefixes: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of some prefixes, or all; only their folders are listed."""
        if self.known is None:
            return None
        columns = StructType.fromJson(self.known["columns"]).add(PREFIX, IntegerType())
        if prefixes is None:
            return self.spark.read.schema(columns).parquet(self.path)
        present = {f"{PREFIX}={p}" for p in prefixes}.intersection(names_in(self.spark, self.path))
        if not present:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).option("basePath", self.path).parquet(*[f"{self.path}/{name}" for name in sorted(present)])

    def read(self) -> DataFrame | None:
        """All rows; None if nothing was ever stored."""
        rows = self._stored()
        return None if rows is None else rows.drop(PREFIX)

    def touched(self, rows: DataFrame) -> list[int]:
        """The prefixes that hold the keys of ``rows``: at most ``prefixes`` numbers."""
        return sorted(r[0] for r in rows.select(self.prefix()).distinct().collect())

    def part(self, prefixes: Sequence[int]) -> DataFrame | None:
        """Stored rows of some prefixes; no folder of another is listed or read."""
        return self._stored(prefixes)

    def _files(self, prefix: int) -> set[str]:
        return set(names_in(self.spark, f"{self.path}/{PREFIX}={prefix}"))

    def merged(self, changes: DataFrame, prefixes: Sequence[int], gone: Column | None = None) -> DataFrame:
        """The rows of the touched prefixes after the changes; ``gone`` tells which changes delete their key."""
        new = changes if gone is None else changes.filter(~F.coalesce(gone, F.lit(False)))
        new = new.withColumn(PREFIX, self.prefix())
        old = self.part(prefixes)
        if old is None:
            return new
        keys = changes.select(*self.keys).withColumn(PREFIX, self.prefix()).distinct()
        stay = old.alias("o").join(keys.alias("n"), (C(f"o.{PREFIX}") == C(f"n.{PREFIX}")) & _same(self.keys, "o", "n"), "left_anti")
        return stay.unionByName(new, allowMissingColumns=True)

    def upsert(self, changes: DataFrame, gone: Column | None = None) -> list[int]:
        """Replace or add the rows of ``changes``, at most one per key; returns the prefixes that were rewritten.

        ``gone`` tells which changes delete their key. A key that is deleted but not stored is no error; an empty batch writes nothing. Stored
        columns that a change lacks become null in its row, columns the table lacks are added.
        """
        path = fresh_path(self.spark)
        changes = materialise(changes, path)  # small beside the table, and read several times
        try:
            prefixes = self.touched(changes)
            if prefixes:
                self._describe(changes.schema)
                before = {p: self._files(p) for p in prefixes} if gone is not None else {}
                # a task per prefix, a big prefix in several: AQE deals by size
                self.merged(changes, prefixes, gone).hint("rebalance", PREFIX).write.option("partitionOverwriteMode", "dynamic") \
                    .partitionBy(PREFIX).mode("overwrite").parquet(self.path)
                for prefix in prefixes if gone is not None else ():
                    if before[prefix] and self._files(prefix) == before[prefix]:  # not written, so no row is left of it
                        remove(self.spark, f"{self.path}/{PREFIX}={prefix}")
        finally:
            remove(self.spark, path)
        return prefixes
