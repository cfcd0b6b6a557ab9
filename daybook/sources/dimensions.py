"""Dimensions deduplicated once and stored by key, for all marts of a day.

A mart that reads a dimension takes the newest version of each record, which is a sort aggregation and a shuffle of the whole table, for every dimension and
every mart. Stored here, a table has one row per key already, in buckets of the key: joins take it as it lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.columns import k
from daybook.operators.staging import shuffles_removed

KEY = "_key"


def newest_rows(df: DataFrame, order: str = "curr_no") -> DataFrame:
    """One row per record with its key in ``_key``: the greatest ``order`` (if the table has one), of equal ones the greatest row as a whole.

    Rows without a key go.
    """
    versions = df.withColumn(KEY, k("recid")).filter(F.col(KEY).isNotNull())
    rank = [F.col(order).alias("_order")] if order in df.columns else []
    best = versions.groupBy(KEY).agg(F.max(F.struct(*rank, F.struct(*df.columns).alias("_row"))).alias("_best"))
    return best.select(KEY, "_best._row.*")


def store_dimensions(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Store the newest rows of each table as catalog table ``<prefix><name>`` and return them by name.

    As many buckets as shuffles have partitions (the default) let a join shuffle its other side only. One task writes one bucket, so there is one
    file for each.
    """
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df in tables.items():
        with shuffles_removed(spark):
            newest_rows(df).repartition(number, KEY).write.mode("overwrite").bucketBy(number, KEY).sortBy(KEY).saveAsTable(prefix + name)
    return {name: spark.table(prefix + name) for name in tables}


def drop_dimensions(spark: SparkSession, names: Iterable[str], prefix: str) -> None:
    for name in names:
        spark.sql(f"drop table if exists {prefix}{name}")
