"""Shards of a corpus in random order: a two-pass external shuffle.

Pass one scatters whole records into buckets that fit in memory: the shard follows from the id alone (highest seeded hash among the
shards), the bucket within the shard from a seeded hash of the row. Pass two takes one bucket at a time, shuffles it by Fisher-Yates with a
generator seeded for that bucket, and writes it. A row's slot is its place in the bucket after the rows of the shard's earlier buckets.

A shard more takes over the rows whose highest hash it wins and moves no other row.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.operators.staging import shared_folder

SHARDS = 24
BUCKET_BYTES = 16 << 20
BROADCAST_BUCKETS = 500_000  # rows of three numbers
MOST_TASKS = 100_000  # a task takes one bucket; beyond that several, one after another
ROW_BYTES = 8  # counted for a row besides its text
SEED = 90210


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest hash for the key. Rows without a key share one shard."""
    weights = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                          lambda s: F.struct(F.xxhash64(key, s, F.lit(seed)).alias("weight"), s.alias("shard")))
    return F.array_max(weights)["shard"]


def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _shuffled(seed: int):
    """Fisher-Yates over one bucket, whose rows are first put in the order of their numbers."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        shard, bucket = (k.as_py() for k in key)
        order = np.argsort(rows.column("_row").to_numpy(), kind="stable")
        rng = np.random.default_rng([seed, shard, bucket])
        for i in range(order.size - 1, 0, -1):
            j = int(rng.integers(0, i + 1))
            order[i], order[j] = order[j], order[i]
        rows = rows.take(pa.array(order))
        return rows.set_column(rows.schema.get_field_index("_row"), "_row", pa.array(np.arange(order.size, dtype=np.int64)))

    return run


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                 bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Write ``docs`` below ``path``, a folder per shard, and return what was written with columns shard and slot.

    All columns and rows are kept, repeated ones too; a null text stays null, a null id is a key like any other; an empty table gives an
    empty result. ``shard``, ``slot`` and names beginning with ``_`` are reserved: a column of ``docs`` so named is refused.
    """
    taken = [c for c in docs.columns if c in ("shard", "slot") or c.startswith("_")]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    total = docs.agg(F.sum(row_size(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    rows = (docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_shard", shard_of(F.col(id_col), shards, seed))
            .withColumn("_bucket", F.pmod(F.xxhash64("_row", F.lit(seed + 1)), F.lit(buckets)).cast("int")))
    rows = rows.repartition(int(min(MOST_TASKS, shards * buckets)), "_shard", "_bucket")  # as many tasks as buckets, whatever the session's default
    mixed = rows.groupBy("_shard", "_bucket").applyInArrow(_shuffled(seed), rows.schema)
    mixed.withColumn("shard", F.col("_shard")).write.partitionBy("shard").parquet(path)
    written = docs.sparkSession.read.schema(mixed.schema).parquet(path)
    sizes = written.groupBy("_shard", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if shards * buckets <= BROADCAST_BUCKETS:  # a row per bucket; beyond that Spark joins as it sees fit
        starts = F.broadcast(starts)
    return written.join(starts, ["_shard", "_bucket"]).select(
        *docs.columns, F.col("_shard").alias("shard"), (F.col("_start") + F.col("_row")).alias("slot"))


def report(docs: DataFrame, path: str | None = None, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Digest of the written shards: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one shard more)."""
    path = path or f"{shared_folder(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    written = write_shards(docs.select("doc_id", "text"), path, shards=shards, bucket_bytes=bucket_bytes)
    return written.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot",
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))
