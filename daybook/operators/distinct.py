"""Exact distinct counts that add up: months roll up to quarters and years without counting again.

Values are numbered densely, and a group's values are a set of bits: 32,768 numbers to a bitmap of 4 KB. Bitmaps are built before the shuffle and
combined by OR, so a group's share of the shuffle is bounded by the number range and not by its rows; a coarser group is the OR of finer ones. It suits
groups that hold a good part of the values (periods, branches, products), not one group per value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from daybook.operators.frames import global_row_number

BUCKET, BITS = "_bucket", "_bits"


def dense_numbers(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values of a column with numbers from 1 on, without a gap; null has none."""
    return global_row_number(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], out)


def bitmaps(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Numbers (from 1 on) of each group as bitmaps, one row per group and range of 32,768 numbers. Null numbers are not counted."""
    rows = df.filter(F.col(number).isNotNull()).select(*keys, F.bitmap_bucket_number(number).alias(BUCKET), F.bitmap_bit_position(number).alias("_bit"))
    return rows.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def rolled_up(fine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups; ``keys`` are columns of ``fine``, given or derived from its keys."""
    return fine.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(bits: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct count of each group. A group that holds no value has no bitmap and no row."""
    return bits.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(out))
