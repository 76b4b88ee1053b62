"""Joins that move as little as they can, on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table with at most this many rows of ids is broadcast; beyond it the rows are shuffled instead.
MAX_BROADCAST_ROWS = 1_000_000


def is_small(frame: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    return frame.limit(max_rows + 1).count() <= max_rows


def hot_keys(counts: DataFrame, keys: list[str], rows_per_slice: int) -> DataFrame:
    """``keys, slices`` of the keys with more rows than a slice, from one row per key with its row count ``n``.

    There are at most as many of them as slices fit in the table.
    """
    hot = counts.where(F.col("n") > rows_per_slice)
    return hot.select(*keys, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("slices"))


def join_one_to_many(
    many: DataFrame, one: DataFrame, keys: list[str], row_id: str, how: str = "inner", rows_per_slice: int = 1_000_000
) -> DataFrame:
    """Equi-join of many rows per key with one row per key, with the rows of hot keys cut into slices.

    Rows of a hot key are spread over slices by their id, and its single counterpart is repeated once per slice.
    Every key gets all its rows; none is dropped.
    """
    counts = many.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = hot_keys(counts, keys, rows_per_slice)
    slices = F.coalesce(F.col("slices"), F.lit(1))
    left = many.join(hot, keys, "left").withColumn("slice", F.pmod(F.xxhash64(row_id), slices).cast("int")).drop("slices")
    right = one.join(hot, keys, "left").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("slices")
    return left.join(right, [*keys, "slice"], how).drop("slice")


def join_to_small(
    many: DataFrame, one: DataFrame, keys: list[str], row_id: str, how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Join of many rows per key with a table of one narrow row per key, without moving the many if it is small."""
    if is_small(one, max_rows):
        return many.join(F.broadcast(one), keys, how)
    return join_one_to_many(many, one, keys, row_id, how)


def without(rows: DataFrame, unwanted: DataFrame, keys: list[str], max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows whose unique keys are not listed. The rows stay where they are unless the list is long.

    The list is read twice, so it is best a written table or cheap to compute.
    """
    if is_small(unwanted, max_rows):
        return rows.join(F.broadcast(unwanted), keys, "left_anti")
    return rows.join(unwanted, keys, "left_anti")
