"""Bounded samples of rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_sample(rows: DataFrame, key: Column, size: int, salt: str) -> DataFrame:
    """About ``size`` of the rows, chosen by a hash of their key; all of them if there are no more.

    The rows are counted first, so nothing but the chosen rows moves. The number of rows varies by its square root, and
    is cut at a tenth above ``size``.
    """
    n = rows.count()
    if n <= size:
        return rows
    draw = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 40))
    return rows.where(draw < int((1 << 40) * size / n)).limit(size + size // 10)
