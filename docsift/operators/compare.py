"""Comparing two sets of outputs: metadata key by key, files byte by byte and line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metadata_diff(
    expected: DataFrame, actual: DataFrame, id_col: str = "file_id", column: str = "metadata", ignore: str | None = None
) -> DataFrame:
    """Keys of two JSON objects per file that are missing on one side or have another value.

    ``ignore`` is a pattern of keys to leave out. Objects meet on the unique file id; their keys are compared in place.
    """
    none = F.from_json(F.lit("{}"), "map<string,string>")
    as_map = lambda c: F.coalesce(F.from_json(c, "map<string,string>"), none)
    both = (
        expected.select(id_col, F.col(column).alias("expected"))
        .join(actual.select(id_col, F.col(column).alias("actual")), id_col, "full")
        .select(id_col, as_map(F.col("expected")).alias("e"), as_map(F.col("actual")).alias("a"))
    )
    keys = F.array_union(F.map_keys("e"), F.map_keys("a"))
    rows = both.select(id_col, "e", "a", F.explode(keys).alias("key"))
    rows = rows.select(
        id_col,
        "key",
        F.try_element_at("e", F.col("key")).alias("expected"),
        F.try_element_at("a", F.col("key")).alias("actual"),
    )
    if ignore is not None:
        rows = rows.where(~F.col("key").rlike(ignore))
    return rows.where(~F.col("expected").eqNullSafe(F.col("actual")))


# An output's path is unique within a root of a job only.
OUTPUT_KEY = ("job_id", "root_id", "archive_path")


def content_diff(expected: DataFrame, actual: DataFrame, key: tuple[str, ...] = OUTPUT_KEY, column: str = "content") -> DataFrame:
    """Files whose bytes differ or that exist on one side only, by a unique key. Hashes are compared, contents are not moved."""

    def digest(side: DataFrame):
        # Bytes that are a file of their own were hashed when it was written.
        here = F.sha2(F.col(column), 256)
        return F.coalesce("stored.sha256", here) if "stored" in side.columns else here

    e = expected.select(*key, digest(expected).alias("expected_sha256"))
    a = actual.select(*key, digest(actual).alias("actual_sha256"))
    return e.join(a, list(key), "full").where(~F.col("expected_sha256").eqNullSafe(F.col("actual_sha256")))


def line_diff(expected: DataFrame, actual: DataFrame, key: tuple[str, ...] = OUTPUT_KEY, column: str = "text") -> DataFrame:
    """Lines that differ, ``key, line_no, expected, actual``; NULL where a side has no such line.

    Texts meet once on their unique key and are zipped in place, so lines are never shuffled.
    """
    both = (
        expected.select(*key, F.col(column).alias("e"))
        .join(actual.select(*key, F.col(column).alias("a")), list(key), "full")
        .where(~F.col("e").eqNullSafe(F.col("a")))
    )
    none = F.array().cast("array<string>")
    lines = F.arrays_zip(
        F.coalesce(F.split("e", "\r?\n", -1), none).alias("expected"),
        F.coalesce(F.split("a", "\r?\n", -1), none).alias("actual"),
    )
    rows = both.select(*key, F.posexplode(lines).alias("line_no", "line")).select(*key, "line_no", "line.*")
    return rows.where(~F.col("expected").eqNullSafe(F.col("actual")))


def checksum_order(outputs: DataFrame) -> DataFrame:
    """Outputs with their ``place`` from 1 in their root of a job by checksum, which does not depend on how they were found.

    Places are found on ids alone; equal checksums go by path.
    """
    key = ["job_id", "root_id", "archive_path", "file_id", "process_type"]
    ids = outputs.select(*key, "checksum")
    order = Window.partitionBy("job_id", "root_id").orderBy("checksum", "archive_path", "file_id", "process_type")
    return outputs.join(ids.withColumn("place", F.row_number().over(order).cast("long")).drop("checksum"), key)
