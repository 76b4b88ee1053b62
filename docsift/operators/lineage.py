"""Where files come from: parents, ancestors, totals per root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.skew import join_one_to_many


def with_parent(files: DataFrame, rows_per_slice: int = 1_000_000) -> DataFrame:
    """Nested files with name, type and checksum of their container. A container may hold most of all files."""
    parents = files.select(
        F.col("file_id").alias("parent_id"),
        F.col("name").alias("parent_name"),
        F.col("mimetype").alias("parent_mimetype"),
        F.col("checksum").alias("parent_checksum"),
    )
    nested = files.where("parent_id is not null").drop("content")
    return join_one_to_many(nested, parents, ["parent_id"], "file_id", rows_per_slice=rows_per_slice)


def ancestors(files: DataFrame) -> DataFrame:
    """One row per file and level above it: ``file_id, level, ancestor_checksum``. Reads the chain, joins nothing."""
    return files.select("file_id", F.posexplode("id_chain").alias("at", "ancestor_checksum")).select(
        "file_id", (F.col("at") + 1).alias("level"), "ancestor_checksum"
    )


def total_count(files: DataFrame) -> DataFrame:
    """Files per root of a job, the root itself included."""
    return files.groupBy("job_id", "root_id").agg(F.count("*").alias("n_files"))
