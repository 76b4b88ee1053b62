"""Duplicate groups, one file per group, work done once per distinct content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.skew import join_one_to_many, without
from docsift.session import staged


def duplicate_groups(files: DataFrame, key: str = "checksum") -> DataFrame:
    """Groups of two files or more with the same key. Counts are merged before the shuffle; contents never move."""
    # Distinct roots are counted over one row per (key, root), so a hot key is reduced in parallel.
    per_root = files.groupBy(key, "root_id").agg(F.count("*").alias("n"), F.min("file_id").alias("first"))
    groups = per_root.groupBy(key).agg(
        F.sum("n").alias("n_files"), F.min("first").alias("first_file_id"), F.count("*").alias("n_roots")
    )
    return groups.where("n_files > 1")


def keep_one(files: DataFrame, key: str = "checksum", order: tuple[str, ...] = ("depth", "file_id")) -> DataFrame:
    """The first file of every group. Copies are found on ids alone; contents do not move unless copies are very many."""
    rank = list(dict.fromkeys((*order, "file_id")))
    # Written once, so that keys are computed once.
    ids = staged(files.select(*dict.fromkeys((key, *rank))), "ids")
    first = ids.groupBy(key).agg(F.min(F.struct(*rank)).alias("first")).select(F.col("first.file_id").alias("file_id"))
    copies = ids.select("file_id").join(first, "file_id", "left_anti")
    return without(files, copies, ["file_id"])


def process_distinct(
    files: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    keys: tuple[str, ...] = ("content_sha256", "mimetype"),
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """Run ``work`` on one file per distinct content and give every copy its result.

    ``work`` gets the chosen files and returns ``file_id`` and result columns. The key is a true content hash: the
    dedupe checksum makes mails equal that differ in bytes.
    """
    names = list(keys)
    # Written once, so that hashes are computed once.
    ids = staged(files.select("file_id", *names), "ids")
    first = ids.groupBy(*names).agg(F.min("file_id").alias("file_id"))
    chosen = files.join(first.select("file_id"), "file_id", "left_semi")
    results = work(chosen).join(first, "file_id").drop("file_id")
    return join_one_to_many(ids, results, names, "file_id", rows_per_slice=rows_per_slice)


def last_write_wins(outputs: DataFrame) -> DataFrame:
    """Of outputs with the same path in a root of a job, the one written last: the deepest, then the highest ordinal.

    Overwritten outputs are found on ids alone; contents do not move unless those are very many.
    """
    # process_type tells apart the outputs made from one file.
    rank = ["depth", "ordinal", "file_id", "process_type"]
    ids = staged(outputs.select("job_id", "root_id", "archive_path", *rank), "ids")
    last = ids.groupBy("job_id", "root_id", "archive_path").agg(F.max(F.struct(*rank)).alias("last")).select("last.*")
    # Written once, as whoever reads the outputs again would find the overwritten ones again.
    overwritten = staged(ids.select(*rank).join(last, rank, "left_anti"), "overwritten")
    return without(outputs, overwritten, rank)
