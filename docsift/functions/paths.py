"""Entry names, archive paths and lineage chains. All native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/", -1), lambda s: (s != "") & (s != "."))


def is_directory(entry: Column) -> Column:
    return entry.endswith("/")


def is_enclosed(entry: Column) -> Column:
    """True when an entry path stays below the folder it is unpacked in."""
    step = lambda s: F.when(s == "..", F.lit(-1)).otherwise(F.lit(1))
    lowest = F.aggregate(
        _segments(entry),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")),
        lambda acc, s: F.struct((acc["at"] + step(s)).alias("at"), F.least(acc["low"], acc["at"] + step(s)).alias("low")),
        lambda acc: acc["low"],
    )
    return ~entry.startswith("/") & ~F.contains(entry, F.lit("\0")) & (lowest >= 0)


def base_name(entry: Column) -> Column:
    """Last component of a path, NULL when there is none."""
    last = F.try_element_at(_segments(entry), F.lit(-1))
    return F.when(last != "..", last)


def safe_name(entry: Column) -> Column:
    """Base name of an enclosed entry, NULL for an entry that has to be refused."""
    return F.when(is_enclosed(entry), base_name(entry))


def extension(name: Column) -> Column:
    """Lower-case extension with its dot, NULL when there is none."""
    return F.nullif(F.lower(F.regexp_extract(name, r"[^/.](\.[^./]+)$", 1)), F.lit(""))


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)


def extend_chain(chain: Column, checksum: Column) -> Column:
    return F.concat(chain, F.array(checksum))


def archive_path(chain: Column, name: Column) -> Column:
    return F.array_join(F.concat(chain, F.array(name)), "/")


def child_id(parent_id: Column, ordinal: Column, name: Column) -> Column:
    """Id of a nested file from its place in the container, so that a retried task yields the same id."""
    return F.sha2(F.concat_ws("\x1f", parent_id, ordinal.cast("string"), name), 256)
