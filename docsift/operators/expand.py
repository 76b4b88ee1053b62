"""Containers to the files inside them, one level or all levels deep."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docsift.functions.identity import buffer_md5, identity_bytes
from docsift.functions.mime import format_content_type, identify_or_default
from docsift.functions.paths import child_id, extend_chain, is_directory, safe_name
from docsift.operators.openers import Limits, Openers, opened
from docsift.schemas import EXPANDED, FILES, LEVEL, MAIL, MBOX, STORED, ZIP
from docsift.session import CONTENT_TABLE, new_run_dir, own_shuffles, spread
from docsift.sources.contents import looked_checksum, looked_type
from docsift.sources.large import located_members, opened_as_a_whole, with_values

MESSAGE_NAME = "mbox-message.eml"
ATTACHMENT_NAME = "message-attachment.dat"

# Tasks of a level per core at least: what is found is hashed for long, and a task more than there are cores is another round.
TASKS_PER_CORE = 3

_CARRY = ["job_id", "root_id", "file_id", "depth", "id_chain", "name", "mimetype", "checksum", "types", "recurse"]


def open_containers(files: DataFrame, openers: Openers | None = None, limits: Limits | None = None) -> DataFrame:
    """Open every container row once. Returns EXPANDED rows: children, parsed messages and errors, by ``record``.

    Containers with a file of their own are left to ``expand_all``.
    """
    openers, limits = openers or Openers(), (limits or Limits()).with_folder(files.sparkSession)
    by_type = openers.by_type
    schema = to_arrow_schema(StructType.fromDDL(EXPANDED))
    own = [f for f in schema if f.name not in _CARRY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = batch.column("types").to_pylist()
            mimetypes = batch.column("mimetype").to_pylist()
            contents = batch.column("content")
            origin: list[int] = []
            rows: list[dict] = []
            held = 0

            def cut() -> pa.RecordBatch:
                kept = [batch.column(c).take(pa.array(origin, pa.int32())) for c in _CARRY]
                new = [pa.array([row.get(f.name) for row in rows], f.type) for f in own]
                return pa.RecordBatch.from_arrays(
                    [c.cast(schema.field(n).type) for n, c in zip(_CARRY, kept)] + new, schema=schema
                )

            for i in range(batch.num_rows):
                found = opened(by_type[mimetypes[i]], mimetypes[i], contents[i].as_py() or b"", types[i] or [], limits)
                for row in found:
                    origin.append(i)
                    rows.append(row)
                    held += 200 + len(row.get("content") or b"")
                    if held >= limits.batch_bytes:
                        yield cut()
                        origin, rows, held = [], [], 0
            if rows:
                yield cut()

    containers = files.where(F.col("mimetype").isin(*by_type) & F.col("stored").isNull()).select(*_CARRY, "content")
    return containers.mapInArrow(run, EXPANDED)


def level_rows(expanded: DataFrame, openers: Openers | None = None) -> DataFrame:
    """LEVEL rows: the found files with their type, checksum and lineage, messages, and errors. Needs no shuffle.

    One narrow plan over the container job, so every container is opened and every mail parsed once.
    """
    by_type = (openers or Openers()).by_type
    raw, source, is_child = F.col("child_name"), F.col("mimetype"), F.col("record") == "child"
    entry = safe_name(raw)
    folder = is_child & (source == ZIP) & is_directory(raw) & entry.isNotNull()
    rows = expanded.where(~F.coalesce(folder, F.lit(False)))
    name = (
        F.when(source == MBOX, F.lit(MESSAGE_NAME))
        .when(source == MAIL, F.coalesce(raw, F.lit(ATTACHMENT_NAME)))
        .when(source == ZIP, entry)
        .otherwise(raw)
    )
    declared = F.nullif(format_content_type(F.col("ctype"), F.col("subtype")), F.lit(""))
    # An entry is identified by its bytes alone: unpacked files have no name of their own when they are looked at.
    found_type = F.when(source == MBOX, F.lit(MAIL)).otherwise(
        F.coalesce(declared, F.when(F.col("look").isNotNull(), looked_type(F.col("look"))), identify_or_default(F.col("content")))
    )
    rows = rows.withColumn("child", F.when(is_child, name))
    refused = is_child & F.col("child").isNull()
    rows = rows.withColumn("found", is_child & ~refused).withColumn("child_type", F.when(F.col("found"), found_type))
    # A checksum costs a whole buffer. What becomes of a row depends on that of an archive alone, so the others are in a column
    # of their own, which is left out for readers that ask for no checksum.
    archive, kind = F.col("child_type") == ZIP, F.col("child_type")
    rows = rows.withColumns(
        {
            "archive_sum": buffer_md5(F.when(archive, F.col("content"))),
            "other_sum": buffer_md5(F.when(~archive, identity_bytes(F.col("content"), kind))),
        }
    )
    archive_sum = F.coalesce(looked_checksum(F.col("look"), kind), F.col("archive_sum"))
    child_sum = F.coalesce(archive_sum, F.col("other_sum"))
    stored = F.struct("location", F.col("look.sha256").alias("sha256"), F.col("look.md5").alias("md5"))
    found, opens = F.col("found"), F.col("child_type").isin(*by_type) & F.col("recurse")
    above = F.concat(F.col("id_chain"), F.array("checksum"))
    circular = found & opens & archive & F.array_contains(above, archive_sum)
    opens = opens & ~F.coalesce(circular, F.lit(False))
    return rows.select(
        "job_id",
        "root_id",
        F.when(found, child_id(F.col("file_id"), F.col("ordinal"), F.col("child")))
        .otherwise(F.col("file_id"))
        .alias("file_id"),
        F.when(found, F.col("file_id")).alias("parent_id"),
        (F.col("depth") + found.cast("int")).alias("depth"),
        "ordinal",
        F.when(found, extend_chain(F.col("id_chain"), child_sum)).otherwise(F.col("id_chain")).alias("id_chain"),
        F.when(found, F.col("child")).otherwise(F.col("name")).alias("name"),
        F.when(found, F.col("child_type")).otherwise(source).alias("mimetype"),
        F.when(found, child_sum).otherwise(F.col("checksum")).alias("checksum"),
        F.coalesce(F.octet_length("content").cast("bigint"), F.col("look.length")).alias("length"),
        "types",
        "recurse",
        F.when(found, F.col("decoded")).alias("decoded"),
        F.when(found, F.col("content")).alias("content"),
        F.when(found & F.col("location").isNotNull(), stored).alias("stored"),
        "headers",
        "parts",
        F.when(refused, F.lit("unsafe_name")).when(circular, F.lit("circular")).otherwise(F.col("error_class")).alias("error_class"),
        F.when(refused, raw).when(circular, F.col("child")).otherwise(F.col("message")).alias("message"),
        F.when(refused, F.lit("error"))
        .when(found & opens, F.lit("container"))
        .when(found, F.lit("leaf"))
        .otherwise(F.col("record"))
        .alias("record"),
    ).withColumn(
        # An archive within itself is a file, and an error too.
        "record", F.explode(F.when(F.col("error_class") == "circular", F.array(F.lit("leaf"), F.lit("error"))).otherwise(F.array("record")))
    )


def files_of(level: DataFrame) -> DataFrame:
    """FILES rows of level rows."""
    return level.where(F.col("record").isin("container", "leaf")).select(*StructType.fromDDL(FILES).names)


def messages_of(level: DataFrame) -> DataFrame:
    """One row per parsed mail, with the lineage of its file."""
    return level.where("record = 'message'").select(*_CARRY, "headers", "parts")


def errors_of(level: DataFrame) -> DataFrame:
    """ERRORS rows of containers that could not be opened, entries that were refused, and nesting too deep."""
    return level.where("record = 'error'").select(
        "job_id",
        "root_id",
        "file_id",
        F.lit("expand").alias("stage"),
        F.lit("embedded").alias("process_type"),
        "error_class",
        "message",
    )


def expand_once(files: DataFrame, openers: Openers | None = None, limits: Limits | None = None) -> DataFrame:
    """LEVEL rows for the containers among some files."""
    return level_rows(open_containers(files, openers, limits), openers)


def expand_all(roots: DataFrame, openers: Openers | None = None, limits: Limits | None = None) -> DataFrame:
    """Open containers level by level until none is left. Returns the LEVEL rows of all levels."""
    return expand_levels(roots, openers, limits)[0]


def expand_levels(roots: DataFrame, openers: Openers | None = None, limits: Limits | None = None) -> tuple[DataFrame, bool]:
    """The LEVEL rows of all levels, and whether some file found has its content in a file of its own.

    Each level is written to the shared folder before the next one starts: finished work is not lost with an executor,
    and reading a level back splits its rows evenly by bytes, however they were spread over containers. Containers whose
    content is a file of its own are read by many tasks each. The driver sees three numbers per level.
    """
    spark = roots.sparkSession
    if "stored" not in roots.columns:
        roots = roots.withColumn("stored", F.lit(None).cast(STORED.split(" ", 1)[1]))
    openers, limits = openers or Openers(), (limits or Limits()).with_folder(spark)
    out = new_run_dir(spark, "levels")
    frontier, level, any_stored = roots, 0, False
    located = not roots.where("stored is not null").isEmpty()
    while True:
        inline = frontier
        if located:
            inline = frontier.where("stored is null").unionByName(with_values(opened_as_a_whole(frontier, openers)))
        rows = expand_once(inline, openers, limits)
        if located:
            rows = rows.unionByName(level_rows(located_members(frontier.where("stored is not null"), openers, limits), openers))
        if level == limits.max_depth:
            # Containers this deep are reported and not opened.
            too_deep = F.col("record") == "container"
            kinds = F.when(too_deep, F.array(F.lit("leaf"), F.lit("error"))).otherwise(F.array("record"))
            rows = rows.withColumns(
                {
                    "error_class": F.when(too_deep, F.lit("too_deep")).otherwise(F.col("error_class")),
                    "message": F.when(too_deep, F.col("name")).otherwise(F.col("message")),
                }
            ).withColumn("record", F.explode(kinds))
        with own_shuffles(spark):
            rows.write.partitionBy("record").options(**CONTENT_TABLE).parquet(f"{out}/level={level}")
        levels = spark.read.schema(LEVEL).option("basePath", out).parquet(out)
        this = levels.where(F.col("level") == level)
        is_container = F.col("record") == "container"
        found = this.where(F.col("record").isin("container", "leaf")).agg(
            F.count("stored.location").alias("stored"),
            F.count_if(is_container).alias("containers"),
            F.count_if(is_container & F.col("stored.location").isNotNull()).alias("located"),
        ).first()
        any_stored = any_stored or found.stored > 0
        if found.containers == 0:
            return levels, any_stored
        located = found.located > 0
        # Containers cost CPU time out of proportion to their bytes, so few splits are spread over all cores.
        frontier, level = spread(files_of(this.where(is_container)), "file_id", per_core=TASKS_PER_CORE), level + 1
