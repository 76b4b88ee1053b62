"""Files as rows: plain scans, scans driven by a table of jobs, and mailboxes split inside one file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.uris import hadoop_uri, object_location
from docsift.operators.skew import join_to_small
from docsift.session import staged
from docsift.sources.contents import INLINE_BYTES
from docsift.stores import open_store


# Bytes of inputs that a task reads, one after the other, where there are many jobs.
TASK_BYTES = 256 << 20


def scan_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``path, modificationTime, length, content`` of every file below a path."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def plain_path(uri: Column) -> Column:
    """One spelling for local paths (``file:/x`` and ``file:///x`` are the same file)."""
    return F.regexp_replace(hadoop_uri(uri), "^file:/*", "file:/")


def scan_jobs(jobs: DataFrame, files: DataFrame, large_bytes: int = INLINE_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Root files of a table of jobs with their contents, those above a size without, and an error row for each input
    that cannot be read.

    ``files`` is a scan of the folders the inputs lie in, of which only the listing is used: the task that holds a job
    reads the job's file, and no other file is opened. A file that went away since it was listed is an error row. Those above
    the size are jobs like the others: who leaves them out has not read all inputs (see ``located_roots``).
    """
    jobs = jobs.withColumn("path", plain_path(F.col("input_uri")))
    is_object = F.col("input_uri").rlike("^s3[an]?:")
    bad_uri = is_object & object_location(F.regexp_replace("input_uri", "^s3[an]:", "s3:")).isNull()
    listed = files.select(plain_path(F.col("path")).alias("path"), "length")
    checked = jobs.withColumn("bad_uri", F.coalesce(bad_uri, F.lit(False))).join(listed, "path", "left")
    problem = F.when(F.col("bad_uri"), "S3UriParseError").when(F.col("length").isNull(), "not_found")
    checked = checked.withColumn("error_class", problem)
    named = F.element_at(F.split("path", "/"), -1).alias("name")
    known = checked.where("error_class is null")
    # Jobs are narrow rows; their contents come in after they are spread.
    known = staged(known.select("job_id", "path", "mimetype", "types", "recurse", "length"), "jobs")
    is_large = F.col("length") > large_bytes
    work = known.agg(F.count_if(~is_large).alias("small"), F.count_if(is_large).alias("large"), F.sum(F.when(~is_large, F.col("length"))).alias("bytes")).first()
    # The number is given, as a plan that goes by the rows' own few bytes would put all jobs into one task.
    cores = jobs.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(4 * cores, (work.bytes or 0) // TASK_BYTES), max(work.small, 1))
    good = known.where(~is_large).drop("length").repartitionByRange(tasks, "job_id", "path")
    big, asked = known.where(is_large), good.select("job_id", "path")
    if work.large:
        big = big.repartitionByRange(min(4 * cores, work.large), "job_id", "path")
        asked = asked.unionByName(big.select("job_id", "path"))
        big = with_files(big)
    large = big.select("job_id", F.col("job_id").alias("root_id"), named, "path", "length", "mimetype", "types", "recurse")
    gone = with_contents(asked, only_missing=True)
    gone = gone.select("job_id", F.lit("not_found").alias("error_class")).join(jobs.select("job_id", "input_uri"), "job_id")
    errors = checked.where("error_class is not null").select("job_id", "error_class", "input_uri")
    errors = errors.unionByName(gone).select(
        "job_id",
        F.col("job_id").alias("root_id"),
        F.lit(None).cast("string").alias("file_id"),
        F.lit("download").alias("stage"),
        F.lit(None).cast("string").alias("process_type"),
        "error_class",
        F.col("input_uri").alias("message"),
    )
    roots = with_contents(good).select(
        "job_id",
        F.col("job_id").alias("root_id"),
        named,
        "mimetype",
        "types",
        "recurse",
        "content",
    )
    return roots, large, errors


def with_contents(rows: DataFrame, only_missing: bool = False) -> DataFrame:
    """Rows with the ``content`` of the file at their ``path``, each read by the task that holds the row.

    Rows whose file is not there are left out, or with ``only_missing`` all others are, and nothing is read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column("path").to_pylist()):
                store, name = open_store(path)
                found = store.get_file_info(name).type == fs.FileType.File
                if found == only_missing:
                    continue
                content = None
                if found:
                    with store.open_input_file(name) as stream:
                        content = stream.read()
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([content], pa.binary())], names=[*row.schema.names, "content"])

    return rows.mapInArrow(read, T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())]))


def with_files(rows: DataFrame) -> DataFrame:
    """Rows whose file is there, by their ``path``."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stores = [open_store(path) for path in batch.column("path").to_pylist()]
            yield batch.filter(pa.array([store.get_file_info(name).type == fs.FileType.File for store, name in stores], pa.bool_()))

    return rows.mapInArrow(look, rows.schema)


def scan_mailboxes(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Messages of mailbox files, ``path, ordinal, content``, read in parallel within each file.

    Spark's text source cuts the files at the separator lines. The cut messages are written once to the shared folder;
    counts per input split then give every message its place in the file, whatever the size of the splits.
    """
    reader = spark.read.option("lineSep", "\nFrom ").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    pieces = reader.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").cast("binary").alias("piece"),
    )
    pieces = staged(pieces, "mailbox")

    # One row per input split, never per message, so the windows and the join below stay small and even.
    splits = pieces.groupBy("path", "split_start").agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    splits = splits.select(
        "path",
        "split_start",
        "first_row",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_ordinal"),
        F.sum("n").over(whole).alias("total"),
    )
    # A key is one split, so none is hot; the messages stay where they are while the splits are few enough to broadcast.
    placed = join_to_small(pieces, staged(splits, "splits"), ["path", "split_start"], "row").withColumn(
        "ordinal", F.col("first_ordinal") + F.col("row") - F.col("first_row")
    )
    # The first piece of a file still has its separator; text before a first separator belongs to no message.
    has_separator = F.startswith(F.col("piece"), F.lit(b"From "))
    placed = placed.where((F.col("ordinal") > 0) | has_separator)
    line = F.octet_length(F.substring_index(F.col("piece").cast("string"), "\n", 1))
    body = F.substring(F.col("piece"), line + F.lit(2), F.octet_length("piece"))
    body = F.when(F.col("ordinal") < F.col("total") - 1, F.concat(body, F.lit(b"\n"))).otherwise(body)
    return placed.select("path", "ordinal", unquote_separators(body).alias("content"))


def unquote_separators(message: Column) -> Column:
    """Take one ``>`` off every quoted separator line (``>From``, ``>>From``, ...). Byte-exact."""
    latin = F.decode(message, "ISO-8859-1")
    unquoted = F.encode(F.regexp_replace(latin, "(?dm)^>(>*From )", "$1"), "ISO-8859-1")
    return F.when(F.contains(message, F.lit(b">From ")), unquoted).otherwise(message)
