"""Queries on contents above the limit for values, with the limit at a few kilobytes, and on the order of outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators.compare import checksum_order
from docsift.operators.expand import Limits, expand_once, files_of
from docsift.operators.extract import embedded_outputs
from docsift.plans import fixtures
from docsift.plans.catalog import TURNS, buffer_md5_sql, query
from docsift.plans.container_queries import _DOC_TYPE, _TREE
from docsift.plans.process import as_roots, process, process_jobs
from docsift.session import new_run_dir, spread, staged
from docsift.sinks.archive import write_archives
from docsift.sources.files import scan_files

_PER = fixtures.ROWS_PER_CONTAINER

LIMIT = 4_000


def _md5() -> Column:
    """MD5 of an output's bytes, wherever they are."""
    return F.coalesce("stored.md5", F.md5("content")).alias("content_md5")


def _doc_id(name: str) -> Column:
    return F.regexp_extract(F.element_at(F.split(name, "/"), -1), "^([0-9]+)", 1).cast("bigint").alias("doc_id")


@query(_TREE + f"SELECT root_id, depth, name, mimetype, content_md5, archive_path, bytes > {LIMIT} AS is_stored FROM tree WHERE depth > 0")
def stored_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested archives, mailboxes, mails and attached files above the limit, each in a file of its own, to all depths."""
    nested = spread(fixtures.nested_zips(spark, sf_dir), "root_id")
    outputs = process(nested, types=["embedded"], limits=Limits(inline_bytes=LIMIT)).outputs
    depth = F.col("depth").cast("bigint").alias("depth")
    return outputs.select("root_id", depth, "name", "mimetype", _md5(), "archive_path", F.col("stored").isNotNull().alias("is_stored"))


@query(
    f"""
SELECT doc_id, doc_id || '.txt' AS name, md5(text) AS content_md5, CAST(strlen(text) AS BIGINT) AS length,
       strlen(text) > {LIMIT} AS is_stored
FROM documents"""
)
def stored_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs whose inputs are archives above the limit, used where they lie: entries by place, large ones as files."""
    zips = staged(fixtures.document_zips(spark, sf_dir, extra=False), "zips")
    path = new_run_dir(spark, "export")
    # Entries are named by their documents, so that no checksum is needed; written once, as the export reads outputs twice.
    level = expand_once(as_roots(zips, types=["embedded"], checksums=False))
    outputs = embedded_outputs(files_of(level)).withColumn("archive_path", F.col("name"))
    write_archives(staged(outputs.drop("checksum", "id_chain"), "outputs"), path)
    listed = scan_files(spark, f"{path}/archives", glob="*.zip")
    jobs = listed.select(
        F.col("path").alias("job_id"),
        F.col("path").alias("input_uri"),
        F.lit(None).cast("string").alias("mimetype"),
        F.array(F.lit("embedded")).alias("types"),
        F.lit(False).alias("recurse"),
    )
    outputs = process_jobs(jobs, listed, large_bytes=LIMIT, limits=Limits(inline_bytes=LIMIT)).outputs.where("depth = 1")
    return outputs.select(_doc_id("name"), "name", _md5(), "length", F.col("stored").isNotNull().alias("is_stored"))


@query(
    f"""
SELECT doc_id, md5(text) AS text_md5, CAST(strlen(text) AS BIGINT) AS length, strlen(text) > {LIMIT} AS is_stored
FROM documents WHERE {_DOC_TYPE} = 'text/plain' AND text <> ''"""
)
def stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents in archives, those above the limit read in pieces and kept as files."""
    zips = fixtures.document_zips(spark, sf_dir, extra=False)
    outputs = process(zips, types=["text", "embedded"], limits=Limits(inline_bytes=LIMIT)).outputs
    names = outputs.where("kind = 'embedded' and mimetype = 'text/plain'").select("file_id", _doc_id("name"))
    text = F.coalesce("stored.md5", F.md5(F.encode("text", "UTF-8"))).alias("text_md5")
    texts = outputs.where("process_type = 'text'").select("file_id", text, "length", F.col("stored").isNotNull().alias("is_stored"))
    return names.join(texts, "file_id").drop("file_id")


@query(
    TURNS
    + f""",
summed AS (SELECT doc_id // {_PER} AS bucket, md5(text) AS content_md5, {buffer_md5_sql("text")} AS checksum FROM documents, zeros)
SELECT bucket, row_number() OVER (PARTITION BY bucket ORDER BY checksum) AS place, checksum, content_md5 FROM summed"""
)
def output_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found in archives in the order of their checksums."""
    zips = fixtures.document_zips(spark, sf_dir, extra=False)
    found = checksum_order(process(zips, types=["embedded"], recurse=False).outputs)
    bucket = F.regexp_extract("root_id", "([0-9]+)$", 1).cast("bigint").alias("bucket")
    return found.select(bucket, "place", "checksum", _md5())
