"""Queries on duplicates and on differences between two sets of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.identity import dedupe_checksum
from docsift.functions.text import escape_html
from docsift.operators import compare, dedupe
from docsift.plans import fixtures
from docsift.plans.catalog import query


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the root, the id is padded so that it sorts like the number."""
    content = F.encode("text", "UTF-8")
    docs = fixtures.spread_table(spark, sf_dir, "documents", "doc_id").select(
        F.col("source").alias("root_id"),
        F.lpad(F.col("doc_id").cast("string"), 19, "0").alias("file_id"),
        F.lit("text/plain").alias("mimetype"),
        (F.col("doc_id") % 3).alias("depth"),
        content.alias("content"),
    )
    return docs.withColumn("content_sha256", F.sha2("content", 256))


@query(
    """
WITH z AS (SELECT repeat(chr(0), 1000000) AS zeros)
SELECT doc_id, md5(text || left(zeros, 1000000 - strlen(text))) AS checksum, md5(text) AS content_md5 FROM documents, z"""
)
def dedupe_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe checksums of all documents."""
    files = _files(spark, sf_dir)
    return files.select(
        F.col("file_id").cast("bigint").alias("doc_id"),
        dedupe_checksum(F.col("content"), F.col("mimetype")).alias("checksum"),
        F.md5("content").alias("content_md5"),
    )


@query(
    """
SELECT md5(text) AS content_md5, count(*) AS n_files, min(doc_id) AS first_doc_id, count(DISTINCT source) AS n_roots
FROM documents GROUP BY text HAVING count(*) > 1"""
)
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    files = _files(spark, sf_dir)
    keyed = files.withColumn("checksum", F.md5("content")).drop("content")
    groups = dedupe.duplicate_groups(keyed)
    return groups.select(
        F.col("checksum").alias("content_md5"),
        "n_files",
        F.col("first_file_id").cast("bigint").alias("first_doc_id"),
        "n_roots",
    )


@query(
    """
SELECT doc_id, source AS root_id FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id % 3, doc_id) = 1"""
)
def keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of every group of equal ones: the least deep, then the first, by dedupe checksum."""
    files = _files(spark, sf_dir)
    summed = files.withColumn("checksum", dedupe_checksum(F.col("content"), F.col("mimetype"))).drop("content")
    kept = dedupe.keep_one(summed)
    return kept.select(F.col("file_id").cast("bigint").alias("doc_id"), "root_id")


@query(
    """
SELECT doc_id, md5(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS escaped_md5 FROM documents"""
)
def process_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work done once per distinct text, its result given to every copy; large groups are cut into slices."""
    work = lambda chosen: chosen.select(
        "file_id", F.md5(F.encode(escape_html(F.decode("content", "UTF-8")), "UTF-8")).alias("escaped_md5")
    )
    done = dedupe.process_distinct(_files(spark, sf_dir), work, rows_per_slice=8)
    return done.select(F.col("file_id").cast("bigint").alias("doc_id"), "escaped_md5")


@query(
    """
SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS expected, 'changed' AS actual FROM events WHERE event_id % 4 = 0
UNION ALL SELECT event_id, 'added', NULL, 'yes' FROM events WHERE event_id % 4 = 1
UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k'), NULL FROM events WHERE event_id % 4 = 2"""
)
def metadata_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata objects compared with altered ones: a changed value, an added key, a missing key, no change."""
    events = fixtures.table(spark, sf_dir, "events").select(F.col("event_id").alias("file_id"), F.col("props").alias("metadata"))
    kind = F.col("file_id") % 4
    altered = (
        F.when(kind == 0, F.lit('{"k": "changed"}'))
        .when(kind == 1, F.concat(F.regexp_replace("metadata", r"\}\s*$", ""), F.lit(', "added": "yes", "X-TIKA:Parsed-By": "p"}')))
        .when(kind == 2, F.lit("{}"))
        .otherwise(F.col("metadata"))
    )
    diff = compare.metadata_diff(events, events.withColumn("metadata", altered), ignore="^X-TIKA:")
    return diff.withColumnRenamed("file_id", "event_id")


@query(
    """
WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line, len(l) AS n
               FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
SELECT doc_id, line_no, line AS expected, line || '!' AS actual FROM lines WHERE doc_id % 5 = 0 AND line_no = 0
UNION ALL SELECT doc_id, n, NULL, 'one more line' FROM lines WHERE doc_id % 5 = 1 AND line_no = 0
UNION ALL SELECT doc_id, line_no, line, NULL FROM lines WHERE doc_id % 5 = 2"""
)
def line_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents compared line by line with altered ones: changed, longer and missing ones."""
    docs = fixtures.spread_table(spark, sf_dir, "documents", "doc_id").select(F.col("doc_id").alias("archive_path"), "text")
    kind = F.col("archive_path") % 5
    lines = F.split("text", "\n", -1)
    first = F.concat(F.get(lines, F.lit(0)), F.lit("!"))
    others = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    altered = (
        F.when(kind == 0, F.array_join(F.concat(F.array(first), others), "\n"))
        .when(kind == 1, F.concat("text", F.lit("\none more line")))
        .otherwise(F.col("text"))
    )
    actual = docs.where(kind != 2).withColumn("text", altered)
    diff = compare.line_diff(docs, actual, key=("archive_path",))
    return diff.select(F.col("archive_path").alias("doc_id"), F.col("line_no").cast("bigint").alias("line_no"), "expected", "actual")


@query(
    """
SELECT doc_id, doc_id % 3 = 1 AS is_missing FROM documents WHERE doc_id % 3 < 2"""
)
def content_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files compared byte by byte: changed and missing ones."""
    docs = fixtures.spread_table(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("archive_path"), F.encode("text", "UTF-8").alias("content")
    )
    kind = F.col("archive_path") % 3
    changed = F.when(kind == 0, F.concat("content", F.lit(b"\x00"))).otherwise(F.col("content"))
    diff = compare.content_diff(docs, docs.where(kind != 1).withColumn("content", changed), key=("archive_path",))
    return diff.select(F.col("archive_path").alias("doc_id"), F.col("actual_sha256").isNull().alias("is_missing"))


@query(
    """
SELECT doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY doc_id % 2, source, doc_id % 7 ORDER BY doc_id % 3 DESC, doc_id DESC) = 1"""
)
def last_write_two_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs write to the same paths of the same roots; neither overwrites the other."""
    docs = fixtures.table(spark, sf_dir, "documents")
    outputs = docs.select(
        F.concat(F.lit("j"), F.col("doc_id") % 2).alias("job_id"),
        F.col("source").alias("root_id"),
        F.concat(F.lit("p"), F.col("doc_id") % 7).alias("archive_path"),
        (F.col("doc_id") % 3).cast("int").alias("depth"),
        F.col("doc_id").alias("ordinal"),
        F.col("doc_id").cast("string").alias("file_id"),
        F.lit("text").alias("process_type"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return dedupe.last_write_wins(outputs).select(F.col("file_id").cast("bigint").alias("doc_id"))


@query("SELECT doc_id, 'altered' AS against FROM documents WHERE doc_id % 5 = 0")
def outputs_self_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of many roots under one path: no difference to themselves, the known ones to an altered copy."""
    docs = fixtures.spread_table(spark, sf_dir, "documents", "doc_id")
    outputs = docs.select(
        F.lit("j").alias("job_id"), F.col("doc_id").alias("root_id"), F.lit("extracted.txt").alias("archive_path"), "text"
    )
    altered = outputs.withColumn("text", F.when(F.col("root_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    differ = lambda other, name: compare.content_diff(outputs, other, column="text").select(
        F.col("root_id").alias("doc_id"), F.lit(name).alias("against")
    )
    return differ(altered, "altered").unionByName(differ(outputs, "self"))
