"""Queries on streams: files that land in a folder in steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.identity import dedupe_checksum
from docsift.plans import fixtures
from docsift.plans.catalog import query
from docsift.plans.container_queries import _TREE
from docsift.schemas import OUTPUTS
from docsift.session import CONTENT_TABLE, new_run_dir, staged
from docsift.streaming.landing import append_stream, expand_stream, landing_stream, read_results, unique_files, unique_stream

_ROOTS = "root_id string, name string, mimetype string, content binary"


def _land(roots: DataFrame, path: str, files: int) -> None:
    """So many files, which can be read in splits."""
    roots.repartition(files, "root_id").write.mode("append").options(**CONTENT_TABLE).parquet(path)


def _result(spark: SparkSession, out: str) -> DataFrame:
    return read_results(spark, out, "outputs").select(
        "root_id", F.col("depth").cast("bigint").alias("depth"), "name", "mimetype", F.md5("content").alias("content_md5")
    )


_EXPANDED = _TREE + "SELECT root_id, depth, name, mimetype, content_md5 FROM tree WHERE depth > 0"


@query(_EXPANDED)
def stream_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives landing as several files, expanded to all depths batch by batch."""
    run = new_run_dir(spark, "stream")
    _land(fixtures.nested_zips(spark, sf_dir), f"{run}/landing", 2)
    landing = landing_stream(spark, f"{run}/landing", _ROOTS, max_files=1, fmt="parquet")
    expand_stream(landing, f"{run}/out", f"{run}/checkpoint", types=["embedded"]).awaitTermination()
    return _result(spark, f"{run}/out")


@query(_EXPANDED)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream ends, more archives land, and a new stream goes on from the checkpoint: each archive once."""
    run = new_run_dir(spark, "stream")
    roots = staged(fixtures.nested_zips(spark, sf_dir), "roots")
    first = F.pmod(F.xxhash64("root_id"), F.lit(2)) == 0
    for part in (first, ~first):
        _land(roots.where(part), f"{run}/landing", 1)
        landing = landing_stream(spark, f"{run}/landing", _ROOTS, fmt="parquet")
        expand_stream(landing, f"{run}/out", f"{run}/checkpoint", types=["embedded"]).awaitTermination()
    return _result(spark, f"{run}/out")


@query("SELECT DISTINCT md5(text) AS content_md5 FROM documents")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landing as several files, the first of equal ones kept."""
    run = new_run_dir(spark, "stream")
    docs = fixtures.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("root_id"),
        F.encode("text", "UTF-8").alias("content"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") % 60).alias("modificationTime"),
    )
    _land(docs, f"{run}/landing", 3)
    schema = "root_id string, content binary, modificationTime timestamp"
    landed = landing_stream(spark, f"{run}/landing", schema, max_files=1, fmt="parquet")
    keyed = landed.select(
        "modificationTime",
        F.md5("content").alias("content_md5"),
        dedupe_checksum(F.col("content"), F.lit("text/plain")).alias("checksum"),
    )
    append_stream(unique_stream(keyed), f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/out").select("content_md5")


@query(_EXPANDED)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record that the last batch was committed gets lost: the batch runs again, and its rows are there once."""
    run = new_run_dir(spark, "stream")
    _land(fixtures.nested_zips(spark, sf_dir), f"{run}/landing", 2)
    landing = landing_stream(spark, f"{run}/landing", _ROOTS, max_files=1, fmt="parquet")
    expand_stream(landing, f"{run}/out", f"{run}/checkpoint", types=["embedded"]).awaitTermination()
    commits = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{run}/checkpoint/commits")
    store = commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    last = max((s.getPath() for s in store.listStatus(commits) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    store.delete(last, False)
    expand_stream(landing, f"{run}/out", f"{run}/checkpoint", types=["embedded"]).awaitTermination()
    return _result(spark, f"{run}/out")


@query(_EXPANDED)
def stream_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream takes the results on as they are written, and each row once, also after it was stopped."""
    run = new_run_dir(spark, "stream")
    roots = staged(fixtures.nested_zips(spark, sf_dir), "roots")
    first = F.pmod(F.xxhash64("root_id"), F.lit(2)) == 0
    for part in (first, ~first):
        _land(roots.where(part), f"{run}/landing", 1)
        landing = landing_stream(spark, f"{run}/landing", _ROOTS, fmt="parquet")
        expand_stream(landing, f"{run}/out", f"{run}/checkpoint", types=["embedded"]).awaitTermination()
        results = landing_stream(spark, f"{run}/out/outputs", f"{OUTPUTS}, batch_id int", fmt="parquet")
        append_stream(results, f"{run}/forwarded", f"{run}/forwarding").awaitTermination()
    forwarded = spark.read.parquet(f"{run}/forwarded")
    return forwarded.select("root_id", F.col("depth").cast("bigint").alias("depth"), "name", "mimetype", F.md5("content").alias("content_md5"))


@query(
    """
SELECT CAST(min(doc_id) AS VARCHAR) AS root_id, md5(text) AS content_md5, CAST(strlen(text) AS BIGINT) AS length
FROM documents GROUP BY text"""
)
def stream_unique_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their contents landing in two steps, the first of equal ones kept; a second stream goes on."""
    run = new_run_dir(spark, "stream")
    docs = fixtures.table(spark, sf_dir, "documents")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    first = F.col("doc_id") <= (low + high) // 2
    for part in (first, ~first):
        landed = docs.where(part).select(
            F.col("doc_id").cast("string").alias("root_id"),
            F.encode("text", "UTF-8").alias("content"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") / 1_000_000).alias("modificationTime"),
        )
        _land(landed, f"{run}/landing", 3)
        stream = landing_stream(spark, f"{run}/landing", "root_id string, content binary, modificationTime timestamp", fmt="parquet")
        checksum = dedupe_checksum(F.col("content"), F.lit("text/plain"))
        unique_files(stream, f"{run}/out", f"{run}/checkpoint", compute=checksum).awaitTermination()
    kept = read_results(spark, f"{run}/out", "files")
    return kept.select("root_id", F.md5("content").alias("content_md5"), F.octet_length("content").cast("bigint").alias("length"))
