"""What the plans read, move and broadcast."""

import contextlib
import io
import re

import pytest
from conftest import make_zip, roots
from pyspark.sql import functions as F

from docsift.operators import dedupe
from docsift.operators.expand import errors_of, expand_all, expand_once, files_of, messages_of
from docsift.operators.extract import error_rows, process_files
from docsift.operators.skew import join_one_to_many
from docsift.plans import container_queries, stored_queries
from docsift.plans.process import as_roots, process_path
from docsift.session import spread, staged
from docsift.sinks.archive import write_archives
from docsift.sources.files import scan_files


def plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def shuffles(text):
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def read_columns(text):
    return " ".join(re.findall(r"ReadSchema: (.*)", text))


def some_roots(spark):
    return staged(roots(spark, [("r", "a.zip", make_zip([("x.txt", b"x"), ("in.zip", make_zip([("y", b"y")]))]))]))


def test_expansion_moves_nothing(spark):
    files = as_roots(some_roots(spark), ["embedded"])
    levels = expand_all(files)
    frontier = files_of(levels.where("level = 0 and record = 'container'"))
    text = plan(expand_once(frontier))
    assert shuffles(text) == 0 and "PartitionFilters" in text
    # The only exchange of the first level belongs to the lookup of types by name.
    assert "SortMergeJoin" not in plan(expand_once(files))


def test_each_table_reads_its_own_columns(spark):
    levels = expand_all(as_roots(some_roots(spark), ["embedded"]))
    assert "content" not in read_columns(plan(errors_of(levels)))
    assert "content" not in read_columns(plan(messages_of(levels).select("file_id", "headers")))
    assert "parts" not in read_columns(plan(messages_of(levels).select("file_id", "headers")))
    assert "headers" not in read_columns(plan(files_of(levels)))


def test_errors_and_routes_read_no_content(spark):
    levels = expand_all(as_roots(some_roots(spark), ["embedded"]))
    rows = process_files(files_of(levels), messages_of(levels))
    text = plan(error_rows(rows))
    assert "content" not in read_columns(text) and "SortMergeJoin" not in text and shuffles(text) == 0


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"a")
    text = plan(scan_files(spark, str(tmp_path)).where("length < 10").select("path", "length"))
    assert "content" not in read_columns(text) and "LessThan(length,10)" in text


def test_duplicates_move_no_content(spark):
    files = staged(as_roots(some_roots(spark), ["embedded"]))
    text = plan(dedupe.duplicate_groups(files))
    # Counts are merged before they are moved.
    assert "content" not in read_columns(text) and "partial_count" in text
    # Copies are taken out by a broadcast list of ids, so the files themselves stay where they are.
    text = plan(dedupe.keep_one(files))
    assert "BroadcastHashJoin LeftAnti" in text


def test_nothing_is_crossed_or_cut_in_joins_of_hot_keys(spark):
    many = spark.range(5000).select(F.col("id").cast("string").alias("row"), (F.col("id") % 3).alias("k"))
    one = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    text = plan(join_one_to_many(many, one, ["k"], "row", rows_per_slice=10))
    assert "TakeOrderedAndProject" not in text and "CartesianProduct" not in text and "NestedLoop" not in text and "Limit" not in text


def test_inputs_are_read_once(spark, tmp_path):
    """After the run no result table goes back to the files."""
    (tmp_path / "a.zip").write_bytes(make_zip([("x.txt", b"x")]))
    (tmp_path / "b.txt").write_bytes(b"text")
    result = process_path(spark, str(tmp_path))
    for table in ("files", "outputs", "errors", "messages", "metadata"):
        text = plan(getattr(result, table))
        assert "binaryFile" not in text and "MapInArrow" not in text
    assert "content" not in read_columns(plan(result.errors)) and "content" not in read_columns(plan(result.metadata))


def test_checksums_are_computed_for_those_who_read_them(spark):
    """Which rows are files takes no checksum but that of a nested archive, so counting and unpacking hash nothing else."""
    level = expand_once(as_roots(some_roots(spark), ["embedded"]))
    # One for the root, one for archives in it, and one for all else.
    assert plan(files_of(level).groupBy("root_id").agg(F.count("*"), F.sum("length"))).count("buffer_md5(") == 2
    assert plan(files_of(level)).count("buffer_md5(") == 3
    assert [r.name for r in files_of(level).orderBy("name").collect()] == ["in.zip", "x.txt"]
    # Who opens one level and wants no checksum does without that of the roots.
    level = expand_once(as_roots(some_roots(spark), ["embedded"], checksums=False))
    assert plan(files_of(level).select("name", "length")).count("buffer_md5(") == 1
    assert [r.name for r in files_of(level).orderBy("name").collect()] == ["in.zip", "x.txt"]


def test_levels_have_several_tasks_per_core(spark):
    """One task more than there are cores would be another round of long tasks."""
    cores = spark.sparkContext.defaultParallelism
    files = spark.range(100).selectExpr("cast(id as string) as file_id").coalesce(cores)
    assert spread(files, "file_id", per_core=3).rdd.getNumPartitions() == 3 * cores
    assert spread(files, "file_id").rdd.getNumPartitions() == cores


@pytest.mark.parametrize("module, name", [(container_queries, "archive_scan"), (stored_queries, "stored_inputs")])
def test_exports_read_written_outputs(spark, monkeypatch, module, name):
    """An export reads its outputs twice, so they are no plan that opens archives and hashes what is in them."""
    given = []
    monkeypatch.setattr(module, "write_archives", lambda outputs, path: given.append(outputs) or write_archives(outputs, path))
    assert getattr(module, name)(spark, "/root/testdata/sf0.001").count() > 0
    text = plan(given[0])
    assert "MapInArrow" not in text and "buffer_md5" not in text
