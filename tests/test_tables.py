"""Duplicates, skewed joins, comparisons, sinks and streams."""

import io
import os
import time
import zipfile
from collections import defaultdict

import pytest
from conftest import make_zip, roots
from pyspark.sql import functions as F

from docsift import process
from docsift.operators import compare, dedupe
from docsift.operators.openers import Limits
from docsift.operators.skew import hot_keys, join_one_to_many, join_to_small, without
from docsift.plans import container_queries
from docsift.session import SHUFFLE_CLEANUP, new_run_dir, staged, temporary_runs
from docsift.sinks import archive
from docsift.sinks.archive import MOST_ROUNDS, directory_record, end_of_archive, publish, rounds_of, with_part, write_archives
from docsift.sinks.layout import write_layout
from docsift.sources import files, zips
from docsift.streaming.landing import append_stream, as_root_files, expand_stream, landing_stream, read_results, unique_files, unique_stream


def skewed_files(spark, n=600):
    """A third of all files are copies of one content."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("file_id"),
        F.concat(F.lit("root-"), F.col("id") % 7).alias("root_id"),
        (F.col("id") % 4).alias("depth"),
        key.alias("checksum"),
        key.alias("content_sha256"),
        F.lit("text/plain").alias("mimetype"),
    )


def groups_of(frame, key="checksum"):
    groups = defaultdict(list)
    for row in frame.collect():
        groups[row[key]].append(row)
    return groups


def test_duplicate_groups(spark):
    files = skewed_files(spark)
    expected = {
        (k, len(v), min(r.file_id for r in v), len({r.root_id for r in v})) for k, v in groups_of(files).items() if len(v) > 1
    }
    got = dedupe.duplicate_groups(files).select("checksum", "n_files", "first_file_id", "n_roots")
    assert {tuple(r) for r in got.collect()} == expected


def test_keep_one(spark):
    files = skewed_files(spark)
    expected = {min(v, key=lambda r: (r.depth, r.file_id)).file_id for v in groups_of(files).values()}
    assert sorted(r.file_id for r in dedupe.keep_one(files).collect()) == sorted(expected)


def test_process_distinct_works_once_per_content(spark):
    files = skewed_files(spark)
    seen = []

    def work(chosen):
        seen.append(chosen.count())
        return chosen.select("file_id", F.upper("content_sha256").alias("result"))

    got = dedupe.process_distinct(files, work, rows_per_slice=10).collect()
    assert seen == [len(groups_of(files))]
    assert sorted((r.file_id, r.result) for r in got) == sorted((r.file_id, r.checksum.upper()) for r in files.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sliced_join_equals_plain_join(spark, how):
    many = skewed_files(spark).select("file_id", F.when(F.col("file_id") == "000005", None).otherwise(F.col("checksum")).alias("k"))
    one = many.where("k <> 'k5'").select("k").distinct().withColumn("v", F.length("k"))
    got = join_one_to_many(many, one, ["k"], "file_id", how, rows_per_slice=5)
    assert sorted(map(str, got.collect())) == sorted(map(str, many.join(one, "k", how).collect()))


def test_all_hot_keys_are_listed(spark):
    counts = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") + 10).alias("n"))
    hot = hot_keys(counts, ["k"], 1000).collect()
    assert {r.k for r in hot} == set(range(991, 5000)) and {r.slices for r in hot if r.k == 4999} == {6}


def test_last_write_wins(spark):
    rows = [("r", "p", 1, 0, "a", "text"), ("r", "p", 2, 0, "b", "text"), ("r", "p", 2, 3, "c", "text"), ("r", "q", 0, 0, "d", "text"), ("s", "p", 0, 0, "e", "text")]
    rows = [("j1", *row) for row in rows] + [("j2", "r", "p", 0, 0, "f", "text")]
    frame = spark.createDataFrame(rows, "job_id string, root_id string, archive_path string, depth int, ordinal bigint, file_id string, process_type string")
    assert {r.file_id for r in dedupe.last_write_wins(frame).collect()} == {"c", "d", "e", "f"}


def test_metadata_diff(spark):
    expected = spark.createDataFrame([("a", '{"x":"1","y":["p","q"],"language":"en"}'), ("b", '{"x":"1"}'), ("c", '{"x":"1"}'), ("e", '{"v":"5"}')], "file_id string, metadata string")
    actual = spark.createDataFrame([("a", '{"x":"2","y":["p","q"],"z":"3"}'), ("b", '{"x":"1"}'), ("d", '{"w":"4"}'), ("e", "not json")], "file_id string, metadata string")
    got = {tuple(r) for r in compare.metadata_diff(expected, actual, ignore="^language$").collect()}
    assert got == {("a", "x", "1", "2"), ("a", "z", None, "3"), ("c", "x", "1", None), ("d", "w", None, "4"), ("e", "v", "5", None)}


def test_line_and_content_diff(spark):
    e = spark.createDataFrame([("a", "1\n2\n3"), ("b", "same"), ("c", "gone")], "archive_path string, text string")
    a = spark.createDataFrame([("a", "1\nX\n3\n4"), ("b", "same"), ("d", "new")], "archive_path string, text string")
    got = {tuple(r) for r in compare.line_diff(e, a, key=("archive_path",)).collect()}
    assert got == {("a", 1, "2", "X"), ("a", 3, None, "4"), ("c", 0, "gone", None), ("d", 0, None, "new")}
    assert {r.archive_path for r in compare.content_diff(e, a, key=("archive_path",), column="text").collect()} == {"a", "c", "d"}


def test_outputs_do_not_differ_from_themselves(spark):
    """Paths are unique within a root only."""
    outputs = expanded(spark).outputs.where("text is not null")
    assert compare.line_diff(outputs, outputs).count() == 0
    assert compare.content_diff(outputs, outputs, column="text").count() == 0
    altered = outputs.withColumn("text", F.when(F.col("root_id") == "small", F.lit("other")).otherwise(F.col("text")))
    assert {r.root_id for r in compare.line_diff(outputs, altered).collect()} == {"small"}


def test_two_jobs_on_one_root(spark, tmp_path):
    files = roots(spark, [("r", "a.zip", make_zip([("x.txt", b"x"), ("y.txt", b"y")]))])
    both = files.withColumn("job_id", F.explode(F.array(F.lit("j1"), F.lit("j2"))))
    outputs = process(both, ["embedded"]).outputs
    assert dedupe.last_write_wins(outputs).count() == outputs.count() == 4
    manifest = write_archives(outputs, str(tmp_path)).collect()
    assert sorted((m.job_id, m.root_id, m.n_entries) for m in manifest) == [("j1", "r", 2), ("j2", "r", 2)]
    assert len({m.path for m in manifest}) == 2


def expanded(spark):
    top = make_zip([(f"{i}.txt", b"%d" % i * 100) for i in range(40)])
    return process(roots(spark, [("big/1", "a.zip", top), ("small", "b.zip", make_zip([("x.txt", b"x")]))]), ["text", "embedded"])


def read_zip(path):
    with zipfile.ZipFile(path) as archive:
        return {n: archive.read(n) for n in archive.namelist()}


def test_archives(spark, tmp_path):
    outputs = expanded(spark).outputs
    expected = {(o.root_id, o.archive_path): bytes(o.content) if o.content is not None else o.text.encode() for o in outputs.collect()}
    manifest = write_archives(outputs, str(tmp_path / "whole")).collect()
    assert sorted((m.root_id, m.n_entries) for m in manifest) == [("big/1", 80), ("small", 2)]
    got = {(m.root_id, n): c for m in manifest for n, c in read_zip(m.path).items()}
    assert got == expected
    assert {m.root_id: m.bytes for m in manifest} == {
        r: sum(len(c) for (root, _), c in expected.items() if root == r) for r in ("big/1", "small")
    }
    assert not [p for p in (tmp_path / "whole" / "archives").iterdir() if p.name.startswith("_")]


def test_a_large_root_is_one_archive_of_many_segments(spark, tmp_path):
    """Deflated by many tasks and joined: the same entries as in an archive that one task wrote, under the same name."""
    outputs = expanded(spark).outputs
    whole = {m.root_id: m for m in write_archives(outputs, str(tmp_path / "whole")).collect()}
    manifest = write_archives(outputs, str(tmp_path / "out"), part_bytes=4000, part_entries=30)
    rows = {m.root_id: m for m in manifest.collect()}
    for root in ("big/1", "small"):
        a, b = whole[root], rows[root]
        assert (a.n_entries, a.bytes, a.path.split("/")[-1]) == (b.n_entries, b.bytes, b.path.split("/")[-1])
        assert read_zip(a.path) == read_zip(b.path)
        with zipfile.ZipFile(b.path) as archive:
            assert archive.testzip() is None
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["archives", "manifest"]
    jobs = spark.createDataFrame([("big/1", f"{tmp_path}/pub/big.zip"), ("small", f"file:{tmp_path}/pub/small.zip")], "job_id string, output_uri string")
    done = publish(manifest, jobs).collect()
    assert {d.root_id: d.uri for d in done} == {"big/1": f"{tmp_path}/pub/big.zip", "small": f"file:{tmp_path}/pub/small.zip"}
    assert read_zip(str(tmp_path / "pub" / "big.zip")) == read_zip(whole["big/1"].path)


def test_archives_are_the_same_in_any_number_of_rounds(spark, tmp_path, monkeypatch):
    """Byte by byte, whole archives and those of segments: names that are not ASCII, empty entries, and contents in files of their own."""
    entries = [("d/é.txt", "säge ".encode() * 99), ("empty.txt", b""), *((f"{i}.txt", b"%d " % i * 300) for i in range(9))]
    tops = [(f"r{i}", "a.zip", make_zip([(f"{i}-{n}", c) for n, c in entries])) for i in range(4)]
    outputs = process(roots(spark, tops), ["text", "embedded"], limits=Limits(inline_bytes=1_000)).outputs
    for part_bytes in (1 << 20, 3_000):
        found = []
        for rounds in (1, 3):
            monkeypatch.setattr(archive, "rounds_of", lambda tasks, cores, n=rounds: n)
            rows = write_archives(outputs, str(tmp_path / f"{part_bytes}-{rounds}"), part_bytes).collect()
            found.append({(r.root_id, r.n_entries, r.bytes): open(r.path, "rb").read() for r in rows})
        assert found[0] == found[1] and len(found[0]) == len(tops)
    assert [rounds_of(n, 4) for n in (1, 7, 8, 10_000)] == [1, 1, 2, MOST_ROUNDS]


# Takes what is written, and has no way back.
class Forward(io.RawIOBase):
    def __init__(self):
        self.data = bytearray()

    def writable(self):
        return True

    def write(self, data):
        self.data += bytes(data)
        return len(data)


def test_entries_deflated_early_are_as_zipfile_writes_them(spark, tmp_path):
    outputs = expanded(spark).outputs.where("root_id = 'big/1'")
    expected = {o.archive_path: bytes(o.content) if o.content is not None else o.text.encode() for o in outputs.collect()}
    (row,) = write_archives(outputs, str(tmp_path)).collect()
    stream = Forward()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as target:
        for name in sorted(expected):
            info = zipfile.ZipInfo(name, archive.ENTRY_TIME)
            info.compress_type = zipfile.ZIP_DEFLATED
            with target.open(info, "w") as entry:
                entry.write(expected[name])
    with open(row.path, "rb") as written_file:
        assert written_file.read() == bytes(stream.data)


def test_exported_contents_move_deflated(spark, tmp_path):
    """What a shuffle holds is as small as the archive."""
    one = make_zip([("x.txt", b"the same again " * 100_000)])
    outputs = staged(process(roots(spark, [("r", "b.zip", one)]), ["embedded"]).outputs)
    moved = []
    real = archive.dealt
    archive.dealt = lambda rows, *a: moved.append(rows) or real(rows, *a)
    try:
        write_archives(outputs, str(tmp_path))
    finally:
        archive.dealt = real
    assert "data" in moved[0].columns
    assert 0 < moved[0].agg(F.sum(F.octet_length("data"))).first()[0] < 20_000


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return sum(name.startswith("shuffle_") for top in folders for _, _, names in os.walk(top.getPath()) for name in names)


def test_a_written_table_leaves_no_shuffle(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = spark.range(1000).repartition(3, "id")
    table = staged(rows)
    # Files are deleted by the executors, a moment later.
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert table.count() == rows.count() == len(rows.collect()) == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_archives_below_a_folder_named_by_a_uri(spark, tmp_path):
    """Names with characters that are escaped in them."""
    outputs = process(roots(spark, [("a/b c%2f", "b.zip", make_zip([("x.txt", b"x")]))]), ["embedded"]).outputs
    for i, start in enumerate(("", "file:", "file://")):
        manifest = write_archives(outputs, f"{start}{tmp_path}/{i}")
        jobs = spark.createDataFrame([("a/b c%2f", f"{start}{tmp_path}/{i}/a%20b/c.zip")], "job_id string, output_uri string")
        (done,) = publish(manifest, jobs).collect()
        assert list(read_zip(str(tmp_path / str(i) / "a%20b" / "c.zip")).values()) == [b"x"]
        assert done.bytes == os.path.getsize(tmp_path / str(i) / "a%20b" / "c.zip")


def test_published_jobs_leave_only_archives(spark, tmp_path):
    """Tables of contents that the jobs went through are deleted, and rows are the same however often they are read."""
    docs = spark.createDataFrame([(i, "web", f"text {i} " * 40) for i in range(130)], "doc_id long, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shared = os.path.join(spark.conf.get("spark.checkpoint.dir"), "docsift")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    published = container_queries.publish_jobs(spark, str(tmp_path))
    rows = sorted((r.uri, r.n_entries, r.bytes) for r in published.collect())
    assert [r[:2] for r in rows] == [(f"docs-{b}/{j}", n) for b, n in ((0, 64), (1, 64), (2, 2)) for j in "ab"]
    assert sum(r[2] for r in rows) == 2 * sum(len(f"text {i} " * 40) for i in range(130))
    assert {f.rsplit("-", 1)[0] for f in set(os.listdir(shared)) - before} <= {"export", "published", "directories"}
    assert sorted((r.uri, r.n_entries, r.bytes) for r in published.collect()) == rows


def test_directories_beyond_32_bits(tmp_path):
    """Records of an archive of over 4 GiB, most of it a hole in the file, as other readers take them."""
    name, data, at = "déjà/vu.txt", b"far away " * 50, 5 << 30
    local = io.BytesIO()
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(name, data)
        (info,) = archive.infolist()
        end = archive.start_dir
    record = directory_record(name, info.CRC, info.compress_size, info.file_size, at)
    huge = directory_record("huge", 1, 6 << 30, 7 << 30, 0)
    path = tmp_path / "far.zip"
    with open(path, "wb") as out:
        out.seek(at)
        out.write(local.getvalue()[:end] + huge + record + end_of_archive(2, len(huge) + len(record), at + end))
    with zipfile.ZipFile(path) as archive:
        assert archive.read(name) == data
        assert [(i.file_size, i.compress_size, i.header_offset) for i in archive.infolist()] == [(7 << 30, 6 << 30, 0), (len(data), info.compress_size, at)]
    size = path.stat().st_size
    with open(path, "rb") as raw:
        def read(start, n):
            raw.seek(start)
            return raw.read(n)

        found = list(zips.entries(read, size))
        assert [(e.size, e.compressed, e.offset) for e in found] == [(7 << 30, 6 << 30, 0), (len(data), info.compress_size, at)]
        assert b"".join(zips.content_of(read, found[1])) == data
    many = end_of_archive(70_000, 10, 20)
    assert many.startswith(b"PK\x06\x06") and len(end_of_archive(5, 10, 20)) == 22


def test_unsafe_output_names_stay_inside(spark, tmp_path):
    mail = (
        b"Content-Type: multipart/mixed; boundary=b\n\n--b\nContent-Type: text/plain\n"
        b"Content-Disposition: attachment; filename=\"../../x.txt\"\n\nhi\n--b--\n"
    )
    outputs = process(roots(spark, [("r", "m.eml", mail)]), ["embedded"]).outputs
    (row,) = write_archives(outputs, str(tmp_path)).collect()
    (name,) = read_zip(row.path)
    assert ".." not in name and name.endswith("/x.txt")


def test_layout(spark, tmp_path):
    outputs = expanded(spark).outputs
    write_layout(outputs, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("job_id", "process_type").count().count() == 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == outputs.count()


def test_layout_has_few_folders_however_many_jobs(spark, tmp_path):
    outputs = expanded(spark).outputs
    many = outputs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).withColumn("job_id", F.concat_ws("/", "job_id", "copy")).drop("copy")
    write_layout(many, str(tmp_path / "t"))
    assert len([d for d in os.listdir(tmp_path / "t") if "=" in d]) == outputs.select("process_type").distinct().count()
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert set(rows.columns) == set(outputs.columns) and rows.count() == 50 * outputs.count()
    one = many.select("job_id").first()[0]
    assert rows.where(F.col("job_id") == one).count() == many.where(F.col("job_id") == one).count()


def test_part_numbers_stay_below_their_count(spark):
    frame = spark.createDataFrame([("r", f"p{i}", 10) for i in range(100)], "root_id string, archive_path string, length bigint").withColumn("job_id", F.lit("j"))
    rows, tasks = with_part(frame, 250)
    assert {r.part for r in rows.collect()} == {0, 1, 2, 3} and tasks >= 4
    assert {r.part for r in with_part(frame, 10_000, part_entries=50)[0].collect()} == {0, 1}


def stream_out(spark, out):
    return sorted((o.root_id.rsplit("/", 1)[1], o.name) for o in read_results(spark, str(out), "outputs").collect())


def test_stream_resumes_and_replays(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "landing", tmp_path / "out", tmp_path / "checkpoint"
    landing.mkdir()

    def run():
        files = as_root_files(landing_stream(spark, str(landing), max_files=1))
        query = expand_stream(files, str(out), str(checkpoint), ["embedded"])
        query.awaitTermination()
        return query

    (landing / "a.zip").write_bytes(make_zip([("1.txt", b"1"), ("in.zip", make_zip([("2.txt", b"2")]))]))
    (landing / "b.zip").write_bytes(make_zip([("3.txt", b"3")]))
    run()
    first = [("a.zip", "1.txt"), ("a.zip", "2.txt"), ("a.zip", "in.zip"), ("b.zip", "3.txt")]
    assert stream_out(spark, out) == first
    assert len(list((out / "outputs").glob("batch_id=*"))) == 2
    # Nothing new: nothing is done again.
    run()
    assert stream_out(spark, out) == first
    # A batch whose commit was lost is run again and replaces its own folder.
    (checkpoint / "commits" / "1").unlink()
    for crc in (checkpoint / "commits").glob(".1.crc"):
        crc.unlink()
    run()
    assert stream_out(spark, out) == first
    (landing / "c.zip").write_bytes(make_zip([("4.txt", b"4")]))
    run()
    assert stream_out(spark, out) == first + [("c.zip", "4.txt")]


def test_objects_are_published_once(spark, tmp_path):
    """Reading what was published copies nothing again."""
    manifest = write_archives(process(roots(spark, [("r", "b.zip", make_zip([("x.txt", b"x")]))]), ["embedded"]).outputs, str(tmp_path / "out"))
    uri = f"{tmp_path}/published/r"
    published = publish(manifest, spark.createDataFrame([("r", uri)], "job_id string, output_uri string"))
    os.utime(uri, (1, 1))
    assert [r.uri for r in published.collect()] == [r.uri for r in published.collect()] == [uri]
    assert os.path.getmtime(uri) == 1


def test_a_batch_of_one_file_is_spread(spark, tmp_path):
    """The roots of a small file are hashed and unpacked by all cores."""
    rows = roots(spark, [(f"r{i}", f"{i}.zip", make_zip([("x.txt", b"%d" % i)])) for i in range(40)])
    rows.coalesce(1).write.parquet(str(tmp_path / "landing"))
    seen = []

    def run(batch, **options):
        seen.append(batch.rdd.getNumPartitions())
        return process(batch, **options)

    files = landing_stream(spark, str(tmp_path / "landing"), "root_id string, name string, content binary", fmt="parquet")
    expand_stream(files, str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["embedded"], run).awaitTermination()
    assert len(seen) == 1 and seen[0] >= spark.sparkContext.defaultParallelism
    assert read_results(spark, str(tmp_path / "out"), "outputs").count() == 40


def test_results_feed_another_stream(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    landing.mkdir()
    (landing / "a.zip").write_bytes(make_zip([(f"{i}.txt", b"same" if i % 2 else b"%d" % i) for i in range(10)]))
    files = as_root_files(landing_stream(spark, str(landing)))
    expand_stream(files, str(out), str(tmp_path / "c1"), ["embedded"]).awaitTermination()
    schema = read_results(spark, str(out), "files").schema
    found = spark.readStream.schema(schema).parquet(f"{out}/files").where("depth > 0")
    timed = found.withColumn("modificationTime", F.lit("2024-01-01").cast("timestamp"))
    append_stream(unique_stream(timed.select("modificationTime", "checksum")), str(tmp_path / "unique"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "unique")).count() == 6


def test_zip_file_is_readable_by_others(spark, tmp_path):
    (row,) = write_archives(process(roots(spark, [("r", "b.zip", make_zip([("x.txt", b"x")]))]), ["embedded"]).outputs, str(tmp_path)).collect()
    with open(row.path, "rb") as f:
        assert zipfile.ZipFile(io.BytesIO(f.read())).testzip() is None


def test_joins_beyond_the_broadcast_limit_give_the_same(spark):
    many = skewed_files(spark)
    one = many.select("checksum").distinct().withColumn("v", F.length("checksum"))
    plain = sorted(map(str, many.join(one, "checksum").collect()))
    for limit in (0, 10**6):
        assert sorted(map(str, join_to_small(many, one, ["checksum"], "file_id", max_rows=limit).collect())) == plain
        left = without(many, many.where("depth = 1").select("file_id"), ["file_id"], max_rows=limit)
        assert left.count() == 450 and left.where("depth = 1").count() == 0


def test_jobs_read_only_the_files_they_name(spark, tmp_path):
    for name in ("hot", "cold", "unnamed", "gone"):
        (tmp_path / f"{name}.txt").write_bytes(name.encode())
    names = [("hot" if i % 3 else "cold", i) for i in range(60)] + [("gone", 60)]
    jobs = spark.createDataFrame(
        [(f"j{i}", f"file:{tmp_path}/{n}.txt", None, None, ["text"], False) for n, i in names],
        "job_id string, input_uri string, output_uri string, mimetype string, types array<string>, recurse boolean",
    )
    listed = files.scan_files(spark, str(tmp_path)).select("path", "length").collect()
    listing = spark.createDataFrame([(r.path, r.length) for r in listed], "path string, length long")
    # Both are listed and then go away; only the one that a job names is missed.
    (tmp_path / "unnamed.txt").unlink()
    (tmp_path / "gone.txt").unlink()
    found, _, errors = files.scan_jobs(jobs, listing)
    assert sorted((r.job_id, bytes(r.content)) for r in found.collect()) == sorted((f"j{i}", n.encode()) for n, i in names[:-1])
    assert [(e.job_id, e.error_class) for e in errors.collect()] == [("j60", "not_found")]


def test_temporary_runs_leave_nothing(spark):
    with temporary_runs(spark):
        outer = new_run_dir(spark, "outer")
        spark.range(3).write.parquet(outer)
        with temporary_runs(spark):
            inner = new_run_dir(spark, "inner")
            spark.range(3).write.parquet(inner)
        assert os.path.isdir(outer) and not os.path.exists(inner)
    assert not os.path.exists(outer)
    kept = new_run_dir(spark, "kept")
    spark.range(3).write.parquet(kept)
    assert os.path.isdir(kept)


def test_unique_files_compute_each_key_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(content):
        seen.add(1)
        return content.decode()[:1] if content else None

    schema = "root_id string, content binary, modificationTime timestamp"
    rows = [(f"r{i}", bytearray(b"%d" % (i % 7)), 100.0 + i) for i in range(40)] + [("null", None, 1.0), ("late", bytearray(b"9"), None)]
    frame = spark.createDataFrame(rows, "root_id string, content binary, s double").withColumn("modificationTime", F.timestamp_seconds("s")).drop("s")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = landing_stream(spark, str(tmp_path / "in"), schema, fmt="parquet")
    unique_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), compute=slow(F.col("content"))).awaitTermination()
    kept = read_results(spark, str(tmp_path / "out"), "files").collect()
    assert sorted(r.root_id for r in kept) == sorted([*(f"r{i}" for i in range(7)), "null", "late"])
    assert {r.root_id: r.checksum for r in kept}["r3"] == "3" and seen.value == len(rows)


def test_large_inputs_of_jobs_are_read_or_missed_like_others(spark, tmp_path):
    for name in ("here", "gone"):
        (tmp_path / f"{name}.txt").write_bytes(name.encode())
    listed = files.scan_files(spark, str(tmp_path)).select("path", "length").collect()
    listing = spark.createDataFrame([(r.path, r.length) for r in listed], "path string, length long")
    jobs = listing.select(F.col("path").alias("job_id"), F.col("path").alias("input_uri"), F.lit("text/plain").alias("mimetype"), F.array(F.lit("text")).alias("types"), F.lit(False).alias("recurse"))
    (tmp_path / "gone.txt").unlink()
    for limit in (0, 100):
        small, large, errors = files.scan_jobs(jobs, listing, limit)
        (small_there, large_there) = ([r.name for r in t.collect()] for t in (small, large))
        assert (small_there, large_there) == (([], ["here.txt"]) if limit == 0 else (["here.txt"], []))
        assert [(e.job_id.split("/")[-1], e.error_class) for e in errors.collect()] == [("gone.txt", "not_found")]


@pytest.mark.parametrize("input_bytes, message_bytes", [(0, 256_000_000), (0, 400), (1_500, 400)])
def test_jobs_of_files_read_inputs_of_any_size(spark, tmp_path, monkeypatch, input_bytes, message_bytes):
    """The messages are the same whether inputs, and messages in them, are above the limits or below."""
    rows = [(c, t, "user", f"line of {c}\nFrom {t}\n" * (1 + 20 * c)) for c in range(4) for t in range(5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns.repartitionByRange(4, "conv_id").write.parquet(str(tmp_path / "conversations.parquet"))
    read = lambda: sorted(map(repr, container_queries.scan_jobs_of_files(spark, str(tmp_path)).collect()))
    expected = read()
    assert len(expected) == len(rows) + 2
    monkeypatch.setattr(files.scan_jobs, "__defaults__", (input_bytes,))
    monkeypatch.setattr(Limits.__init__, "__defaults__", (message_bytes, *Limits.__init__.__defaults__[1:]))
    assert read() == expected


def test_jobs_are_dealt_to_many_tasks(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    listing = files.scan_files(spark, str(tmp_path))
    jobs = listing.select(F.col("path").alias("job_id"), F.col("path").alias("input_uri"), F.lit("text/plain").alias("mimetype"), F.array(F.lit("text")).alias("types"), F.lit(False).alias("recurse"))
    found, _, errors = files.scan_jobs(jobs, listing)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert found.count() == 6 and errors.isEmpty()


def test_unique_files(spark, tmp_path):
    """The first of each key and hour, over batches, with a hot key, copies in later hours, rows without a key, and a replay."""
    schema = "root_id string, content binary, modificationTime timestamp, checksum string"

    def land(rows, step):
        frame = spark.createDataFrame([(r, bytearray(r.encode()), key, at) for r, key, at in rows], "root_id string, content binary, checksum string, s double")
        frame.select("root_id", "content", F.timestamp_seconds("s").alias("modificationTime"), "checksum").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = landing_stream(spark, str(tmp_path / "in"), schema, fmt="parquet")
        unique_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), span="1 hour").awaitTermination()
        return sorted(r.root_id for r in read_results(spark, str(tmp_path / "out"), "files").collect())

    hour = 3600.0
    assert land([(f"a{i}", "hot", 100.0 - i) for i in range(50)] + [("b", "cold", 0.0), ("c", None, 0.0), ("d", None, 0.0)], 0) == ["a49", "b", "c", "d"]
    assert land([("e", "hot", hour), ("f", "cold", 2 * hour), ("g", "new", hour), ("h", "new", hour), ("x", "hot", 60.0)], 1) == ["a49", "b", "c", "d", "e", "f", "g"]
    assert land([("i", "cold", 2.5 * hour), ("j", "hot", 9 * hour)], 2) == ["a49", "b", "c", "d", "e", "f", "g", "j"]
    (tmp_path / "checkpoint" / "commits" / "2").unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert land([("k", "hot", 9.5 * hour)], 3) == ["a49", "b", "c", "d", "e", "f", "g", "j"]
