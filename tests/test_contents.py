"""Contents of any size: what a pass in pieces tells against native columns, archives by position, and runs with small limits."""

import io
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsift.functions.identity import dedupe_checksum
from docsift.functions.mime import identify_or_default
from docsift.functions.text import text_of
from docsift.operators.compare import content_diff
from docsift.operators.expand import Limits
from docsift.plans.process import process, process_jobs, process_path
from docsift.schemas import MAIL
from docsift.sinks.archive import write_archives
from docsift.sources import contents, large, zips
from docsift.sources.files import scan_files
from conftest import SMALL_MAIL, make_zip, roots
from test_expand import deep_mail, mailbox

HEADS = [b"", b"a", b"From: x\n", b"From: x\r\n", b"Subject: s\n", b"X-Long-Name-9: v\n", b"Bad Name: v\n", b" folded\n", b"\tfolded\n", b"\n", b"\r\n"]
IDS = [b"Message-ID: <a@b>\n", b"message-id:\n <c@d>\n", b"MESSAGE-ID: bare@id \r\n", b"Message-ID: two words\n", b"Message-Id: <x> (note)\n", b"Message-ID: <>\n"]
TEXTS = [b"<html>", b"  \n<!DOCTYPE   html>", b"<htmlx>", b"plain", "é".encode(), b"\xff\xfe\x41\x00", b"\xef\xbb\xbfx", b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b"\0", b"From x", b"PK\x03\x04", b"%PDF-1"]


def samples(n, seed):
    rng = random.Random(seed)
    out = [b"", b"x" * 1_000_000, b"y" * 1_000_001, b"Subject: a\nFrom: b\n" + b"Message-ID: <late@id>\n" + b"z" * 2_500_000]
    for _ in range(n):
        out.append(b"".join(rng.choice([*HEADS, *IDS, *TEXTS]) for _ in range(rng.randrange(7))))
    return out


def looked(data, step, is_mail=False):
    scanner = contents.Scanner(is_mail)
    for at in range(0, len(data), step):
        scanner.feed(data[at : at + step])
    return scanner.look()


def test_a_pass_in_pieces_tells_what_columns_tell(spark):
    data = samples(400, 1)
    rows = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, content binary")
    kind = identify_or_default(F.col("content"))
    want = rows.select("i", kind.alias("kind"), dedupe_checksum(F.col("content"), kind).alias("own"), dedupe_checksum(F.col("content"), F.lit(MAIL)).alias("mail"), F.md5("content").alias("md5"))
    looks = []
    for i, d in enumerate(data):
        for step in (1, 5, 10**7) if len(d) < 5000 else (999_999, 10**7):
            looks.append((i, tuple(looked(d, step).__dict__.values()), tuple(looked(d, step, True).__dict__.values())))
    schema = "length long, checksum string, mail_checksum string, magic string, plain boolean, sha256 string, md5 string"
    struct = f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"
    got = spark.createDataFrame(looks, f"i int, look {struct}, forced {struct}")
    kind = contents.looked_type(F.col("look"))
    got = got.select("i", kind.alias("kind"), contents.looked_checksum(F.col("look"), kind).alias("own"), contents.looked_checksum(F.col("forced"), F.lit(MAIL)).alias("mail"), F.col("look.md5").alias("md5"))
    wrong = got.exceptAll(want.join(got.select("i"), "i"))
    assert [(data[r.i][:200], r) for r in wrong.collect()] == []


@given(st.binary(max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_text_in_pieces(data, step):
    whole = "".join(contents.decoded_pieces([data] if data else []))
    assert "".join(contents.decoded_pieces(data[at : at + step] for at in range(0, len(data), step))) == whole


def test_text_in_pieces_is_the_column(spark):
    data = [d for d in samples(150, 2) if len(d) < 5000] + ["café € \U0001f600".encode("utf-16"), b"\xfe\xff\x00a\x00", b"a\xed\xa0\x80b\xf4\x90\x80\x80c\xc0\x80"]
    rows = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, content binary")
    for r in rows.select("i", text_of(F.col("content")).alias("text")).collect():
        assert "".join(contents.decoded_pieces([data[r.i]])) == r.text, data[r.i]


def archive_of(entries, comment=b"", before=b""):
    out = io.BytesIO(before)
    out.seek(len(before))
    with zipfile.ZipFile(out, "a" if before else "w") as archive:
        archive.comment = comment
        for name, data, kind, big in entries:
            info = zipfile.ZipInfo(name)
            info.compress_type = kind
            with archive.open(info, "w", force_zip64=big) as stream:
                stream.write(data)
    return out.getvalue()


KINDS = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)


@pytest.mark.parametrize("comment, before", [(b"", b""), (b"a comment", b""), (b"", b"#!/bin/sh\n" * 9), (b"c" * 60000, b"x")])
def test_archives_by_position(monkeypatch, comment, before):
    monkeypatch.setattr(zips, "READ_BYTES", 50)
    rng = random.Random(4)
    entries = [(f"d/{i}-é.txt", bytes(rng.choices(b"abcd", k=rng.randrange(900))), rng.choice(KINDS), rng.random() < 0.3) for i in range(60)]
    raw = archive_of([*entries, ("d/", b"", zipfile.ZIP_STORED, False)], comment, before)
    read = lambda at, size: raw[at : at + size]
    found = list(zips.entries(read, len(raw)))
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        infos = archive.infolist()
        assert [(e.name, e.size, e.compressed, e.offset) for e in found] == [(i.orig_filename, i.file_size, i.compress_size, i.header_offset) for i in infos]
    assert [b"".join(zips.content_of(read, e)) for e in found] == [d for _, d, *_ in entries] + [b""]
    assert [e.before for e in found] == [sum(i.compress_size for i in infos[:k]) for k in range(len(infos))]


@pytest.mark.parametrize("raw", [b"", b"PK", b"PK\x05\x06" + b"\xff" * 18, b"x" * 500, make_zip([("a", b"b" * 400)])[:-30]])
def test_damaged_directories(raw):
    with pytest.raises(zipfile.BadZipFile):
        list(zips.entries(lambda at, size: raw[max(at, 0) : max(at, 0) + size], len(raw)))


def inputs(folder):
    deep = make_zip([("box/in.mbox", mailbox(deep_mail(), SMALL_MAIL, b"N: 1\n\n" + b"long line " * 300)), ("note.txt", "grüße ".encode() * 400)])
    many = make_zip([(f"{i}.txt", b"%d " % i * (i % 40)) for i in range(300)] + [("inner.zip", deep), ("page.html", b"<html><p>Hi &amp; bye</p>" + b"<br>x" * 500)])
    (folder / "a.zip").write_bytes(make_zip([("d/", b""), ("../evil", b"x"), ("deep.zip", many), ("empty", b"")]))
    (folder / "b.mbox").write_bytes(mailbox(*[b"N: %d\n\n>From x" % i for i in range(40)], b"Subject: big\nFrom: a@b\n\n" + b"line\n" * 900))
    (folder / "c.txt").write_bytes("über ".encode() * 700)
    (folder / "d.eml").write_bytes(b"Received: x\n" + b" folded\n" * 300 + SMALL_MAIL + b"text\n" * 300)
    (folder / "e.bin").write_bytes(b"\xff\x00" * 900)
    (folder / "f.html").write_bytes(b"<!doctype html>" + b"<p>para</p>" * 200)
    (folder / "bad.zip").write_bytes(b"PK\x03\x04" + b"x" * 3000)


def contents_of(frame, text="content"):
    """Rows with their bytes, wherever they are."""
    out = []
    for r in frame.collect():
        row = r.asDict()
        stored = row.pop("stored")
        data = row.pop(text)
        other = {k: v for k, v in row.items() if k not in ("content", "text")}
        if stored is not None:
            data = b"".join(contents.read_pieces(stored.location))
            data = data.decode() if text == "text" else data
        out.append((str(sorted(other.items())), data if data is None or text == "text" else bytes(data)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [150, 5000])
def test_equal_results_on_both_sides_of_the_limit(spark, tmp_path, limit):
    """Inputs, entries, nested archives, mailboxes, mails and texts above the limit give what they give below it."""
    inputs(tmp_path)
    small = process_path(spark, str(tmp_path))
    large_ = process_path(spark, str(tmp_path), large_bytes=limit, limits=Limits(inline_bytes=limit))
    assert large_.files.where("stored is not null").count() > 3
    assert contents_of(small.files) == contents_of(large_.files)
    processed = "kind = 'processed'"
    assert contents_of(small.outputs.where(processed), "text") == contents_of(large_.outputs.where(processed), "text")
    assert contents_of(small.outputs.where(f"not {processed}")) == contents_of(large_.outputs.where(f"not {processed}"))
    plain = lambda frame: sorted(tuple(map(str, r)) for r in frame.collect())
    assert plain(small.errors) == plain(large_.errors)
    assert plain(small.messages) == plain(large_.messages) and plain(small.metadata) == plain(large_.metadata)
    assert content_diff(small.outputs.where(f"not {processed}"), large_.outputs.where(f"not {processed}")).count() == 0


def test_jobs_with_large_inputs(spark, tmp_path):
    inputs(tmp_path)
    rows = [(f"{job}-{p.name}", f"file:{p}", "out", None, ["all"], True) for p in sorted(tmp_path.iterdir()) for job in ("j", "k") if p.suffix in (".zip", ".eml", ".txt")]
    rows += [("typo", f"file:{tmp_path}/c.txt", "out", None, ["txt"], True), ("declared", f"file:{tmp_path}/d.eml", "out", "text/plain", ["text"], True)]
    jobs = spark.createDataFrame(rows, "job_id string, input_uri string, output_uri string, mimetype string, types array<string>, recurse boolean")
    scan = scan_files(spark, str(tmp_path))
    small, large_ = process_jobs(jobs, scan), process_jobs(jobs, scan, large_bytes=300, limits=Limits(inline_bytes=300))
    assert contents_of(small.files) == contents_of(large_.files)
    for where, text in (("kind = 'processed'", "text"), ("kind = 'embedded'", "content")):
        assert contents_of(small.outputs.where(where), text) == contents_of(large_.outputs.where(where), text)
    errors = lambda r: sorted((e.job_id, e.stage, e.error_class, e.message) for e in r.errors.collect())
    assert errors(small) == errors(large_)


def test_stored_contents_are_exported(spark, tmp_path):
    archive = make_zip([("big.txt", b"0123456789" * 500), ("small.txt", b"s")])
    result = process(roots(spark, [("r", "a.zip", archive)]), limits=Limits(inline_bytes=100))
    (row,) = write_archives(result.outputs, str(tmp_path / "out")).collect()
    with zipfile.ZipFile(row.path) as written:
        found = {n.rsplit("/", 1)[1]: written.read(n) for n in written.namelist() if not n.endswith((".json", "extracted.txt"))}
        texts = sorted(written.read(n) for n in written.namelist() if n.endswith("extracted.txt"))
    assert found == {"big.txt": b"0123456789" * 500, "small.txt": b"s"} and texts == [b"0123456789" * 500, b"s"]


def test_units_of_work_go_by_bytes(spark, tmp_path, monkeypatch):
    """Entries are read in as many partitions as their compressed bytes ask for, and a directory is read once."""
    rng = random.Random(8)
    entries = [(f"{i}", rng.randbytes(2000 if i % 10 else 40_000)) for i in range(100)]
    (tmp_path / "a.zip").write_bytes(archive_of([(n, d, zipfile.ZIP_STORED, False) for n, d in entries]))
    monkeypatch.setattr(large, "UNIT_BYTES", 50_000)
    monkeypatch.setattr(large, "ENTRY_COST", 0)
    archives = spark.createDataFrame([(str(tmp_path / "a.zip"),)], "path string")
    members = large.archive_members(archives).withColumn("part", F.spark_partition_id())
    rows = members.collect()
    assert {(r.child_name, bytes(r.content)) for r in rows} == set(entries)
    sizes = {}
    for r in rows:
        sizes[r.part] = sizes.get(r.part, 0) + len(r.content)
    assert len(sizes) >= 5 and members.rdd.getNumPartitions() >= 10


def test_texts_of_large_files_are_dealt_to_many_tasks(spark, tmp_path):
    """Rows that point to texts are narrow; each stands for a file, whose pass computes digests and nothing else."""
    texts = []
    for i in range(40):
        (tmp_path / f"{i}.txt").write_bytes(b"%d, " % i * 2000)
        texts.append((f"f{i}", (f"{tmp_path}/{i}.txt", None, None)))
    files = spark.createDataFrame(texts, "file_id string, stored struct<location:string,sha256:string,md5:string>").coalesce(1)
    found = large.located_texts(files, 100)
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    for row in found.collect():
        data = b"%d, " % int(row.file_id[1:]) * 2000
        look = looked(data, 1000)
        assert (row.bytes, row.kept.sha256, row.kept.md5) == (len(data), look.sha256, look.md5)
    kept = contents.kept_content([b"a" * 200], str(tmp_path), 100, digests_only=True)["look"]
    assert kept["checksum"] is None and kept["length"] == 200
