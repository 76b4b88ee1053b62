"""Containers, recursion and whole runs."""

import io
import zipfile

import pandas as pd
import pytest
from conftest import SMALL_MAIL, make_zip, roots
from pyspark.sql import functions as F

from docsift import process, process_jobs, process_path
from docsift.operators.expand import Limits, Openers, expand_once, files_of
from docsift.operators.extract import Extractor
from docsift.operators.lineage import ancestors, total_count, with_parent
from docsift.plans.process import as_roots
from docsift.sources import large
from docsift.sources.files import scan_files, scan_mailboxes

ATTACHED = (
    b"Message-ID: <outer@x>\nContent-Type: multipart/mixed; boundary=b\n\n--b\nContent-Type: text/plain\n\nhello\n--b\n"
    b"Content-Type: Application/Zip\nContent-Disposition: attachment; filename=\"in.zip\"\nContent-Transfer-Encoding: base64\n\n"
)


def deep_mail():
    import base64

    return ATTACHED + base64.encodebytes(make_zip([("x.txt", b"deep"), ("y.eml", SMALL_MAIL)])) + b"--b--\n"


def mailbox(*messages):
    return b"".join(b"From a@b Mon Jan  1 00:00:00 2024\n" + m + b"\n" for m in messages)


def split_mailbox(content):
    """Brute force: line by line."""
    messages = None
    for line in content.splitlines(keepends=True) if b"\r" not in content else content.split(b"\n"):
        if line.startswith(b"From "):
            messages = (messages or []) + [b""]
        elif messages is not None:
            bare = line.lstrip(b">")
            messages[-1] += line[1:] if bare.startswith(b"From ") and line != bare else line
    return messages or []


def found(frame):
    return {(r.name, r.mimetype, bytes(r.content)) for r in frame.collect()}


def test_zip_entries(spark):
    archive = make_zip([("d/", b""), ("d/a.txt", b"one"), ("../evil", b"x"), ("/abs", b"x"), ("b", b"\x00\xff"), ("e.eml", SMALL_MAIL)])
    level = expand_once(as_roots(roots(spark, [("r", "a.zip", archive)]), ["embedded"]))
    assert found(files_of(level)) == {
        ("a.txt", "text/plain", b"one"),
        ("b", "application/octet-stream", b"\x00\xff"),
        ("e.eml", "message/rfc822", SMALL_MAIL),
    }
    errors = {(r.error_class, r.message) for r in level.where("record = 'error'").collect()}
    assert errors == {("unsafe_name", "../evil"), ("unsafe_name", "/abs")}


def test_mailbox_messages(spark):
    content = b"preamble\n" + mailbox(b"A: 1\n\n>From here\n>>From there\n> From not", SMALL_MAIL, b"", b"\xff\xfe\x85\n")
    rows = [("r", "m", content, "application/mbox")]
    files = files_of(expand_once(as_roots(roots(spark, rows, "root_id string, name string, content binary, mimetype string"), ["embedded"])))
    got = [bytes(r.content) for r in files.orderBy("ordinal").collect()]
    assert got == split_mailbox(content)
    assert got[0] == b"A: 1\n\nFrom here\n>From there\n> From not\n"


@pytest.mark.parametrize("split_bytes", [64, 1000, 1 << 20])
def test_mailbox_scan_does_not_depend_on_splits(spark, tmp_path, split_bytes):
    boxes = {
        "one.mbox": mailbox(*[b"N: %d\n\n" % i + b"line \xff\n" * (i % 5) + b">From x\n" for i in range(40)]),
        "two.mbox": b"no separator at first\n" + mailbox(b"A: b\n\nc", b"D: e\n\nf").rstrip(b"\n"),
        "long.mbox": mailbox(b"A: long\n\n" + b"x" * 5000 + b"\n", b"B: short\n\n", b""),
        "none.mbox": b"not a mailbox\n",
    }
    for name, content in boxes.items():
        (tmp_path / name).write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = scan_mailboxes(spark, str(tmp_path), glob="*.mbox").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, content in boxes.items():
        got = [bytes(r.content) for r in sorted(rows, key=lambda r: r.ordinal) if r.path.endswith(name)]
        assert got == split_mailbox(content), name


def test_all_depths(spark):
    archive = make_zip([("box.mbox", mailbox(deep_mail(), SMALL_MAIL))])
    result = process(roots(spark, [("r", "top.zip", archive)]))
    files = result.files.cache()
    rows = {r.file_id: r for r in files.collect()}
    assert sorted((r.depth, r.name) for r in rows.values()) == [
        (0, "top.zip"), (1, "box.mbox"), (2, "mbox-message.eml"), (2, "mbox-message.eml"), (3, "in.zip"), (4, "x.txt"), (4, "y.eml"),
    ]
    for row in rows.values():
        assert len(row.id_chain) == row.depth
        if row.depth:
            parent = rows[row.parent_id]
            assert row.id_chain == parent.id_chain + [row.checksum] and row.depth == parent.depth + 1
    assert {(r.name, r.parent_name) for r in with_parent(files).collect()} == {
        ("box.mbox", "top.zip"), ("mbox-message.eml", "box.mbox"), ("in.zip", "mbox-message.eml"), ("x.txt", "in.zip"), ("y.eml", "in.zip"),
    }
    assert ancestors(files).count() == sum(r.depth for r in rows.values())
    assert [tuple(r) for r in total_count(files).collect()] == [("r", "r", 7)]

    outputs = result.outputs.collect()
    assert {o.archive_path for o in outputs if o.kind == "embedded"} == {
        "/".join([*r.id_chain, r.name]) for r in rows.values() if r.depth
    }
    # Every routed pair is either an output or an error.
    processed = sorted((o.depth, o.process_type) for o in outputs if o.kind == "processed")
    assert processed == sorted(
        [(0, "metadata"), (1, "metadata"), (3, "metadata"), (4, "metadata"), (4, "text")]
        + [(2, t) for t in ("text", "metadata", "pdf")] * 2
        + [(4, t) for t in ("text", "metadata", "pdf")]
    )
    assert {o.text for o in outputs if o.process_type == "text" and o.depth == 4} == {"deep", "Zwei Kräne & ein Boot\nfehlen = 3 < 4\n\n\n"}
    # A processed output carries the checksum of its source file.
    assert all(o.checksum == rows[o.file_id].checksum for o in outputs)
    assert result.errors.count() == 0


def test_ids_do_not_depend_on_the_run(spark):
    frame = roots(spark, [("r", "top.zip", make_zip([("a", b"same"), ("b", b"same"), ("c/a", b"same")]))])
    first, second = ({r.file_id for r in process(frame, ["embedded"]).files.collect()} for _ in range(2))
    assert first == second and len(first) == 4


def test_without_recursion(spark):
    archive = make_zip([("in.zip", make_zip([("x.txt", b"x")])), ("m.eml", SMALL_MAIL)])
    result = process(roots(spark, [("r", "top.zip", archive)]), recurse=False)
    assert {(o.kind, o.name) for o in result.outputs.collect()} == {
        ("processed", "metadata.json"), ("embedded", "in.zip"), ("embedded", "m.eml"),
    }


def test_without_embedded_nothing_is_expanded(spark):
    archive = make_zip([("x.txt", b"x")])
    result = process(roots(spark, [("r", "top.zip", archive), ("s", "m.eml", SMALL_MAIL)]), types=["Text", "PDF"])
    assert {(o.root_id, o.process_type) for o in result.outputs.collect()} == {("s", "text"), ("s", "pdf")}
    assert result.errors.count() == 0


def test_errors_are_rows(spark):
    good = make_zip([("a.txt", b"a" * 1000), ("b.txt", bytes(range(256)) * 20)])
    flipped = bytearray(good)
    flipped[60] ^= 0xFF
    frame = spark.createDataFrame(
        [
            ("half", "h.zip", bytearray(good[: len(good) // 2]), "application/zip", ["embedded"]),
            ("flip", "f.zip", flipped, "application/zip", ["embedded"]),
            ("empty", "e.mbox", bytearray(b""), "application/mbox", ["embedded"]),
            ("typo", "t.zip", bytearray(good), "application/zip", ["embed"]),
            ("text", "x.pdf", bytearray(b"%PDF-1.4"), None, ["text"]),
            ("part", "p.eml", bytearray(b"Content-Type: multipart/mixed; boundary=x\n\n--x\nContent-Disposition: attachment\n\nb\n--x--"), "message/rfc822", ["embedded"]),
        ],
        "root_id string, name string, content binary, mimetype string, types array<string>",
    )
    result = process(frame)
    errors = {(e.root_id, e.stage, e.error_class) for e in result.errors.collect()}
    assert errors == {
        ("half", "expand", "bad_container"),
        ("flip", "expand", "bad_entry"),
        ("empty", "expand", "bad_container"),
        ("typo", "request", "unknown_type"),
        ("text", "extract", "unsupported_type"),
        ("part", "expand", "no_content_type"),
    }
    assert {(o.root_id, o.name) for o in result.outputs.collect()} == {("flip", "b.txt")}


def test_limits(spark):
    inner = make_zip([("deep.zip", make_zip([("x", b"x")]))])
    frame = roots(spark, [("r", "top.zip", make_zip([("big", b"0" * 5000), ("small", b"1"), ("in.zip", inner)]))])
    result = process(frame, ["embedded"], limits=Limits(entry_bytes=4000, max_depth=1))
    assert {(e.error_class) for e in result.errors.collect()} == {"too_large", "too_deep"}
    assert {o.name for o in result.outputs.collect()} == {"small", "in.zip", "deep.zip"}


def test_small_batches_give_the_same_rows(spark):
    archive = make_zip([(f"f{i}", b"%d" % i * 100) for i in range(200)])
    frame = as_roots(roots(spark, [("r", "top.zip", archive)]), ["embedded"])
    whole = found(files_of(expand_once(frame)))
    assert whole == found(files_of(expand_once(frame, limits=Limits(batch_bytes=500)))) and len(whole) == 200


def test_added_container_format(spark):
    def open_lines(content, types, limits):
        for i, line in enumerate(content.split(b"\n")):
            yield {"record": "child", "ordinal": i, "child_name": f"line-{i}", "content": line, "ctype": "text", "subtype": "plain"}

    rows = [("r", "x", b"a\nb", "application/x-lines")]
    frame = roots(spark, rows, "root_id string, name string, content binary, mimetype string")
    result = process(frame, ["embedded"], openers=Openers().with_opener("application/x-lines", open_lines))
    assert {(o.name, bytes(o.content)) for o in result.outputs.collect()} == {("line-0", b"a"), ("line-1", b"b")}


def test_added_extractor(spark):
    def sizes(frames):
        for frame in frames:
            texts = [str(len(c)) if len(c) < 10 else None for c in frame["content"]]
            faults = [None if t else "too long" for t in texts]
            yield pd.DataFrame({"file_id": frame["file_id"], "text": texts, "error": faults})

    extractor = Extractor("sizes", "text", ("application/pdf",), sizes)
    frame = roots(spark, [("a", "a.pdf", b"%PDF-1"), ("b", "b.pdf", b"%PDF-1.4 long"), ("c", "c.txt", b"text")])
    result = process(frame, ["text"], extractors=[extractor])
    assert {(o.root_id, o.text) for o in result.outputs.collect()} == {("a", "6"), ("c", "text")}
    assert [(e.root_id, e.error_class, e.message) for e in result.errors.collect()] == [("b", "extractor_error", "too long")]


def test_jobs(spark, tmp_path):
    (tmp_path / "a.eml").write_bytes(SMALL_MAIL)
    (tmp_path / "unasked.txt").write_bytes(b"x")
    jobs = spark.createDataFrame(
        [
            ("j1", f"file://{tmp_path}/a.eml", "out", None, ["text"], True),
            ("j2", f"file:{tmp_path}/a.eml", "out", "text/plain", ["text"], True),
            ("j3", f"file:{tmp_path}/absent", "out", None, ["text"], True),
            ("j4", "s3://bucket-only", "out", None, ["text"], True),
        ],
        "job_id string, input_uri string, output_uri string, mimetype string, types array<string>, recurse boolean",
    )
    result = process_jobs(jobs, scan_files(spark, str(tmp_path)))
    assert {(e.job_id, e.error_class) for e in result.errors.collect()} == {("j3", "not_found"), ("j4", "S3UriParseError")}
    outputs = result.outputs.collect()
    assert {(o.job_id, o.text) for o in outputs} == {("j1", "Zwei Kräne & ein Boot\nfehlen = 3 < 4\n\n\n"), ("j2", SMALL_MAIL.decode())}


def test_large_files_give_what_small_ones_give(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(make_zip([("d/", b""), ("../evil", b"x"), ("in.zip", make_zip([("x.txt", b"x" * 50)]))] + [(f"{i}.txt", b"%d" % i * 300) for i in range(300)]))
    (tmp_path / "b.mbox").write_bytes(mailbox(deep_mail(), *[b"N: %d\n\n>From x" % i for i in range(80)]))
    (tmp_path / "bad.zip").write_bytes(b"PK\x03\x04" + b"x" * 3000)
    (tmp_path / "c.txt").write_bytes(b"y" * 3000)
    small = process_path(spark, str(tmp_path))
    large = process_path(spark, str(tmp_path), large_bytes=1000)
    limited = process_path(spark, str(tmp_path), large_bytes=1000, value_bytes=2000, large_checksums=False)

    def rows(frame):
        # A file that is read by members has no content in its own row.
        return sorted(tuple(map(str, r)) for r in frame.drop("content", "text", "stored").collect())

    assert rows(small.files) == rows(large.files)
    assert rows(small.outputs) == rows(large.outputs)
    assert rows(small.errors) == rows(large.errors)
    classes = {(e.root_id.rsplit("/", 1)[1], e.error_class) for e in limited.errors.collect()}
    assert classes == {("a.zip", "unsafe_name"), ("bad.zip", "bad_container")}
    inside = F.col("depth") > 0
    assert rows(limited.outputs.where(inside)) == rows(small.outputs.where(inside))
    assert {r.checksum for r in limited.files.where(~inside).collect()} == {None}


def test_damaged_entries_cost_themselves_only(spark, tmp_path):
    kinds = {"stored": zipfile.ZIP_STORED, "deflate": zipfile.ZIP_DEFLATED, "bzip2": zipfile.ZIP_BZIP2, "lzma": zipfile.ZIP_LZMA}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, kind in kinds.items():
            for state in ("good", "bad"):
                archive.writestr(f"{name}-{state}", f"{name} {state} ".encode() * 200, kind)
    raw = bytearray(out.getvalue())
    with zipfile.ZipFile(io.BytesIO(bytes(raw))) as archive:
        for info in archive.infolist():
            if info.filename.endswith("-bad"):
                at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
                raw[at : at + 4] = bytes(255 - b for b in raw[at : at + 4])
    (tmp_path / "d.zip").write_bytes(bytes(raw))
    for size in (10**9, 100):
        result = process_path(spark, str(tmp_path), ["embedded"], large_bytes=size)
        assert {o.name for o in result.outputs.collect()} == {f"{name}-good" for name in kinds}
        assert [e.error_class for e in result.errors.collect()] == ["bad_entry"] * 4


def test_an_archive_within_itself_is_not_opened_again(spark):
    """A container format whose only member is itself."""

    def itself(content, types, limits):
        yield {"record": "child", "ordinal": 0, "child_name": "again.zip", "content": content, "ctype": "application", "subtype": "zip"}

    frame = roots(spark, [("r", "a.zip", b"PK\x03\x04 again")])
    result = process(frame, ["embedded"], openers=Openers().with_opener("application/zip", itself))
    assert [(e.error_class, e.message) for e in result.errors.collect()] == [("circular", "again.zip")]
    assert [o.name for o in result.outputs.collect()] == ["again.zip"]


def test_text_with_a_byte_order_mark(spark):
    frame = roots(spark, [("u", "u.txt", "caf\u00e9 \u20ac".encode("utf-16")), ("b", "b.txt", b"\xef\xbb\xbfcaf\xc3\xa9"), ("p", "p.txt", b"caf\xc3\xa9")])
    typed = frame.withColumn("mimetype", F.lit("text/plain"))
    result = process(typed, ["text"])
    assert {o.root_id: o.text for o in result.outputs.collect()} == {"u": "caf\u00e9 \u20ac", "b": "caf\u00e9", "p": "caf\u00e9"}


@pytest.mark.parametrize("step", [1, 7, 64, 10**6])
def test_mailbox_ranges(tmp_path, monkeypatch, step):
    """Messages by ranges of any size, read in steps of any size, against the whole mailbox line by line."""
    monkeypatch.setattr(large, "READ_BYTES", step)
    contents = [
        b"preamble\nFrom" + mailbox(b"N: 1\n\n>From x\n>>From y", b"", b"\nFrom\n From z", b"Fromage\n\nFrom", *[b"M: %d" % i for i in range(30)]),
        mailbox(b"only one"), b"From ", b"From a\nFrom b\nFrom c", b"none at all\n From x",
    ]
    for i, content in enumerate(contents):
        (tmp_path / f"{i}.mbox").write_bytes(content)
        for size in (1, 3, 50, 10**6):
            got = [b"".join(m) for at in range(0, len(content), size) for m in large._messages(str(tmp_path / f"{i}.mbox"), at, at + size)]
            assert got == split_mailbox(content)


def test_mailbox_members(spark, tmp_path):
    content = mailbox(*[b"N: %d\n\nbody" % i for i in range(200)])
    (tmp_path / "a.mbox").write_bytes(content)
    (tmp_path / "b.mbox").write_bytes(b"no separator")
    listed = spark.createDataFrame([(f"{tmp_path}/a.mbox", len(content)), (f"{tmp_path}/b.mbox", 12)], "path string, length long")
    rows = large.mailbox_members(listed, range_bytes=100).collect()
    found = sorted((r.ordinal, bytes(r.content)) for r in rows if r.record == "child")
    assert found == list(enumerate(split_mailbox(content)))
    assert [(r.path[-6:], r.error_class) for r in rows if r.record == "error"] == [("b.mbox", "bad_container")]


@pytest.mark.parametrize("kind", ["text", "metadata"])
def test_own_extractors_of_large_files(spark, tmp_path, kind):
    """They get a large content as a value while it fits into one; beyond that the file is an error row."""
    (tmp_path / "a.zip").write_bytes(make_zip([("x.txt", b"x" * 5000)]))

    def sizes(frames):
        for frame in frames:
            yield pd.DataFrame({"file_id": frame.file_id, "text": [str(len(c)) for c in frame.content], "error": None})

    mine = Extractor("sizes", kind, ("application/zip",), sizes)
    own = f"depth = 0 and process_type = '{kind}'"
    for options in ({}, {"large_bytes": 10}):
        result = process_path(spark, str(tmp_path), extractors=[mine], **options)
        assert [o.text for o in result.outputs.where(own).collect()] == [str((tmp_path / "a.zip").stat().st_size)]
    large = process_path(spark, str(tmp_path), extractors=[mine], large_bytes=10, value_bytes=10)
    assert large.outputs.where(own).count() == 0
    assert [(e.process_type, e.error_class) for e in large.errors.where(f"process_type = '{kind}'").collect()] == [(kind, "too_large")]


def test_text_of_attachments_with_a_charset(spark):
    raw = b"From: a@b\nContent-Type: multipart/mixed; boundary=x\n"
    for charset, text in (("iso-8859-1", "caf\u00e9"), ("windows-1252", "\u20ac 5"), ("utf-8", "\u0142"), ("koi8-r", "\u043c\u0438\u0440")):
        head = f"\n--x\nContent-Type: text/plain; charset={charset}\nContent-Disposition: attachment; filename={charset}\n\n"
        raw += head.encode() + text.encode(charset)
    result = process(roots(spark, [("r", "m.eml", raw + b"\n--x--\n")]), ["text", "embedded"])
    texts = {o.text for o in result.outputs.where("process_type = 'text' and depth = 1").collect()}
    assert texts == {"caf\u00e9", "\u20ac 5", "\u0142", "\u043c\u0438\u0440"}
    assert {bytes(o.content) for o in result.outputs.where("process_type = 'embedded'").collect()} >= {b"caf\xe9", b"\x80 5"}
