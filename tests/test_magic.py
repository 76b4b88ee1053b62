"""Signature rules: columns against bytes in Python, files as other programs write them, and what must not match."""

import bz2
import gzip
import io
import lzma
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from docsift import process
from docsift.functions import magic
from docsift.functions.mime import identify_or_default, mime_by_magic
from conftest import make_zip, roots

WORD = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"


def zip_of(*entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in entries:
            archive.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def tar():
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        info = tarfile.TarInfo("a.txt")
        info.size = 3
        archive.addfile(info, io.BytesIO(b"abc"))
    return out.getvalue()


KNOWN = [
    (zip_of(("[Content_Types].xml", b"<x/>"), ("_rels/.rels", b"r"), ("word/document.xml", b"d")), WORD),
    (zip_of(("_rels/.rels", b"r"), ("xl/workbook.xml", b"d")), WORD.replace("wordprocessingml.document", "spreadsheetml.sheet")),
    (zip_of(("docProps/app.xml", b"r" * 500), ("ppt/presentation.xml", b"d")), WORD.replace("wordprocessingml.document", "presentationml.presentation")),
    (zip_of(("mimetype", b"application/vnd.oasis.opendocument.text"), ("content.xml", b"x")), "application/vnd.oasis.opendocument.text"),
    (zip_of(("mimetype", b"application/vnd.oasis.opendocument.text-template"), ("content.xml", b"x")), "application/vnd.oasis.opendocument.text-template"),
    (zip_of(("mimetype", b"application/epub+zip"), ("a", b"x")), "application/epub+zip"),
    (zip_of(("META-INF/MANIFEST.MF", b"Manifest-Version: 1.0\n")), "application/x-java-archive"),
    (zip_of(("note.txt", b"word/ xl/ [Content_Types].xml")), "application/zip"),
    (zip_of(), "application/zip"),
    (gzip.compress(b"x"), "application/gzip"),
    (bz2.compress(b"x"), "application/x-bzip2"),
    (bz2.compress(b""), "application/x-bzip2"),
    (lzma.compress(b"x"), "application/x-xz"),
    (tar(), "application/x-tar"),
    (b"RIFF\x10\0\0\0WEBPVP8 ", "image/webp"),
    (b"RIFF\x10\0\0\0WAVEfmt ", "audio/x-wav"),
    (b"BM\x46\0\0\0\0\0\0\0\x36\0\0\0\x28\0\0\0", "image/bmp"),
    (b"ID3\x03\0\0\0\0\0\x10", "audio/mpeg"),
    (b"\0\0\0\x18ftypmp42", "video/mp4"),
    (b"SQLite format 3\0\x10\0", "application/vnd.sqlite3"),
    (b"\0" * 128 + b"DICM", "application/dicom"),
    (b"{\\rtf1\\ansi hello}", "application/rtf"),
    (b"From a@b\n", "application/mbox"),
]
# Texts that begin like a signature.
TEXTS = [b"BMW is a maker of cars and more", b"ID3 tags are read", b"RIFF is a format", b"BZh is not enough", b"ftyp here: ftyp", b"PK is a name", b"%PDF is a mark", b"ustar" * 60, b"wOFF we go", b"MZ"]


def test_known_files(spark):
    rows = spark.createDataFrame([(i, bytearray(d)) for i, (d, _) in enumerate(KNOWN)], "i int, content binary")
    found = {r.i: r.m for r in rows.select("i", mime_by_magic(F.col("content")).alias("m")).collect()}
    assert [found[i] for i in range(len(KNOWN))] == [m for _, m in KNOWN]
    assert [magic.magic_of(d) for d, _ in KNOWN] == [m for _, m in KNOWN]


def test_texts_stay_texts(spark):
    rows = spark.createDataFrame([(bytearray(t),) for t in TEXTS], "content binary")
    assert {r.m for r in rows.select(identify_or_default(F.col("content")).alias("m")).collect()} == {"text/plain"}
    assert {magic.magic_of(t) for t in TEXTS} == {None}


def test_columns_and_bytes_agree(spark):
    rng = random.Random(3)
    data = [b"", *TEXTS]
    for d, _ in KNOWN:
        for _ in range(12):
            cut = bytearray(d[: rng.randrange(len(d) + 1)])
            for _ in range(rng.randrange(3)):
                if cut:
                    cut[rng.randrange(min(len(cut), 60))] = rng.randrange(256)
            data.append(bytes(cut))
    rows = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, content binary")
    for r in rows.select("i", magic.magic_type(F.col("content")).alias("m")).collect():
        assert r.m == magic.magic_of(data[r.i]), data[r.i]


def test_an_office_file_in_an_archive_is_a_file(spark):
    """What looks like an archive by its first bytes and is a document is not taken apart."""
    word = KNOWN[0][0]
    result = process(roots(spark, [("r", "a.zip", make_zip([("letter", word), ("plain.zip", make_zip([("x.txt", b"x")]))]))]), ["embedded"])
    assert {(o.name, o.mimetype) for o in result.outputs.collect()} == {("letter", WORD), ("plain.zip", "application/zip"), ("x.txt", "text/plain")}


@pytest.mark.parametrize("mimetype, tests", magic.RULES)
def test_rules_look_no_further_than_the_head(mimetype, tests):
    assert "/" in mimetype and all(0 <= t.place and t.size > 0 and max(t.place, t.until or 0) <= magic.HEAD_BYTES for t in tests)
