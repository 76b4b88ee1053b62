"""Column functions against fixed cases."""

import datetime as dt
import hashlib
import itertools

import pytest
from conftest import NOTE_ID, SMALL_MAIL, values
from pyspark.sql import functions as F

from docsift.functions import dates, identity, mail_columns, mime, paths, text, uris
from docsift.operators.routing import route, unknown_types
from docsift.sources import registry

ADDRESS = "struct<name:string,address:string>"

def test_checksum_vectors(spark):
    rows = [
        (bytearray(b""), "message/rfc822"),
        (bytearray(b""), "application/octet-stream"),
        (bytearray(b"Hello, world!"), "application/octet-stream"),
        (bytearray(SMALL_MAIL), "message/rfc822"),
        (bytearray(b"message-id:\r\n <" + NOTE_ID.encode() + b">\r\n\r\nx"), "message/rfc822"),
    ]
    got = values(spark, rows, "c binary, m string", identity.dedupe_checksum(F.col("c"), F.col("m")))
    # MD5 of nothing, and of one buffer that begins with the greeting. A mail is hashed by its id.
    of_nothing, of_greeting = "d41d8cd98f00b204e9800998ecf8427e", "bccf69bd7101c797b298c8b5329b965f"
    of_note = hashlib.md5(NOTE_ID.encode().ljust(1_000_000, b"\0")).hexdigest()
    assert got == [of_nothing, of_nothing, of_greeting, of_note, of_note]


def test_checksum_hashes_whole_buffers(spark):
    sizes = [0, 1, 999_999, 1_000_000, 1_000_001, 2_500_000]
    contents = [bytes((i * 7 + i // 251) % 256 for i in range(n)) for n in sizes]

    def expected(content):
        md5, buffer = hashlib.md5(), bytearray(1_000_000)
        for at in range(0, len(content), 1_000_000):
            chunk = content[at : at + 1_000_000]
            buffer[: len(chunk)] = chunk
            md5.update(buffer)
        return md5.hexdigest()

    got = values(spark, [(bytearray(c),) for c in contents], "c binary", identity.buffer_md5(F.col("c")))
    assert got == [expected(c) for c in contents]


def test_message_id_comes_from_the_head_only(spark):
    rows = [
        b"Subject: x\nMessage-ID: <a@b>\n\nMessage-ID: <body@b>",
        b"Subject: x\n\nMessage-ID: <body@b>",
        b"\nMessage-ID: <body@b>\n",
        b"Message-ID: <first@b>\nMessage-ID: <last@b>\n\n",
        b"Message-ID: bare@b\r\nX: \x85\xff\r\n\r\nbody",
        b"X-Message-ID: <other@b>\n\n",
        b"Message-ID: <noted@b> (added by a relay)\n\n",
        b"Message-ID:" + b"\n " * 100_000 + b"<folded@b>\n\n",
        b"Message-ID: two words\n\n",
    ]
    got = values(spark, [(bytearray(r),) for r in rows], "c binary", identity.message_id(F.col("c")))
    assert got == ["a@b", None, None, "last@b", "bare@b", None, "noted@b", "folded@b", None]


@pytest.mark.parametrize(
    "written, shown",
    [
        ("Sat, 30 Nov 2019 23:15:09 +0545 (NPT)", "2019-11-30T23:15:09+05:45"),
        ("Fri, 07 Jun 2013 00:00:59 +0200", "2013-06-07T00:00:59+02:00"),
        ("1 Jan 99 1:02 GMT", "1999-01-01T01:02:00Z"),
        ("Tue,  2 Mar 04 03:04:05 EST", "2004-03-02T03:04:05-05:00"),
        ("2 March 2004 03:04:05 -0000", "2004-03-02T03:04:05Z"),
        ("31 Feb 2004 03:04:05 +0000", None),
        ("2 Xyz 2004 03:04:05 +0000", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_mail_dates(spark, written, shown):
    assert values(spark, [(written,)], "d string", dates.mail_date_iso(F.col("d"))) == [shown]


def test_mail_date_as_instant(spark):
    got = values(spark, [("Sat, 30 Nov 2019 23:15:09 +0545",)], "d string", dates.mail_date_utc(F.col("d")))
    assert got == [dt.datetime(2019, 11, 30, 17, 30, 9)]


NAMES = [None, "", "Ole", "Zoë, Dr."]
PLACES = [None, "z@y.example"]


def plain_address(name, address):
    """The rule in Python: what is there, the address in angle brackets, a blank between."""
    shown = [x for x in (name, address and f"<{address}>") if x is not None]
    return " ".join(shown) if shown else None


def plain_list(shown):
    return ", ".join(x for x in shown if x is not None) or None


def test_format_addresses(spark):
    """All names with all addresses, and all lists of up to two of them."""
    grid = list(itertools.product(NAMES, PLACES))
    column = mail_columns.format_name_address(F.col("a")["name"], F.col("a")["address"])
    assert values(spark, [(a,) for a in grid], f"a {ADDRESS}", column) == [plain_address(*a) for a in grid]
    lists = [list(chosen) for n in range(3) for chosen in itertools.product(grid[2:], repeat=n)]
    column = mail_columns.format_addresses(F.col("a"))
    assert values(spark, [(x,) for x in lists], f"a array<{ADDRESS}>", column) == [plain_list([plain_address(*a) for a in x]) for x in lists]


def test_format_groups(spark):
    group = f"struct<name:string,addresses:array<{ADDRESS}>>"
    members = [[], [("Ole", "z@y.example")], [(None, "z@y.example"), ("Ole", None)], [(None, None)]]
    grid = [(name, chosen) for name in (None, "Crew") for chosen in members]

    def plain_group(name, chosen):
        return plain_address(name, plain_list([plain_address(*a) for a in chosen]))

    assert values(spark, [(g,) for g in grid], f"g {group}", mail_columns.format_group(F.col("g"))) == [plain_group(*g) for g in grid]
    pairs = [list(pair) for pair in itertools.product(grid, repeat=2)]
    got = values(spark, [(x,) for x in pairs], f"g array<{group}>", mail_columns.format_groups(F.col("g")))
    assert got == [plain_list([plain_group(*g) for g in x]) for x in pairs]


def test_format_text_list(spark):
    lists = [list(chosen) for n in range(4) for chosen in itertools.product(["", "blue", "a, b"], repeat=n)]
    got = values(spark, [(x,) for x in lists], "t array<string>", mail_columns.format_text_list(F.col("t")))
    assert got == [plain_list([t or None for t in x]) for x in lists]


def test_content_type(spark):
    got = values(spark, [("text", "plain"), ("text", None)], "t string, s string", mime.format_content_type(F.col("t"), F.col("s")))
    assert got == ["text/plain", "text"]


def test_text_functions(spark):
    assert values(spark, [("a<b>&\"c\"",)], "t string", text.escape_html(F.col("t"))) == ['a&lt;b&gt;&amp;"c"']
    assert values(spark, [("a\n<\n",), ("",)], "t string", text.paragraphs(F.col("t"))) == [
        "<p>a</p>\n<p>&lt;</p>\n<p></p>",
        "<p></p>",
    ]
    spaced = bytearray(b"a" + b" " * 200_000 + b"b")
    assert values(spark, [(spaced,)], "c binary", text.clean_text(F.col("c"))) == [spaced.decode()]
    dirty = [bytearray(b" \t\xe2\x80\x83a\x00b\xffc \n"), bytearray(b"\x00"), bytearray(b"plain")]
    assert values(spark, [(d,) for d in dirty], "c binary", text.clean_text(F.col("c"))) == ["ab�c", "", "plain"]


def test_html_to_text(spark):
    pages = [
        "<html><head><title>T</title><style>p{}</style></head><body><p>a &amp;amp; b</p><!-- x\ny --><p>c<b>d</b></p>"
        "<SCRIPT>if (a<b) x('</p>')</SCRIPT >e</body></html>",
        "1 &lt; 2 &#65;&#x42;&#x1F600; &eacute;&unknown; &amp &#0; &#xD800; & x",
        "no markup, a < b",
        "",
    ]
    got = values(spark, [(p,) for p in pages], "h string", text.html_to_text(F.col("h")))
    assert got == [
        "T\na &amp; b\ncd\ne",
        "1 < 2 AB\U0001f600 é&unknown; &amp &#0; &#xD800; & x",
        "no markup, a < b",
        "",
    ]


def test_object_locations(spark):
    uris_ = [
        "s3://bucket/a/b%20c+d", "s3://bucket/", "s3://bucket", "https://host/key", "s3:///key", "nonsense", None,
    ]
    strict = values(spark, [(u,) for u in uris_], "u string", uris.object_location(F.col("u")))
    assert [tuple(v) if v else None for v in strict] == [
        ("bucket", "a/b c+d"), ("bucket", ""), None, None, None, None, None,
    ]
    lenient = values(spark, [(u,) for u in uris_], "u string", uris.object_location(F.col("u"), strict=False))
    assert [tuple(v) if v else None for v in lenient] == [
        ("bucket", "a/b%20c+d"), ("bucket", ""), ("bucket", ""), ("host", "key"), None, None, None,
    ]


def test_entry_names(spark):
    cases = {
        "a/b.txt": "b.txt", "a/../b.txt": "b.txt", "../b.txt": None, "a/../../b": None, "/b": None, "a/..": None,
        "a/.": "a", "d/": "d", "b\0.txt": None, "..": None, "": None, "./x": "x", "a//b": "b",
    }
    got = values(spark, [(c,) for c in cases], "n string", paths.safe_name(F.col("n")))
    assert got == list(cases.values())


def test_paths(spark):
    got = values(spark, [(["a", "b"], "x.txt")], "c array<string>, n string", paths.archive_path(F.col("c"), F.col("n")))
    assert got == ["a/b/x.txt"]
    got = values(spark, [("a/b/x",), ("x",), ("a/",)], "p string", paths.parent_folder(F.col("p")))
    assert got == ["a/b/", "", "a/"]
    got = values(spark, [("a.b/c.TXT",), ("a.b/c",), (".hidden",), ("x.",)], "p string", paths.extension(F.col("p")))
    assert got == [".txt", None, None, None]


def test_identify(spark):
    cases = [
        (SMALL_MAIL, "message/rfc822"),
        (b"From crew@dock.example Tue Jan  5 10:00:00 2021\nReceived: x\n\nbody", "application/mbox"),
        (b"PK\x03\x04rest", "application/zip"),
        (b"\n <!DOCTYPE HTML><p>", "text/html"),
        (b"%PDF-1.4", "application/pdf"),
        (b"just text", "text/plain"),
        (b"Subject: not a mail without a second header", "text/plain"),
        (b"Received: a\n" + b"\tfolded\n" * 500 + b"To: b\n\nbody", "message/rfc822"),
        (b"To: a\n" + b" folded,\n" * 100_000 + b"From: b\n\nbody", "message/rfc822"),
        (b"\n" * 5000 + b"<!doctype html><p>", "text/html"),
        (b"Subject: one\n\nTo: two", "text/plain"),
        (b"a\x00b", "application/octet-stream"),
        (b"\xff\xfe", "application/octet-stream"),
        (b"", "application/octet-stream"),
    ]
    got = values(spark, [(bytearray(c),) for c, _ in cases], "c binary", mime.identify_or_default(F.col("c")))
    assert got == [m for _, m in cases]


def test_type_by_name_comes_before_plain_text(spark):
    files = spark.createDataFrame([("a.EML", bytearray(b"text")), ("b.zip", bytearray(b"\xff")), ("c", bytearray(b"t"))], "name string, content binary")
    typed = registry.with_type_by_name(files, registry.mime_registry(spark))
    got = {r.name: r.m for r in typed.select("name", mime.identify_or_default(F.col("content"), F.col("type_by_name")).alias("m")).collect()}
    assert got == {"a.EML": "message/rfc822", "b.zip": "application/zip", "c": "text/plain"}


def test_registry_from_markdown(spark, tmp_path):
    table = tmp_path / "types.md"
    table.write_text(
        "| MIME Type | Extension |\n|---|---|\n| **Implemented** | |\n| application/zip | .zip |\n| | |\n| **Next** | |\n"
        "| image/jpeg | .jpeg, .jpg |\n| image/x-jpeg | .jpg |\n| **Remaining** | |\n| application/andrew-inset | N/A |\n"
    )
    rows = {tuple(r) for r in registry.read_registry(spark, str(table)).collect()}
    assert rows == {
        ("application/zip", ".zip", "implemented"),
        ("image/jpeg", ".jpeg", "next"),
        ("image/jpeg", ".jpg", "next"),
        ("image/x-jpeg", ".jpg", "next"),
        ("application/andrew-inset", "N/A", "remaining"),
    }
    types = {tuple(r) for r in registry.types_by_extension(registry.read_registry(spark, str(table))).collect()}
    assert types == {(".zip", "application/zip"), (".jpeg", "image/jpeg"), (".jpg", "image/jpeg")}


def test_routes(spark):
    files = spark.createDataFrame(
        [("text/plain", ["all"]), ("text/plain ", ["text"]), ("message/rfc822", ["ALL"]), ("application/zip", ["text", "Embedded"])],
        "mimetype string, types array<string>",
    )
    got = {(r.mimetype, r.process_type, r.extractor) for r in route(files).collect()}
    assert got == {
        ("text/plain", "text", "default_text"),
        ("text/plain", "metadata", "default_metadata"),
        ("message/rfc822", "text", "default_text"),
        ("message/rfc822", "metadata", "default_metadata"),
        ("message/rfc822", "pdf", "rfc822_render"),
        ("message/rfc822", "embedded", "rfc822_embedded"),
        ("application/zip", "embedded", "zip_embedded"),
    }
    got = values(spark, [(["Text", "ocr", "PDF"],), (["all"],)], "t array<string>", unknown_types(F.col("t")))
    assert got == [["ocr"], []]


def test_metadata_key(spark):
    rows = [('{"Content-Type":"text/plain","n":1}',), ('{"Content-Type":["a"]}',), ("{}",), ("not json",), (None,)]
    assert values(spark, rows, "j string", mail_columns.metadata_key(F.col("j"), "Content-Type")) == ["text/plain", None, None, None, None]
