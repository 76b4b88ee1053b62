"""Mail parsing, rendering, text and metadata."""

import json

from conftest import NOTE_ID, SMALL_MAIL
from pyspark.sql import functions as F

from docsift.functions import mail_columns as mc
from docsift.operators.mail import parse_mail, parsed_mail


def parse(spark, raw):
    frame = spark.createDataFrame([(bytearray(raw),)], "content binary")
    return frame.select(parsed_mail("content").alias("m")).select("m.*")


def rendered(lines, paragraphs):
    """A mail's page from what each header line shows and the lines of its text."""
    head = "".join(f"<div><b>{name}</b>: {value}</div>\n" for name, value in lines)
    return head + "<br>\n<div>" + "\n".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"


def test_small_mail_as_html(spark):
    html = parse(spark, SMALL_MAIL).select(mc.render(F.col("headers"), F.col("parts"))).first()[0]
    shown = [
        ("Subject", "Kräne am Kai 7"),
        ("To", "Quay, Office &lt;office@quay.example&gt;"),
        ("Cc", "Ida &lt;ida@quay.example&gt;, &lt;lars@dock.example&gt;"),
        ("From", "Mia Voss &lt;mia@ledger.example&gt;"),
        ("Date", "2019-11-30T23:15:09+05:45"),
    ]
    assert html == rendered(shown, ["Zwei Kräne &amp; ein Boot", "fehlen = 3 &lt; 4", ""])


def test_small_mail_as_text(spark):
    body = parse(spark, SMALL_MAIL).select(mc.extracted_text(F.col("parts"))).first()[0]
    assert body.split("\n")[:2] == ["Zwei Kräne & ein Boot", "fehlen = 3 < 4"] and not body.strip("\n").endswith("\n")


def test_small_mail_metadata(spark):
    got = json.loads(parse(spark, SMALL_MAIL).select(mc.metadata_json(mc.mail_metadata(F.col("headers")))).first()[0])
    # The names of keys.
    subject, sender, sent, raw = "dc:subject", "Message:From-Email", "dcterms:created", "Message:Raw-Header:"
    assert got["Content-Type"] == "message/rfc822"
    assert got[subject] == got["dc:title"] == "Kräne am Kai 7"
    assert got[sent] == "2019-11-30T17:30:09Z"
    assert got[sender] == "mia@ledger.example"
    assert got[raw + "X-Berth"] == "12b" and got[raw + "Message-ID"] == f"<{NOTE_ID}>"


def test_header_kinds_and_names():
    headers, _, _ = parse_mail(SMALL_MAIL)
    kinds = {h["name"]: h["kind"] for h in headers}
    assert [h["name"] for h in headers][:3] == ["MIME-Version", "Subject", "To"]
    assert {n for n, k in kinds.items() if k == "addresses"} == {"To", "Cc", "From"}
    assert kinds["Date"] == "date" and kinds["Content-Type"] == "content_type" and kinds["Subject"] == "text"
    by_name = {h["name"]: h for h in headers}
    assert by_name["Message-ID"]["text"] == NOTE_ID
    assert by_name["Cc"]["addresses"] == [{"name": "Ida", "address": "ida@quay.example"}, {"name": None, "address": "lars@dock.example"}]


def test_only_known_plain_headers_are_shown(spark):
    raw = (
        b"X-Other: hidden\nSubject: =?utf-8?q?caf=C3=A9?= <x>\nReferences: <a@b>\n <c@d>\nKeywords: one, two\nIn-Reply-To: <a@b>\n"
        b"Received: from x by y; Mon, 1 Jan 2024 00:00:00 +0000\nReply-To: \"Last, First\" <r@x>\nTo:\n\nbody"
    )
    html = parse(spark, raw).select(mc.render(F.col("headers"), F.col("parts"))).first()[0]
    assert html.split("\n")[:-2] == [
        "<div><b>Subject</b>: café &lt;x&gt;</div>",
        "<div><b>References</b>: a@b, c@d</div>",
        "<div><b>Keywords</b>: one, two</div>",
        "<div><b>Reply-To</b>: Last, First &lt;r@x&gt;</div>",
    ]


def test_address_groups(spark):
    raw = b"To: Team: Ann <a@x>, b@x;, c@x\nFrom: f@x\n\nbody"
    headers, _, _ = parse_mail(raw)
    assert headers[0]["kind"] == "groups"
    html = parse(spark, raw).select(mc.header_value(F.col("headers"), "To")).first()[0]
    assert html == "Team <Ann <a@x>, <b@x>>, <<c@x>>"


ALTERNATIVE = (
    b"From: a@b\nContent-Type: multipart/mixed; boundary=out\n\npreamble\n--out\n"
    b"Content-Type: multipart/alternative; boundary=\"in ner\"\n\n--in ner\nContent-Type: text/plain; charset=iso-8859-1\n"
    b"Content-Transfer-Encoding: quoted-printable\n\ncaf=E9 =\nau lait\n--in ner\nContent-Type: text/html\n\n<p>caf\xc3\xa9</p>\n--in ner--\n"
    b"--out\nContent-Type: image/png; name=\"p.png\"\nContent-Transfer-Encoding: base64\nContent-Disposition: attachment\n\niVBORw0K\nGgo=\n"
    b"--out\nContent-Type: message/rfc822\nContent-Disposition: attachment\n\nSubject: inner\n\n>From here\n\n--out--\nepilogue"
)


def test_alternatives_and_attachments(spark):
    headers, parts, attachments = parse_mail(ALTERNATIVE)
    assert [(p["part_id"], p["parent"], p["kind"]) for p in parts] == [
        (0, None, "multipart"), (1, 0, "multipart"), (2, 1, "text"), (3, 1, "html"), (4, 0, "binary"), (5, 0, "message"),
    ]
    assert [p["part_id"] for p in parts if p["in_text_body"]] == [2]
    assert [p["part_id"] for p in parts if p["in_html_body"]] == [3]
    assert parts[2]["text"] == "café au lait"
    assert [(p["name"], data) for p, data in attachments] == [
        ("p.png", b"\x89PNG\r\n\x1a\n"),
        (None, b"Subject: inner\n\n>From here\n"),
    ]
    row = parse(spark, ALTERNATIVE).select(
        mc.render(F.col("headers"), F.col("parts")), mc.extracted_text(F.col("parts")), mc.attachment_names(F.col("parts"))
    ).first()
    assert row[0] == "<div><b>From</b>: &lt;a@b&gt;</div>\n<br>\n<div><p>café</p></div>"
    assert row[1] == "café au lait\n\n"
    assert row[2] == ["p.png", None]


def test_only_html_serves_both_bodies(spark):
    raw = b"From: a@b\nContent-Type: text/html; charset=utf-8\n\n<p>a &amp; b</p>"
    row = parse(spark, raw).select(mc.body_text(F.col("parts")), mc.render(F.col("headers"), F.col("parts"))).first()
    assert row[0] == "a & b"
    assert row[1].endswith("<div><p>a &amp; b</p></div>")


def test_odd_mails():
    for raw in (b"", b"\n", b"no header at all", b"Content-Type: multipart/mixed; boundary=x\n\n--x", b"A: b\r\n\r\n", b"\xff\xfe: \x00\n\n"):
        headers, parts, attachments = parse_mail(raw)
        assert len(parts) >= 1 and attachments == []
    _, parts, attachments = parse_mail(b"Content-Type: multipart/mixed; boundary=x\n\n--x\n--x\n\na\n--x\nContent-Disposition: attachment\n\nb\n--x--")
    assert [p["kind"] for p in parts] == ["multipart", "text", "text", "text"]
    assert attachments[0][0]["ctype"] is None and attachments[0][1] == b"b"


def test_duplicate_headers_become_lists(spark):
    raw = b"From: a@b\nX-Tag: one\nX-Tag: \"two\"\n\nbody"
    got = parse(spark, raw).select(mc.metadata_json(mc.mail_metadata(F.col("headers")))).first()[0]
    assert json.loads(got)["Message:Raw-Header:X-Tag"] == ["one", '"two"']


def test_custom_renderer(spark):
    renderer = mc.Renderer(
        header_text=lambda h: F.concat(h["name"], F.lit("="), h["text"]),
        header_addresses=lambda h: F.lit(None).cast("string"),
        header_date=lambda h: F.lit(None).cast("string"),
        part_text=lambda p: F.upper(p["text"]),
        header_prefix="", header_suffix=";", separator="--\n", part_prefix="[", part_suffix="]",
    )
    got = parse(spark, SMALL_MAIL).select(mc.render(F.col("headers"), F.col("parts"), renderer)).first()[0]
    lines, body = got.split("--\n")
    assert {"Subject=Kräne am Kai 7;", "X-Berth=12b;", f"Message-ID={NOTE_ID};"} <= set(lines.split("\n"))
    assert body == "[ZWEI KRÄNE & EIN BOOT\nFEHLEN = 3 < 4\n]"


def test_parts_without_text_are_left_to_the_renderer(spark):
    raw = (
        b"From: a@b\nContent-Type: multipart/mixed; boundary=x\n\n--x\nContent-Type: text/plain\n\nhi\n"
        b"--x\nContent-Type: image/png\nContent-Disposition: inline\n\nPNG\n--x--\n"
    )
    parsed = parse(spark, raw)
    assert parsed.select(mc.render(F.col("headers"), F.col("parts"))).first()[0].endswith("<br>\n<div><p>hi</p></div>")
    shown = mc.Renderer(part_inline=lambda p: F.concat(F.lit("["), p["subtype"], F.lit("]")))
    assert parsed.select(mc.render(F.col("headers"), F.col("parts"), shown)).first()[0].endswith("<div><p>hi</p></div><div>[png]</div>")


def test_deep_multiparts_keep_the_rest_of_the_mail():
    body = b"deepest"
    for i in range(150):
        body = b"Content-Type: multipart/mixed; boundary=b%d\n\n--b%d\nContent-Type: text/plain\n\nlevel\n--b%d\n" % (i, i, i) + body + b"\n--b%d--" % i
    headers, parts, _ = parse_mail(b"Subject: deep\n" + body)
    assert headers[0]["text"] == "deep" and sum(p["text"] == "level" for p in parts) >= 100
