"""Mails, mailboxes and archives built from the driver's tables, by distributed jobs.

A container holds the rows of one bounded id range, never all rows of a value, so no group grows with the data.
"""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from docsift.session import spread

# Rows per built container.
ROWS_PER_CONTAINER = 64

OFFSETS = ["+0000", "-0800", "+0530", "-0330"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table over all cores, also where its file is one input split."""
    return spread(table(spark, sf_dir, name), *keys)


def volume(column: str) -> Column:
    return F.floor(F.col(column) / ROWS_PER_CONTAINER).cast("bigint")


def base64_line(text: Column) -> Column:
    """Base64 of a text in one line."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))


def message_key() -> Column:
    return F.concat(F.lit("c"), F.col("conv_id"), F.lit("-t"), F.col("turn"))


def local_time() -> Column:
    """Wall-clock time of a turn's mail."""
    return F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60)


def offset() -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in OFFSETS]), (F.col("conv_id") % 4 + 1).cast("int"))


def subject() -> Column:
    first_line = F.substring_index("text", "\n", 1)
    return F.concat(F.lit("Turn "), F.col("turn"), F.lit(": "), first_line, F.lit("."))


def _common_headers() -> list[Column]:
    has_id = (F.col("conv_id") * 8 + F.col("turn")) % 10 != 9
    return [
        F.when(has_id, F.concat(F.lit("Message-ID: <"), message_key(), F.lit("@example.invalid>"))),
        F.concat(F.lit("Date: "), F.date_format(local_time(), "EEE, dd MMM yyyy HH:mm:ss "), offset()),
        F.concat(F.lit("From: Role "), F.col("role"), F.lit(" <"), F.col("role"), F.lit("@example.invalid>")),
        F.lit("To: Review Team <team@example.invalid>, archive@example.invalid"),
        F.concat(F.lit("Subject: =?utf-8?B?"), base64_line(subject()), F.lit("?=")),
        F.concat(F.lit("X-Thread: "), message_key()),
        F.lit("MIME-Version: 1.0"),
    ]


def plain_mail() -> Column:
    """A turn as a mail: base64 body on even turns, 8bit on odd ones."""
    even = F.col("turn") % 2 == 0
    head = F.concat_ws(
        "\n",
        *_common_headers(),
        F.lit("Content-Type: text/plain; charset=utf-8"),
        F.when(even, F.lit("Content-Transfer-Encoding: base64")).otherwise(F.lit("Content-Transfer-Encoding: 8bit")),
    )
    body = F.when(even, base64_line(F.col("text"))).otherwise(F.col("text"))
    return F.concat(head, F.lit("\n\n"), body)


def attached_mail() -> Column:
    """A turn as a mail with its text both as body and as attached file."""
    encoded = base64_line(F.col("text"))
    head = F.concat_ws("\n", *_common_headers(), F.lit('Content-Type: multipart/mixed; boundary="=-part"'))
    return F.concat(
        head,
        F.lit("\n\n--=-part\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"),
        encoded,
        F.lit("\n--=-part\nContent-Type: text/plain\nContent-Disposition: attachment; filename=\"turn-"),
        F.col("turn"),
        F.lit('.txt"\nContent-Transfer-Encoding: base64\n\n'),
        encoded,
        F.lit("\n--=-part--\n"),
    )


def mailbox_entry(mail: Column) -> Column:
    """A mail as it stands in a mailbox, without the last line feed: separator line, quoted message, empty line."""
    quoted = F.regexp_replace(mail, "(?dm)^(>*From )", ">$1")
    return F.concat(F.lit("From sender@example.invalid Mon Jan  1 00:00:00 2024\n"), quoted, F.lit("\n"))


def mails(spark: SparkSession, sf_dir: str, mail: Column | None = None) -> DataFrame:
    """One root per turn: ``root_id`` is the message key."""
    return spread_table(spark, sf_dir, "conversations", "conv_id", "turn").select(
        "conv_id",
        "turn",
        message_key().alias("root_id"),
        F.concat(message_key(), F.lit(".eml")).alias("name"),
        F.lit("message/rfc822").alias("mimetype"),
        F.encode(plain_mail() if mail is None else mail, "UTF-8").alias("content"),
    )


def mailboxes(spark: SparkSession, sf_dir: str, mail: Column | None = None) -> DataFrame:
    """One mailbox per conversation and range of turns: ``root_id`` is ``conv_id/volume``."""
    entry = F.concat(mailbox_entry(plain_mail() if mail is None else mail), F.lit("\n"))
    turns = spread_table(spark, sf_dir, "conversations", "conv_id", "turn").select(
        "conv_id", volume("turn").alias("volume"), "turn", entry.alias("entry")
    )
    in_order = F.array_sort(F.collect_list(F.struct("turn", "entry")))
    boxes = turns.groupBy("conv_id", "volume").agg(in_order.alias("entries"))
    return boxes.select(
        F.concat_ws("/", "conv_id", "volume").alias("root_id"),
        F.lit("conversation.mbox").alias("name"),
        F.lit("application/mbox").alias("mimetype"),
        F.encode(F.array_join(F.col("entries.entry"), ""), "UTF-8").alias("content"),
    )


def write_mailbox_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """All turns in mailbox files, as many as the scan has partitions."""
    turns = spread_table(spark, sf_dir, "conversations", "conv_id", "turn")
    turns.select(mailbox_entry(plain_mail())).write.text(path)


@F.arrow_udf(BinaryType())
def zip_of(entries: pa.Array) -> pa.Array:
    """A zip archive of ``array<struct<name, content>>``, with fixed entry times."""

    def build(files) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in files:
                archive.writestr(zipfile.ZipInfo(file["name"]), file["content"] or b"")
        return out.getvalue()

    return pa.array([build(row.as_py()) for row in entries], pa.binary())


# Each use of a column would build the archives again.
zip_of = zip_of.asNondeterministic()


def _entry(name: Column | str, content: Column) -> Column:
    return F.struct((F.lit(name) if isinstance(name, str) else name).alias("name"), content.alias("content"))


def document_zips(spark: SparkSession, sf_dir: str, entry_name: Column | None = None, extra: bool = True) -> DataFrame:
    """Archives of documents by ranges of ids; with ``extra`` a folder entry and one that leads out of the archive."""
    name = F.concat(F.lit("docs/"), F.col("source"), F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    name = name if entry_name is None else entry_name
    docs = spread_table(spark, sf_dir, "documents", "doc_id").select(
        volume("doc_id").alias("bucket"),
        F.struct("doc_id", _entry(name, F.encode("text", "UTF-8")).alias("e")).alias("d"),
    )
    entries = docs.groupBy("bucket").agg(F.array_sort(F.collect_list("d")).alias("docs"))
    listed = F.transform("docs", lambda d: d["e"])
    if extra:
        listed = F.concat(F.array(_entry("docs/", F.lit(b""))), listed, F.array(_entry("../outside.txt", F.lit(b"x"))))
    return entries.select(
        F.concat(F.lit("docs-"), F.col("bucket")).alias("root_id"),
        F.lit("documents.zip").alias("name"),
        F.lit("application/zip").alias("mimetype"),
        zip_of(listed).alias("content"),
    )


def nested_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives three levels deep: zip, mailbox, mails, attached files."""
    box = _entry(F.concat(F.lit("mail/"), F.col("name")), F.col("content"))
    return mailboxes(spark, sf_dir, attached_mail()).select(
        "root_id",
        F.lit("mail.zip").alias("name"),
        F.lit("application/zip").alias("mimetype"),
        zip_of(F.array(_entry("mail/", F.lit(b"")), box)).alias("content"),
    )


def page_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mail per document with an attached file: the web page of the same id, or else the text itself.

    Every seventh attachment has no name.
    """
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "html")
    docs = spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text").join(pages, "doc_id", "left")
    is_page = F.col("html").isNotNull()
    ctype = F.when(is_page, F.lit("text/html; charset=utf-8")).otherwise(F.lit("Text/Plain"))
    name = F.when(is_page, F.concat(F.lit("page-"), F.col("doc_id"), F.lit(".html"))).otherwise(F.lit("notes.txt"))
    disposition = F.when(F.col("doc_id") % 7 == 0, F.lit("attachment")).otherwise(
        F.concat(F.lit('attachment; filename="'), name, F.lit('"'))
    )
    mail = F.concat(
        F.lit("Message-ID: <doc-"), F.col("doc_id"), F.lit("@example.invalid>\n"),
        F.lit("Date: Mon, 1 Jan 2024 10:00:00 +0200\nFrom: sender@example.invalid\nTo: team@example.invalid\n"),
        F.lit("Subject: Document "), F.col("doc_id"),
        F.lit('\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="=-part"\n\n'),
        F.lit("--=-part\nContent-Type: text/plain; charset=utf-8\n\nSee the attached file.\n--=-part\nContent-Type: "),
        ctype, F.lit("\nContent-Disposition: "), disposition, F.lit("\nContent-Transfer-Encoding: base64\n\n"),
        base64_line(F.coalesce("html", "text")), F.lit("\n--=-part--\n"),
    )
    return docs.select(
        F.col("doc_id").cast("string").alias("root_id"),
        F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".eml")).alias("name"),
        F.lit("message/rfc822").alias("mimetype"),
        F.encode(mail, "UTF-8").alias("content"),
    )


def alternative_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails of pages: as two alternatives, as text only, or as HTML only, in turn."""
    text = F.concat(F.lit("Content-Type: text/plain; charset=utf-8\n\nPage at "), F.col("url"))
    html_head = F.lit("Content-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: base64\n\n")
    html = F.concat(html_head, base64_line(F.col("html")))
    both_head = F.lit('Content-Type: multipart/alternative; boundary="=-alt"\n\n--=-alt\n')
    both = F.concat(both_head, text, F.lit("\n--=-alt\n"), html, F.lit("\n--=-alt--\n"))
    kind = F.col("page_id") % 3
    mail = F.concat(
        F.lit("From: web@example.invalid\nMIME-Version: 1.0\n"),
        F.when(kind == 0, both).when(kind == 1, text).otherwise(html),
    )
    return spread_table(spark, sf_dir, "pages", "page_id").select(
        F.col("page_id").cast("string").alias("root_id"),
        F.concat(F.col("page_id"), F.lit(".eml")).alias("name"),
        F.lit("message/rfc822").alias("mimetype"),
        F.encode(mail, "UTF-8").alias("content"),
    )
