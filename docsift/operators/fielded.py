"""The fielded load-file table: one row per file with the fields of the EDRM production model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions.dates import mail_date_utc
from docsift.functions.mail_columns import header, header_value
from docsift.functions.paths import archive_path, extension

# Load-file fields that the inputs cannot supply; they are typed NULL columns.
UNSUPPLIED = {
    "Language": "string",
    "StartPage": "int",
    "EndPage": "int",
    "ReviewComment": "string",
    "ReadFlag": "boolean",
    "MessageClass": "string",
    "FlagStatus": "string",
    "DateCreated": "timestamp",
    "DateAccessed": "timestamp",
    "DateModified": "timestamp",
    "DatePrinted": "timestamp",
    "Title": "string",
    "Author": "string",
    "Company": "string",
    "Category": "string",
    "Comments": "string",
}


def file_fields(files: DataFrame) -> DataFrame:
    """FileName, FilePath, FileSize, Hash and FileExtension of every file, and the typed NULL columns."""
    return files.select(
        "file_id",
        F.col("name").alias("FileName"),
        archive_path(F.col("id_chain"), F.col("name")).alias("FilePath"),
        F.col("length").alias("FileSize"),
        F.col("checksum").alias("Hash"),
        extension(F.col("name")).alias("FileExtension"),
        *[F.lit(None).cast(t).alias(name) for name, t in UNSUPPLIED.items()],
    )


def message_fields(parsed: DataFrame) -> DataFrame:
    """Mail fields of every parsed message, keyed by ``file_id``."""
    headers, parts = F.col("headers"), F.col("parts")
    attached = F.filter(parts, lambda p: p["is_attachment"])
    # The last Received header is the first hop, the first one the delivery; its date stands after the semicolon.
    received = F.get(F.filter(headers, lambda h: h["kind"] == "received"), F.lit(0))["raw"]
    return parsed.select(
        "file_id",
        header_value(headers, "From").alias("From"),
        header_value(headers, "To").alias("To"),
        header_value(headers, "Cc").alias("CC"),
        header_value(headers, "Bcc").alias("BCC"),
        header_value(headers, "Subject").alias("Subject"),
        F.array_join(F.transform(headers, lambda h: F.concat(h["raw_name"], F.lit(": "), h["raw"])), "\n").alias("Header"),
        mail_date_utc(header(headers, "Date")["raw"]).alias("DateSent"),
        mail_date_utc(F.regexp_extract(received, r";([^;]*)$", 1)).alias("DateReceived"),
        (F.size(attached) > 0).alias("HasAttachments"),
        F.size(attached).alias("AttachmentCount"),
        F.array_join(F.transform(attached, lambda p: F.coalesce(p["name"], F.lit("message-attachment.dat"))), "; ").alias(
            "AttachmentNames"
        ),
        header_value(headers, "Importance").alias("ImportanceFlag"),
        header_value(headers, "Keywords").alias("Keywords"),
    )


def fielded(files: DataFrame, parsed: DataFrame) -> DataFrame:
    """The load file: file fields, joined with the mail fields on the unique file id."""
    return file_fields(files).join(message_fields(parsed), "file_id", "left")
