"""The MIME registry: which extensions a MIME type has."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.paths import extension

# Types with an extractor, and types planned next.
IMPLEMENTED = {"application/zip": ".zip", "application/mbox": ".mbox", "message/rfc822": ".eml"}
NEXT = {
    "image/jpeg": ".jpeg, .jpg",
    "image/x-citrix-jpeg": ".jpeg, .jpg",
    "image/png": ".png",
    "image/x-citrix-png": ".png",
    "image/x-png": ".png",
    "image/tiff": ".tiff",
    "image/bmp": ".bmp",
    "application/x-bzip": ".bz",
    "application/x-bzip2": ".bz2",
    "application/x-tar": ".tar",
    "application/gzip": ".gz",
}

# Further common types. A fuller list can be read from a file, see ``read_registry``.
REMAINING = {
    "application/epub+zip": ".epub",
    "application/java-archive": ".jar",
    "application/json": ".json",
    "application/msword": ".doc, .dot",
    "application/octet-stream": ".bin, .dll, .dmg, .exe, .iso, .o, .so",
    "application/ogg": ".ogx",
    "application/pdf": ".pdf",
    "application/pkcs7-mime": ".p7c",
    "application/postscript": ".ai, .eps, .ps",
    "application/rtf": ".rtf",
    "application/vnd.ms-excel": ".xls, .xlb",
    "application/vnd.ms-outlook": ".msg",
    "application/vnd.ms-powerpoint": ".ppt, .pot, .pps",
    "application/vnd.oasis.opendocument.presentation": ".odp",
    "application/vnd.oasis.opendocument.spreadsheet": ".ods",
    "application/vnd.oasis.opendocument.text": ".odt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.rar": ".rar",
    "application/wasm": ".wasm",
    "application/x-7z-compressed": ".7z",
    "application/x-cpio": ".cpio",
    "application/x-latex": ".latex",
    "application/x-sh": ".sh",
    "application/x-tex": ".tex",
    "application/x-xz": ".xz",
    "application/xml": ".xml, .xsl, .xpdl",
    "application/yaml": ".yaml, .yml",
    "audio/aac": ".aac",
    "audio/basic": ".au, .snd",
    "audio/flac": ".flac",
    "audio/midi": ".mid, .midi",
    "audio/mp4": ".m4a",
    "audio/mpeg": ".mp2, .mp3",
    "audio/ogg": ".ogg, .oga",
    "audio/x-wav": ".wav",
    "font/otf": ".otf",
    "font/ttf": ".ttf",
    "font/woff": ".woff",
    "font/woff2": ".woff2",
    "image/avif": ".avif",
    "image/gif": ".gif",
    "image/heic": ".heic",
    "image/svg+xml": ".svg",
    "image/vnd.microsoft.icon": ".ico",
    "image/webp": ".webp",
    "text/calendar": ".ics",
    "text/css": ".css",
    "text/csv": ".csv",
    "text/html": ".htm, .html",
    "text/javascript": ".js, .mjs",
    "text/markdown": ".md, .markdown",
    "text/plain": ".txt, .log, .conf, .ini",
    "text/tab-separated-values": ".tsv",
    "text/vcard": ".vcf",
    "text/x-c": ".c, .h",
    "text/x-python": ".py",
    "video/mp4": ".mp4",
    "video/mpeg": ".mpeg, .mpg",
    "video/quicktime": ".mov, .qt",
    "video/webm": ".webm",
    "video/x-msvideo": ".avi",
}

_STATUS_RANK = {"implemented": 0, "next": 1, "remaining": 2}


def mime_registry(spark: SparkSession) -> DataFrame:
    """``mimetype, extension, status``, one row per extension of the fixed tables."""
    tables = {"implemented": IMPLEMENTED, "next": NEXT, "remaining": REMAINING}
    rows = [(m, e.strip(), status) for status, table in tables.items() for m, exts in table.items() for e in exts.split(",")]
    # An Arrow table becomes a local relation, whose size Spark knows when it chooses a join.
    return spark.createDataFrame(pa.table(dict(zip(("mimetype", "extension", "status"), zip(*rows)))))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A registry kept as a Markdown table of type and extensions, with ``**Section**`` rows giving the status."""
    # The text between section marks is, in turn, a section's name and its rows.
    pieces = F.split("value", r"\*\*", -1)
    sections = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2)),
        lambda i: F.struct(F.lower(F.get(pieces, i)).alias("status"), F.split(F.get(pieces, i + 1), "\n").alias("lines")),
    )
    marked = spark.read.text(path, wholetext=True).where(F.size(pieces) >= 3)
    lines = marked.select(F.inline(sections)).select("status", F.explode("lines").alias("line"))
    cells = lines.select("status", F.transform(F.split("line", r"\|", -1), lambda c: F.trim(c)).alias("cells"))
    rows = cells.select("status", F.get("cells", F.lit(1)).alias("mimetype"), F.get("cells", F.lit(2)).alias("exts"))
    rows = rows.where(F.contains("mimetype", F.lit("/")))
    return rows.select("mimetype", F.explode(F.split("exts", r",\s*")).alias("extension"), "status").distinct()


def types_by_extension(registry: DataFrame) -> DataFrame:
    """One MIME type per extension: implemented types first, then the alphabetical order."""
    rank = F.create_map(*[F.lit(x) for pair in _STATUS_RANK.items() for x in pair])
    usable = registry.where(F.col("extension").startswith("."))
    best = F.min(F.struct(F.element_at(rank, F.col("status")).alias("rank"), "mimetype"))
    return usable.groupBy(F.lower("extension").alias("extension")).agg(best.getField("mimetype").alias("type_by_name"))


def with_type_by_name(files: DataFrame, registry: DataFrame, name: str = "name") -> DataFrame:
    """Add ``type_by_name``, the registry's type for each file's extension."""
    # Broadcast by Spark on account of its size; a registry lists the MIME types that exist, about a thousand.
    types = types_by_extension(registry)
    return files.withColumn("extension", extension(F.col(name))).join(types, "extension", "left").drop("extension")
