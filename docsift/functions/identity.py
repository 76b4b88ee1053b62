"""Checksums and the identity key used to find duplicate files."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docsift.functions.mime import unfolded
from docsift.schemas import MAIL

# Fixed value: the checksum reads through a buffer of this many bytes and always hashes the whole buffer.
BUFFER_BYTES = 1_000_000

# The id stands in angle brackets, and what follows them is a comment; or it is all there is.
_MESSAGE_ID = r"(?dim)^message-id:[ \t]*+(?:<([^<>\s]++)>|([^<>\s]++)[ \t]*+\r?$)"


@F.arrow_udf(StringType())
def buffer_md5(content: pa.Array) -> pa.Array:
    """MD5 over whole buffers: the unused end of a buffer holds what the chunk before left there, at first zeros."""
    zeros = memoryview(bytes(BUFFER_BYTES))
    # A short content costs a whole buffer, so its copies within a batch are hashed once.
    seen: dict[bytes, str] = {}

    def digest(value) -> str | None:
        if not value.is_valid:
            return None
        data = memoryview(value.as_buffer())
        if len(data) >= BUFFER_BYTES:
            return hashed(data)
        key = bytes(data)
        if key not in seen:
            seen[key] = hashed(data)
        return seen[key]

    def hashed(data: memoryview) -> str:
        md5 = hashlib.md5(data)
        used = len(data) % BUFFER_BYTES
        if used and len(data) < BUFFER_BYTES:
            md5.update(zeros[used:])
        elif used:
            start = len(data) - BUFFER_BYTES
            md5.update(data[start : start + BUFFER_BYTES - used])
        return md5.hexdigest()

    return pa.array([digest(value) for value in content], pa.string())


def message_id(content: Column) -> Column:
    """Message-ID of a mail without its angle brackets, NULL when there is none. The last one counts."""
    raw = content.cast("string")
    head = F.substring_index(F.substring_index(raw, "\n\n", 1), "\n\r\n", 1)
    head = F.when(raw.startswith("\n") | raw.startswith("\r\n"), F.lit("")).otherwise(head)
    # One character per byte, whatever the charset of the mail.
    head = F.decode(head.cast("binary"), "ISO-8859-1")
    # Folded lines are joined before the match, however many there are.
    head = unfolded(F.replace(head, F.lit("\r\n"), F.lit("\n")))
    bracketed, bare = (F.try_element_at(F.regexp_extract_all(head, F.lit(_MESSAGE_ID), i), F.lit(-1)) for i in (1, 2))
    return F.coalesce(F.nullif(bracketed, F.lit("")), F.nullif(bare, F.lit("")))


def identity_bytes(content: Column, mimetype: Column) -> Column:
    """The bytes that decide whether two files are the same: a mail's Message-ID if it has one, else all content."""
    return F.when(mimetype == MAIL, F.coalesce(F.encode(message_id(content), "ISO-8859-1"), content)).otherwise(content)


def dedupe_checksum(content: Column, mimetype: Column) -> Column:
    return buffer_md5(identity_bytes(content, mimetype))
