"""Container formats: what opens a content and yields the rows of what is in it."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from docsift.operators.mail import parse_mail
from docsift.schemas import MAIL, MBOX, ZIP
from docsift.session import new_run_dir
from docsift.sources.contents import INLINE_BYTES, TooLarge, kept_content

_SEPARATOR = re.compile(rb"^From [^\n]*(?:\n|\Z)", re.MULTILINE)
_QUOTED = re.compile(rb"^>(>*From )", re.MULTILINE)
_READ_BYTES = 1 << 20

# Yields dictionaries with the columns of EXPANDED that are not carried over from the container.
Opener = Callable[[bytes, list[str], "Limits"], Iterator[dict]]


@dataclass(frozen=True)
class Limits:
    """How much is held at once, and guards against archive bombs.

    A content above ``inline_bytes`` goes into a file of its own below ``folder`` and is handled there like any other.
    ``entry_bytes`` and ``max_depth`` are guards, off unless given: what exceeds them becomes an error row. Nesting needs
    no limit: an archive that lies within itself, by its checksum, is not opened again, and all other containers are
    longer than what they hold.
    """

    inline_bytes: int = INLINE_BYTES
    entry_bytes: int | None = None
    batch_bytes: int = 8 << 20
    max_depth: int | None = None
    folder: str | None = None

    def with_folder(self, spark: SparkSession) -> Limits:
        """With a folder for large contents in the shared folder; results point to it, so it stays."""
        return self if self.folder is not None else replace(self, folder=new_run_dir(spark, "contents", kept=True))


@dataclass(frozen=True)
class Openers:
    """Container formats by MIME type; more can be added with ``with_opener``."""

    by_type: dict[str, Opener] = field(default_factory=lambda: {ZIP: open_zip, MBOX: open_mbox, MAIL: open_mail})

    def with_opener(self, mimetype: str, opener: Opener) -> Openers:
        return Openers({**self.by_type, mimetype: opener})


def error_of(error_class: str, message: str, **where) -> dict:
    return {"record": "error", "error_class": error_class, "message": message, **where}


def open_zip(content: bytes, types: list[str], limits: Limits) -> Iterator[dict]:
    """Entries of a zip archive. A damaged entry costs one error row, the others are still read."""
    if "embedded" not in types:
        return

    def pieces(info: zipfile.ZipInfo) -> Iterator[bytes]:
        with archive.open(info) as stream:
            while piece := stream.read(_READ_BYTES):
                yield piece

    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for ordinal, info in enumerate(archive.infolist()):
            # orig_filename keeps what zipfile would cut off at a NUL.
            row = opened_row(info.orig_filename, info.file_size, lambda: pieces(info), limits)  # noqa: B023 - used at once
            yield {"ordinal": ordinal, **row}


def opened_row(name: str, size: int, pieces: Callable[[], Iterator[bytes]], limits: Limits) -> dict:
    """The row of an archive's entry, whose content comes in pieces."""
    where = {"child_name": name}
    if name.endswith("/"):
        return {"record": "child", "content": b"", **where}
    if limits.entry_bytes is not None and size > limits.entry_bytes:
        return error_of("too_large", f"{name}: {size} bytes", **where)
    try:
        return {"record": "child", **kept_content(pieces(), limits.folder, limits.inline_bytes, limits.entry_bytes), **where}
    except TooLarge as e:
        # The size in the directory may be false, so the data itself is measured.
        return error_of("too_large", f"{name}: {e}", **where)
    except Exception as e:  # noqa: BLE001 - each compression has errors of its own for untrusted bytes
        return error_of("bad_entry", f"{name}: {e}", **where)


def open_mbox(content: bytes, types: list[str], limits: Limits) -> Iterator[dict]:
    """Messages of a mailbox: the bytes after a separator line up to the next, one ``>`` taken off quoted lines."""
    if "embedded" not in types:
        return
    start, ordinal = None, 0
    for line in _SEPARATOR.finditer(content):
        if start is not None:
            yield _mbox_message(content[start : line.start()], ordinal)
            ordinal += 1
        start = line.end()
    if start is None:
        raise ValueError("no message separator")
    yield _mbox_message(content[start:], ordinal)


def _mbox_message(raw: bytes, ordinal: int) -> dict:
    return {"record": "child", "ordinal": ordinal, "content": unquoted(raw)}


def unquoted(message: bytes) -> bytes:
    """A mailbox message with one ``>`` taken off its quoted separator lines."""
    return _QUOTED.sub(rb"\1", message) if b">From " in message else message


def open_mail(content: bytes, types: list[str], limits: Limits) -> Iterator[dict]:
    """A message parsed once: one row with its headers and parts, and one row per attachment."""
    headers, parts, attachments = parse_mail(content)
    if {"text", "metadata", "pdf"} & set(types):
        yield {"record": "message", "headers": headers, "parts": parts}
    if "embedded" in types:
        for ordinal, (part, data) in enumerate(attachments):
            where = {"ordinal": ordinal, "child_name": part["name"]}
            if part["ctype"] is None:
                yield error_of("no_content_type", "attachment without a content type", **where)
            else:
                decoded = None if part["charset"] in (None, "utf-8", "us-ascii") else part["text"]
                yield {"record": "child", "ctype": part["ctype"], "subtype": part["subtype"], "decoded": decoded, "content": data, **where}


def opened(opener: Opener, mimetype: str, content: bytes, types: list[str], limits: Limits) -> Iterator[dict]:
    """Rows of one container, large contents put away; whatever is wrong with its bytes ends as an error row."""
    try:
        for row in opener(content, types, limits):
            data = row.get("content")
            if data is not None and len(data) > limits.inline_bytes:
                is_mail = mimetype == MBOX or (row.get("ctype"), row.get("subtype")) == tuple(MAIL.split("/"))
                row = {**row, "content": None, **kept_content([data], limits.folder, limits.inline_bytes, is_mail=is_mail)}
            yield row
    except Exception as e:  # noqa: BLE001 - any parser fault on untrusted bytes
        yield error_of("bad_container", f"{type(e).__name__}: {e}")
