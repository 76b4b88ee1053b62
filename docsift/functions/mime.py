"""MIME type columns: identification by content and name, content type formatting. All native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions.magic import magic_type
from docsift.schemas import MAIL, OCTETS

_HEADER = (
    r"(?i)\A(?:message-id|date|from|to|cc|subject|received|return-path|mime-version|delivered-to|reply-to|"
    r"x-[a-z0-9-]{1,60}):"
)
# Nothing here is repeated as a group, which Java's matcher would do by recursion: folded lines are joined first.
_TWO_HEADERS = r"\A[!-9;-~]++:[^\n]*+\n[!-9;-~]++:"
_HTML_HEAD = r"(?i)\A(?:<!doctype\s++html|<html)\b"
# Bytes that a first header's name and a first tag may have.
_LONGEST_NAME, _LONGEST_TAG = 128, 1024


def format_content_type(ctype: Column, subtype: Column) -> Column:
    """``type/subtype``, or the type alone."""
    return F.concat_ws("/", ctype, subtype)


def unfolded(block: Column) -> Column:
    """A header block with each header on one line."""
    for fold in ("\n ", "\n\t"):
        block = F.replace(block, F.lit(fold), F.lit(" "))
    return block


def mime_by_magic(content: Column) -> Column:
    # A first header may be folded over any number of lines, so the second one is looked for in all of the header block.
    # Whether it ends with an empty line of one kind or the other, so that a long body is not decoded.
    block = F.substring_index(F.substring_index(content.cast("string"), "\n\n", 1), "\r\n\r\n", 1)
    block = F.decode(block.cast("binary"), "ISO-8859-1")
    is_mail = F.when(F.decode(F.substring(content, 1, _LONGEST_NAME), "ISO-8859-1").rlike(_HEADER), unfolded(block).rlike(_TWO_HEADERS))
    # The first tag is looked for behind leading white space, in a bounded slice.
    start = F.substring(F.ltrim(content.cast("string"), F.lit(" \t\n\x0b\x0c\r")).cast("binary"), 1, _LONGEST_TAG)
    is_html = F.decode(start, "ISO-8859-1").rlike(_HTML_HEAD)
    return F.coalesce(magic_type(content), F.when(is_mail, F.lit(MAIL)), F.when(is_html, F.lit("text/html")))


def mime_by_content(content: Column) -> Column:
    """``text/plain`` for valid UTF-8 without NUL bytes."""
    text = content.cast("string")
    plain = (F.octet_length(content) > 0) & F.is_valid_utf8(text) & ~F.contains(text, F.lit("\0"))
    return F.when(plain, F.lit("text/plain"))


def _unless(mimetype: Column, *refused: str) -> Column:
    return F.when(~mimetype.isin(*refused), mimetype)


def identify(content: Column, by_name: Column | None = None) -> Column:
    """MIME type of a file by the first step that knows it; NULL when none does.

    ``by_name`` is a type looked up from the file name (see ``sources.registry``), for files that have one.
    """
    steps = [_unless(mime_by_magic(content), OCTETS, "text/plain")]
    if by_name is not None:
        steps.append(_unless(by_name, OCTETS))
    steps.append(_unless(mime_by_content(content), OCTETS))
    return F.coalesce(*steps)


def identify_or_default(content: Column, by_name: Column | None = None) -> Column:
    return F.coalesce(identify(content, by_name), F.lit(OCTETS))
