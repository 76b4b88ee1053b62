"""Mail parsing: one message in, its headers and parts out. Everything after this works on native columns."""

from __future__ import annotations

import binascii
import email.header
import email.parser
import email.policy
import email.utils
import quopri
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docsift.schemas import PARSED_MAIL

# Canonical spelling of the standard header names, and what their values hold.
HEADER_KINDS = {
    "From": "addresses",
    "To": "addresses",
    "Cc": "addresses",
    "Bcc": "addresses",
    "Reply-To": "addresses",
    "Sender": "addresses",
    "Resent-From": "addresses",
    "Resent-To": "addresses",
    "Resent-Cc": "addresses",
    "Resent-Bcc": "addresses",
    "Resent-Sender": "addresses",
    "List-Archive": "addresses",
    "List-Help": "addresses",
    "List-ID": "addresses",
    "List-Owner": "addresses",
    "List-Post": "addresses",
    "List-Subscribe": "addresses",
    "List-Unsubscribe": "addresses",
    "Date": "date",
    "Resent-Date": "date",
    "Message-ID": "ids",
    "Resent-Message-ID": "ids",
    "Content-ID": "ids",
    "In-Reply-To": "ids",
    "References": "ids",
    "Return-Path": "ids",
    "Keywords": "list",
    "Content-Language": "list",
    "Received": "received",
    "Content-Type": "content_type",
    "Content-Disposition": "content_type",
    "Subject": "text",
    "Comments": "text",
    "Content-Description": "text",
    "Content-Location": "text",
    "Content-Transfer-Encoding": "text",
    "MIME-Version": "text",
}
_CANONICAL = {name.lower(): name for name in HEADER_KINDS}
_BLANK_LINE = re.compile(rb"\r?\n\r?\n")
_MAX_NESTING = 100
_headers_of = email.parser.BytesHeaderParser(policy=email.policy.compat32).parsebytes


def parse_mail(raw: bytes) -> tuple[list[dict], list[dict], list[tuple[dict, bytes]]]:
    """Headers, parts in document order, and the attachments with their decoded bytes."""
    head, body = _split_entity(raw)
    parts: list[dict] = []
    contents: dict[int, bytes] = {}
    top = _walk(head, body, None, parts, contents)
    text_body: list[dict] | None = []
    html_body: list[dict] | None = []
    attachments: list[dict] = []
    _sort_parts([top], "mixed", False, html_body, text_body, attachments)
    for part in text_body:
        part["in_text_body"] = True
    for part in html_body:
        part["in_html_body"] = True
    for part in attachments:
        part["is_attachment"] = True
    attached = [(p, contents[p["part_id"]]) for p in parts if p["is_attachment"]]
    return [_header(name, value) for name, value in head.raw_items()], parts, attached


def _split_entity(raw: bytes):
    if raw.startswith((b"\n", b"\r\n")):
        head, body = b"", raw[raw.index(b"\n") + 1 :]
    else:
        blank = _BLANK_LINE.search(raw)
        head, body = (raw[: blank.start()], raw[blank.end() :]) if blank else (raw, b"")
    return _headers_of(head + b"\n\n"), body


def _walk(head, body: bytes, parent: int | None, parts: list[dict], contents: dict[int, bytes], depth: int = 0) -> dict:
    """Add an entity and all parts below it, and return it with its direct children."""
    declared = _text(head["Content-Type"]) if head["Content-Type"] is not None else None
    ctype, _, subtype = (declared or "").split(";")[0].strip().lower().partition("/")
    media = f"{ctype}/{subtype}" if declared else "text/plain"
    disposition = (_text(head["Content-Disposition"] or "")).split(";")[0].strip().lower()
    name = head.get_filename()
    part = {
        "part_id": len(parts),
        "parent": parent,
        "ctype": ctype or None,
        "subtype": subtype or None,
        "name": _decoded(name) if name else None,
        "is_attachment": False,
        "in_html_body": False,
        "in_text_body": False,
        "length": len(body),
        "text": None,
        "media": media,
        "charset": None,
        "detached": disposition == "attachment",
        "children": [],
    }
    parts.append(part)
    # A multipart below so many others is kept whole, as a part of its own.
    boundary = head.get_boundary() if ctype == "multipart" and depth < _MAX_NESTING else None
    if boundary:
        part["kind"] = "multipart"
        for piece in _pieces(body, boundary):
            child_head, child_body = _split_entity(piece)
            part["children"].append(_walk(child_head, child_body, part["part_id"], parts, contents, depth + 1))
        return part
    data = _transfer_decoded(body, _text(head["Content-Transfer-Encoding"] or "").strip().lower())
    contents[part["part_id"]] = data
    part["length"] = len(data)
    if media == "message/rfc822":
        part["kind"] = "message"
    elif ctype in ("", "text"):
        part["kind"] = "html" if media == "text/html" else "text"
        part["charset"] = head.get_content_charset()
        part["text"] = _charset_decoded(data, part["charset"])
    else:
        part["kind"] = "inline" if disposition == "inline" else "binary"
    return part


def _pieces(body: bytes, boundary: str) -> list[bytes]:
    line = re.compile(
        rb"(?:\A|\r?\n)--" + re.escape(boundary.encode("utf-8", "surrogateescape")) + rb"(--)?[ \t]*(?:\r?\n|\Z)"
    )
    pieces, start, at = [], None, 0
    while found := line.search(body, at):
        if start is not None:
            pieces.append(body[start : max(start, found.start())])
        if found.group(1):
            return pieces
        start = found.end()
        # An empty part has its two delimiters back to back, so the line end is looked at again.
        at = start - 1 if body[start - 1 : start] == b"\n" else start
    if start is not None:
        pieces.append(body[start:])
    return pieces


def _transfer_decoded(body: bytes, encoding: str) -> bytes:
    if encoding == "base64":
        try:
            return binascii.a2b_base64(body)
        except binascii.Error:
            clean = re.sub(rb"[^A-Za-z0-9+/]", b"", body)
            return binascii.a2b_base64(clean[: len(clean) - (len(clean) % 4 == 1)] + b"==")
    if encoding == "quoted-printable":
        return quopri.decodestring(body)
    return body


def _charset_decoded(data: bytes, charset: str | None) -> str:
    if charset in (None, "us-ascii", "ascii"):
        charset = "utf-8"
    try:
        return data.decode(charset, "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def _sort_parts(parts, container, in_alternative, html_body, text_body, attachments):
    """Which parts are bodies and which are attachments, by the rules of RFC 8621 section 4.1.4."""
    n_html = -1 if html_body is None else len(html_body)
    n_text = -1 if text_body is None else len(text_body)
    for i, part in enumerate(parts):
        media = part["media"]
        if part["children"] or part["kind"] == "multipart":
            kind = media.partition("/")[2]
            alternative = in_alternative or kind == "alternative"
            _sort_parts(part["children"], kind, alternative, html_body, text_body, attachments)
            continue
        is_media = media.startswith(("image/", "audio/", "video/"))
        first_or_shown = i == 0 or (container != "related" and (is_media or not part["name"]))
        if part["detached"] or not (is_media or media in ("text/plain", "text/html")) or not first_or_shown:
            attachments.append(part)
            continue
        if container == "alternative":
            target = {"text/plain": text_body, "text/html": html_body}.get(media, attachments)
            if target is not None:
                target.append(part)
            continue
        if in_alternative and media == "text/plain":
            html_body = None
        if in_alternative and media == "text/html":
            text_body = None
        if text_body is not None:
            text_body.append(part)
        if html_body is not None:
            html_body.append(part)
        if is_media and (text_body is None or html_body is None):
            attachments.append(part)
    if container == "alternative" and text_body is not None and html_body is not None:
        new_html, new_text = html_body[n_html:], text_body[n_text:]
        if new_html and not new_text:
            text_body.extend(new_html)
        elif new_text and not new_html:
            html_body.extend(new_text)


def _text(value) -> str:
    return str(value).encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def _decoded(value: str) -> str:
    """A header text with its encoded words resolved."""
    value = _text(value)
    if "=?" not in value:
        return value
    try:
        return str(email.header.make_header(email.header.decode_header(value)))
    except (LookupError, UnicodeError, email.errors.HeaderParseError, ValueError):
        return value


def _header(raw_name: str, value) -> dict:
    raw_name = _text(raw_name)
    name = _CANONICAL.get(raw_name.lower(), raw_name)
    kind = HEADER_KINDS.get(name, "text")
    text = re.sub(r"\r?\n[ \t]*", " ", _text(value)).strip()
    header = {"name": name, "raw_name": raw_name, "raw": text, "kind": kind, "text": text}
    if not text:
        header["kind"] = "empty"
    elif kind == "addresses":
        _read_addresses(header, text)
    elif kind == "ids":
        ids = re.findall(r"<\s*([^<>]*?)\s*>", text) or [text]
        header.update({"kind": "texts", "texts": ids} if len(ids) > 1 else {"kind": "text", "text": ids[0]})
    elif kind == "list":
        texts = [_decoded(t.strip()) for t in text.split(",")]
        header.update({"kind": "texts", "texts": texts} if len(texts) > 1 else {"kind": "text", "text": texts[0]})
    elif kind == "text":
        header["text"] = _decoded(text)
    return header


def _read_addresses(header: dict, text: str) -> None:
    quoted = re.sub(r'"(?:[^"\\]|\\.)*"|<[^>]*>', "", text)
    if ":" in quoted and ";" in quoted:
        parsed = email.policy.default.header_factory("To", text)
        header["groups"] = [
            {"name": g.display_name, "addresses": [_address(a.display_name, a.addr_spec) for a in g.addresses]}
            for g in parsed.groups
        ]
        header["kind"] = "groups"
        return
    pairs = email.utils.getaddresses([text])
    header["addresses"] = [_address(_decoded(name), address) for name, address in pairs if name or address]
    if not header["addresses"]:
        header["addresses"] = [_address("", text.strip("<>"))]


def _address(name: str | None, address: str | None) -> dict:
    return {"name": name or None, "address": address if address and address != "<>" else None}


@F.arrow_udf(PARSED_MAIL)
def parsed_mail(content: pa.Array) -> pa.Array:
    """``struct<headers, parts, error>`` of a mail, for use as a column; attached bytes are left out."""

    def parse(raw: bytes | None) -> dict | None:
        if raw is None:
            return None
        try:
            headers, parts, _ = parse_mail(raw)
            return {"headers": headers, "parts": parts, "error": None}
        except Exception as e:  # noqa: BLE001 - any parser fault on untrusted bytes
            return {"headers": None, "parts": None, "error": f"{type(e).__name__}: {e}"}

    kind = to_arrow_type(PARSED_MAIL)
    # pyarrow takes the named fields and leaves the parser's own ones.
    return pa.array([parse(value.as_py()) for value in content], kind)
