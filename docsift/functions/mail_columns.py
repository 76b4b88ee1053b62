"""Columns over parsed mails: address formatting, HTML rendering, text, metadata. All native."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions.dates import mail_date_iso, mail_date_utc
from docsift.functions.text import escape_html, html_to_text, paragraphs
from docsift.schemas import MAIL

# The plain-text headers a rendered mail shows. Other kinds of header are shown whatever their name.
SHOWN_TEXT_HEADERS = ["Date", "From", "To", "CC", "BCC", "Subject"]


def format_name_address(name: Column, address: Column) -> Column:
    """``Name <address>``, ``Name``, ``<address>`` or NULL."""
    bracketed = F.concat(F.lit("<"), address, F.lit(">"))
    return F.when(name.isNotNull() & address.isNotNull(), F.concat_ws(" ", name, bracketed)).otherwise(
        F.coalesce(name, bracketed)
    )


def _joined(texts: Column) -> Column:
    # array_join leaves NULL elements out.
    return F.nullif(F.array_join(texts, ", "), F.lit(""))


def format_addresses(addresses: Column) -> Column:
    return _joined(F.transform(addresses, lambda a: format_name_address(a["name"], a["address"])))


def format_groups(groups: Column) -> Column:
    return _joined(F.transform(groups, format_group))


def format_group(group: Column) -> Column:
    return format_name_address(group["name"], format_addresses(group["addresses"]))


def format_text_list(texts: Column) -> Column:
    return _joined(F.filter(texts, lambda t: t != ""))


def header(headers: Column, name: str) -> Column:
    """The last header of a name, as a struct; NULL when there is none."""
    return F.try_element_at(F.filter(headers, lambda h: h["name"] == name), F.lit(-1))


def header_value(headers: Column, name: str) -> Column:
    """Display text of a header, addresses and groups formatted."""
    h = header(headers, name)
    return (
        F.when(h["kind"] == "addresses", format_addresses(h["addresses"]))
        .when(h["kind"] == "groups", format_groups(h["groups"]))
        .when(h["kind"] == "texts", format_text_list(h["texts"]))
        .when(h["kind"] != "empty", h["text"])
    )


@dataclass(frozen=True)
class Renderer:
    """How a mail is shown. Each hook maps a header struct or a part struct to text; a NULL header is left out."""

    header_addresses: Callable[[Column], Column] = lambda h: _line(h, format_addresses(h["addresses"]))
    header_groups: Callable[[Column], Column] = lambda h: _line(h, format_groups(h["groups"]))
    header_text: Callable[[Column], Column] = lambda h: F.when(
        h["name"].isin(*SHOWN_TEXT_HEADERS), _line(h, h["text"])
    )
    header_texts: Callable[[Column], Column] = lambda h: _line(h, format_text_list(h["texts"]))
    header_date: Callable[[Column], Column] = lambda h: _line(h, mail_date_iso(h["raw"]))
    header_received: Callable[[Column], Column] = lambda h: F.lit(None).cast("string")
    header_content_type: Callable[[Column], Column] = lambda h: F.lit(None).cast("string")
    part_text: Callable[[Column], Column] = lambda p: paragraphs(p["text"])
    part_html: Callable[[Column], Column] = lambda p: p["text"]
    # Parts without text; a NULL part is left out of the page.
    part_inline: Callable[[Column], Column] = lambda p: F.lit(None).cast("string")
    part_binary: Callable[[Column], Column] = lambda p: F.lit(None).cast("string")
    part_message: Callable[[Column], Column] = lambda p: F.lit(None).cast("string")
    header_prefix: str = "<div>"
    header_suffix: str = "</div>"
    separator: str = "<br>\n"
    part_prefix: str = "<div>"
    part_suffix: str = "</div>"


def _line(h: Column, value: Column) -> Column:
    return F.concat(F.lit("<b>"), h["name"], F.lit("</b>: "), escape_html(value))


HTML = Renderer()


def bodies(parts: Column) -> Column:
    """Body parts to show: the HTML bodies if there are any, else the text bodies."""
    html = F.filter(parts, lambda p: p["in_html_body"])
    return F.when(F.size(html) > 0, html).otherwise(F.filter(parts, lambda p: p["in_text_body"]))


def render(headers: Column, parts: Column, renderer: Renderer = HTML) -> Column:
    """A mail as one document: header lines, a separator, then its bodies."""

    def header_line(h: Column) -> Column:
        shown = (
            F.when(h["kind"] == "addresses", renderer.header_addresses(h))
            .when(h["kind"] == "groups", renderer.header_groups(h))
            .when(h["kind"] == "texts", renderer.header_texts(h))
            .when(h["kind"] == "date", renderer.header_date(h))
            .when(h["kind"] == "received", renderer.header_received(h))
            .when(h["kind"] == "content_type", renderer.header_content_type(h))
            .when(h["kind"] == "text", renderer.header_text(h))
        )
        return F.concat(F.lit(renderer.header_prefix), shown, F.lit(renderer.header_suffix + "\n"))

    def body(p: Column) -> Column:
        shown = (
            F.when(p["kind"] == "html", F.coalesce(renderer.part_html(p), F.lit("")))
            .when(p["kind"] == "text", F.coalesce(renderer.part_text(p), F.lit("")))
            .when(p["kind"] == "inline", renderer.part_inline(p))
            .when(p["kind"] == "message", renderer.part_message(p))
            .otherwise(renderer.part_binary(p))
        )
        # array_join leaves NULL parts out.
        return F.concat(F.lit(renderer.part_prefix), shown, F.lit(renderer.part_suffix))

    return F.concat(
        F.array_join(F.transform(headers, header_line), ""),
        F.lit(renderer.separator),
        F.array_join(F.transform(bodies(parts), body), ""),
    )


def body_text(parts: Column) -> Column:
    """The text bodies of a mail without markup; attachments are left out."""
    texts = F.transform(
        F.filter(parts, lambda p: p["in_text_body"] & p["text"].isNotNull()),
        lambda p: F.when(p["kind"] == "html", html_to_text(p["text"])).otherwise(p["text"]),
    )
    return F.array_join(texts, "\n")


def extracted_text(parts: Column) -> Column:
    return F.concat(body_text(parts), F.lit("\n\n"))


def attachment_names(parts: Column) -> Column:
    return F.transform(F.filter(parts, lambda p: p["is_attachment"]), lambda p: p["name"])


# Metadata keys of the headers that have their own, and how a header becomes the value.
_ADDRESS_KEYS = {"Message-From": "From", "Message-To": "To", "Message-Cc": "Cc", "Message-Bcc": "Bcc"}
_MAPPED = ["Date", "From", "To", "Cc", "Bcc", "Subject"]


def mail_metadata(headers: Column) -> Column:
    """``map<string, array<string>>`` of a mail's metadata."""
    subject = header_value(headers, "Subject")
    sender = header_value(headers, "From")
    # Addresses are shown here as in load files: a bare address has no brackets.
    bare = lambda v: F.regexp_replace(v, r"^<([^<>]*)>$", "$1")
    first = F.get(header(headers, "From")["addresses"], F.lit(0))
    created = F.date_format(mail_date_utc(header(headers, "Date")["raw"]), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    single = {
        "Content-Type": F.lit(MAIL),
        "dc:subject": subject,
        "dc:title": subject,
        "dc:creator": bare(sender),
        "Message:From-Email": first["address"],
        "Message:From-Name": first["name"],
        "dcterms:created": created,
        **{key: bare(header_value(headers, name)) for key, name in _ADDRESS_KEYS.items()},
    }
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.array(v).alias("value")) for k, v in single.items()])
    entries = F.filter(entries, lambda e: F.get(e["value"], F.lit(0)).isNotNull())
    rest = F.filter(headers, lambda h: ~h["name"].isin(*_MAPPED))
    raw_entries = F.transform(
        F.array_distinct(F.transform(rest, lambda h: h["raw_name"])),
        lambda n: F.struct(
            F.concat(F.lit("Message:Raw-Header:"), n).alias("key"),
            F.transform(F.filter(rest, lambda h: h["raw_name"] == n), lambda h: h["raw"]).alias("value"),
        ),
    )
    return F.map_from_entries(F.concat(entries, raw_entries))


def file_metadata(mimetype: Column) -> Column:
    """Metadata of a file no parser looks into."""
    return F.create_map(F.lit("Content-Type"), F.array(mimetype))


def metadata_json(metadata: Column) -> Column:
    """Flat JSON object: one value as a string, several as an array of strings."""
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", "$1")
    entries = F.transform(
        F.map_entries(metadata),
        lambda e: F.concat(
            quoted(e["key"]),
            F.lit(":"),
            F.when(F.size(e["value"]) == 1, quoted(F.get(e["value"], F.lit(0)))).otherwise(F.to_json(e["value"])),
        ),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def metadata_key(metadata: Column, key: str) -> Column:
    """One string value of a metadata JSON object; NULL when it is missing or not a string."""
    value = F.try_variant_get(F.try_parse_json(metadata), f"$['{key}']", "string")
    is_string = F.schema_of_variant(F.try_variant_get(F.try_parse_json(metadata), f"$['{key}']", "variant")) == "STRING"
    return F.when(is_string, value)


def metadata_keys(metadata: Column) -> Column:
    return F.map_keys(F.from_json(metadata, "map<string,string>"))
