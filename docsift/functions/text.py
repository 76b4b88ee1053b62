"""Text columns: decoding, cleaning, HTML escaping and HTML to text. All native."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def lossy_utf8(content: Column) -> Column:
    """Bytes as text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(content.cast("string"))


def text_of(content: Column) -> Column:
    """Bytes as text by their byte order mark, else as lossy UTF-8; marks are no part of the text."""
    starts = lambda mark: F.startswith(content, F.unhex(F.lit(mark)))
    rest = lambda n: F.substring(content, n + 1, F.octet_length(content))
    utf16 = F.decode(F.substring(content, 1, (F.octet_length(content) / 2).cast("int") * 2), "UTF-16")
    return F.when(starts("EFBBBF"), lossy_utf8(rest(3))).when(starts("FFFE") | starts("FEFF"), utf16).otherwise(lossy_utf8(content))


def clean_text(content: Column) -> Column:
    """Lossy UTF-8 without NUL characters and without white space at either end."""
    text = F.replace(lossy_utf8(content), F.lit("\0"), F.lit(""))
    return _stripped(text)


# The characters of Unicode's White_Space property.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _stripped(text: Column) -> Column:
    """The text without white space at either end, in time linear in its length."""
    return F.btrim(text, F.lit(_BLANKS))


def escape_html(text: Column) -> Column:
    """Escape text for HTML element content; quotes stay as they are."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def paragraphs(text: Column) -> Column:
    """One ``<p>`` element per line, an empty last line included."""
    # Escaping adds and removes no line feed, so the whole text is escaped once and the tags go in at the line ends.
    return F.concat(F.lit("<p>"), F.replace(escape_html(text), F.lit("\n"), F.lit("</p>\n<p>")), F.lit("</p>"))


_BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|"
    "main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML page: a line per block, tags removed, character references resolved."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    html = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    html = F.regexp_replace(html, rf"(?i)</?(?:{_BLOCKS})\b[^>]*>", "\n")
    html = F.regexp_replace(html, r"<[!/a-zA-Z][^>]*>", "")
    html = unescape_html(html)
    html = F.regexp_replace(html, r"[ \t\r\f]+", " ")
    html = F.regexp_replace(html, r" ?\n[ \n]*", "\n")
    return F.btrim(html, F.lit(" \t\n\x0b\x0c\r"))


def unescape_html(text: Column) -> Column:
    """Resolve named and numeric character references; unknown ones stay."""
    # A constant, folded into one literal when the plan is optimized.
    named = F.from_json(F.lit(json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})), "map<string,string>")

    def resolve(piece: Column) -> Column:
        ref = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        code = F.when(ref.rlike("^#[xX]"), F.conv(F.substr(ref, F.lit(3)), 16, 10)).when(
            ref.startswith("#"), F.substr(ref, F.lit(2))
        )
        code = code.cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
        char = F.when(valid, F.decode(utf32, "UTF-32")).when(code.isNull(), F.try_element_at(named, ref))
        rest = F.substr(piece, F.length(ref) + F.lit(2))
        return F.when((ref != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))

    # The text before the first ampersand stays; every later piece begins with what follows one.
    pieces = F.transform(F.split(text, "&", -1), lambda piece, i: F.when(i == 0, piece).otherwise(resolve(piece)))
    return F.array_join(pieces, "")
