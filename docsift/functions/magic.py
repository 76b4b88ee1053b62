"""Types told by bytes at fixed places: one table of rules, as native columns and for contents that pass in pieces."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.schemas import MBOX, ZIP

# Rules look no further than this.
HEAD_BYTES = 4096


@dataclass(frozen=True)
class At:
    """Bytes, in hexadecimal digits, at a place, or beginning anywhere up to ``until``. A dot stands for any digit."""

    place: int
    digits: str
    until: int | None = None

    @property
    def size(self) -> int:
        # A class of digits is one digit.
        return len(re.sub(r"\[[^]]*\]", ".", self.digits)) // 2

    def column(self, head: Column) -> Column:
        if self.until is not None:
            return F.contains(F.substring(head, self.place + 1, self.until - self.place + self.size), F.unhex(F.lit(self.digits)))
        there = F.substring(head, self.place + 1, self.size)
        return F.hex(there).rlike(f"^{self.digits}$") if "." in self.digits or "[" in self.digits else there == F.unhex(F.lit(self.digits))

    def found(self, head: bytes) -> bool:
        if self.until is not None:
            return bytes.fromhex(self.digits) in head[self.place : self.until + self.size]
        there = head[self.place : self.place + self.size]
        return re.fullmatch(self.digits, there.hex().upper()) is not None


def _text(place: int, text: str, until: int | None = None) -> At:
    return At(place, text.encode("latin-1").hex().upper(), until)


_PK = At(0, "504B0304")
_FIRST = 30
_OFFICE = "application/vnd.openxmlformats-officedocument"
_ODF = "application/vnd.oasis.opendocument"

# Signatures of common formats, from the most to the least specific. A zip's first entry has its name at
# byte 30, after which its content stands if it is stored.
RULES: list[tuple[str, tuple[At, ...]]] = [
    *((f"{_ODF}.{kind}", (_PK, _text(_FIRST, f"mimetype{_ODF}.{kind}"))) for kind in ("text-template", "text", "spreadsheet", "presentation", "graphics", "formula")),
    ("application/epub+zip", (_PK, _text(_FIRST, "mimetypeapplication/epub+zip"))),
    *(
        (f"{_OFFICE}.{kind}", (_PK, _text(_FIRST, first, _FIRST + 12), _text(_FIRST, folder, HEAD_BYTES)))
        for first in ("[Content_Types].xml", "_rels/", "docProps/")
        for folder, kind in (("word/", "wordprocessingml.document"), ("xl/", "spreadsheetml.sheet"), ("ppt/", "presentationml.presentation"))
    ),
    ("application/vnd.android.package-archive", (_PK, _text(_FIRST, "AndroidManifest.xml"))),
    ("application/x-java-archive", (_PK, _text(_FIRST, "META-INF/"))),
    (ZIP, (_PK,)),
    (ZIP, (At(0, "504B0506"),)),
    (MBOX, (_text(0, "From "),)),
    ("application/pdf", (_text(0, "%PDF-"),)),
    ("application/postscript", (_text(0, "%!PS-Adobe-"),)),
    ("application/rtf", (_text(0, "{\\rtf1"),)),
    ("image/png", (At(0, "89504E470D0A1A0A"),)),
    ("image/jpeg", (At(0, "FFD8FF"),)),
    ("image/gif", (_text(0, "GIF87a"),)),
    ("image/gif", (_text(0, "GIF89a"),)),
    ("image/tiff", (At(0, "49492A00"),)),
    ("image/tiff", (At(0, "4D4D002A"),)),
    ("image/bmp", (_text(0, "BM"), At(14, "..000000"))),
    ("image/webp", (_text(0, "RIFF"), _text(8, "WEBP"))),
    ("audio/x-wav", (_text(0, "RIFF"), _text(8, "WAVE"))),
    ("video/x-msvideo", (_text(0, "RIFF"), _text(8, "AVI "))),
    ("image/heif", (_text(4, "ftypheic"),)),
    ("video/quicktime", (_text(4, "ftypqt  "),)),
    ("video/mp4", (_text(4, "ftyp"),)),
    ("image/vnd.adobe.photoshop", (At(0, "384250530001"),)),
    ("image/vnd.djvu", (_text(0, "AT&TFORM"),)),
    ("image/x-icon", (At(0, "00000100..00"),)),
    ("application/dicom", (_text(128, "DICM"),)),
    ("audio/mpeg", (_text(0, "ID3"), At(3, "0[234].."))),
    ("audio/flac", (_text(0, "fLaC"),)),
    ("application/ogg", (At(0, "4F67675300"),)),
    ("video/x-matroska", (At(0, "1A45DFA3"),)),
    ("application/x-ole-storage", (At(0, "D0CF11E0A1B11AE1"),)),
    ("application/vnd.sqlite3", (At(0, "53514C69746520666F726D6174203300"),)),
    ("application/gzip", (At(0, "1F8B08"),)),
    ("application/x-bzip2", (_text(0, "BZh"), At(3, "3[1-9]"), At(4, "314159265359"))),
    ("application/x-bzip2", (_text(0, "BZh"), At(3, "3[1-9]"), At(4, "177245385090"))),
    ("application/x-xz", (At(0, "FD377A585A00"),)),
    ("application/zstd", (At(0, "28B52FFD"),)),
    ("application/x-7z-compressed", (At(0, "377ABCAF271C"),)),
    ("application/vnd.rar", (At(0, "526172211A07"),)),
    ("application/vnd.ms-cab-compressed", (At(0, "4D53434600000000"),)),
    ("application/x-tar", (At(257, "7573746172"), At(262, "[02]0[23]0"))),
    ("application/x-executable", (At(0, "7F454C46"),)),
    ("application/java-vm", (At(0, "CAFEBABE0000"),)),
    ("font/woff", (_text(0, "wOFF"), At(4, "00010000"))),
    ("font/woff2", (_text(0, "wOF2"), At(4, "00010000"))),
    ("application/vnd.ms-outlook", (At(0, "2142444E"),)),
]


def magic_type(content: Column) -> Column:
    """The type whose rule holds, NULL without one; a rule reads the few bytes it needs."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for mimetype, tests in RULES:
        holds = tests[0].column(content)
        for test in tests[1:]:
            holds = holds & test.column(content)
        found = found.when(holds, F.lit(mimetype))
    return found


def magic_of(head: bytes) -> str | None:
    """The same for the first ``HEAD_BYTES`` of a content."""
    return next((mimetype for mimetype, tests in RULES if all(t.found(head) for t in tests)), None)
