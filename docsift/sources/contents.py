"""Contents of any size: kept in a row while they are small, else as a file in the shared folder, and looked at in one pass.

A content above a limit never exists as a value. Whoever produces it streams it into a file of its own and looks at it on
the way; its row then holds the place of the file. From there it is read like any input: by ranges, by many tasks.
"""

from __future__ import annotations

import codecs
import hashlib
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.functions.identity import BUFFER_BYTES
from docsift.functions.magic import HEAD_BYTES, magic_of
from docsift.schemas import MAIL, OCTETS
from docsift.stores import open_store

# Contents above this size are files of their own.
INLINE_BYTES = 256_000_000
READ_BYTES = 4 << 20

# A first header of these names makes a mail, if a second header follows; fixed values, as in ``functions.mime``.
_FIRST_HEADER = re.compile(
    rb"(?i)(?:message-id|date|from|to|cc|subject|received|return-path|mime-version|delivered-to|reply-to|x-[a-z0-9-]{1,60})\Z"
)
_NAME = re.compile(rb"[!-9;-~]+")
_MESSAGE_ID = re.compile(rb"(?i)\Amessage-id:[ \t]*(?:<([^<>\s]+)>|([^<>\s]+)[ \t]*\r?\Z)")
_ID_NAME = b"message-id:"
# A name that is longer than this is no header's, and an id that is longer is none.
_LONGEST_NAME, _LONGEST_ID = 128, 1 << 20


class _Headers:
    """The header block of a mail, line by line: whether it is one, and its Message-ID. Holds a line's beginning at most.

    With ``is_mail`` the id is looked for in any case, as in mails that are known to be one from elsewhere.
    """

    def __init__(self, is_mail: bool = False):
        self.known = is_mail
        self.line = bytearray()
        self.cut = False
        self.done = False
        self.mail = False
        self.first: bool | None = None
        self.second: bool | None = None
        self.id: bytes | None = None
        self.candidate: bytearray | None = None
        self.lines = 0
        self.id_done = False

    def feed(self, data: bytes) -> None:
        at = 0
        while at < len(data) and not self.done:
            end = data.find(b"\n", at)
            stop = len(data) if end < 0 else end
            room = _LONGEST_ID - len(self.line)
            self.line += data[at : min(stop, at + max(room, 0))]
            self.cut |= stop - at > room
            at = stop + 1
            if end >= 0:
                self._end_of_line()

    def finish(self) -> None:
        if not self.done and (self.line or self.lines == 0):
            self._end_of_line(last=True)
        self._take_id()
        self.done = True

    def _end_of_line(self, last: bool = False) -> None:
        line, cut = bytes(self.line), self.cut
        self.line, self.cut = bytearray(), False
        # An empty line ends the block. One with a carriage return ends it for the id, but not for the type.
        if not line and not last:
            self._take_id()
            self.done = True
            return
        if line == b"\r":
            self._take_id()
            self.id_done = True
        folded = self.lines > 0 and line[:1] in (b" ", b"\t")
        if not folded:
            self._name(line)
        if not self.id_done:
            text = line[:-1] if line.endswith(b"\r") and not last else line
            if folded:
                if self.candidate is not None:
                    self.candidate += b" " + text[1:]
            else:
                self._take_id()
                if text[: len(_ID_NAME)].lower() == _ID_NAME and not cut:
                    self.candidate = bytearray(text)
            if self.candidate is not None and (cut or len(self.candidate) > _LONGEST_ID):
                self.candidate = None
        self.lines += 1
        if not self.known and (self.first is False or self.second is False):
            self.done = True

    def _name(self, line: bytes) -> None:
        if self.first is None:
            colon = line.find(b":", 0, _LONGEST_NAME)
            self.first = colon > 0 and _FIRST_HEADER.match(line[:colon]) is not None
        elif self.second is None:
            name = _NAME.match(line)
            self.second = name is not None and line[name.end() : name.end() + 1] == b":"
            self.mail = bool(self.first and self.second)

    def _take_id(self) -> None:
        if self.candidate is not None:
            found = _MESSAGE_ID.match(self.candidate)
            if found:
                self.id = found[1] or found[2]
            self.candidate = None


class _HtmlHead:
    """Whether a text begins with an HTML tag, white space aside."""

    _SPACE = b" \t\n\x0b\x0c\r"
    _START = re.compile(rb"(?i)(?:<!doctype +html|<html)(?![A-Za-z0-9_])")

    def __init__(self):
        self.kept = bytearray()
        self.full = False

    def feed(self, data: bytes) -> None:
        if self.full:
            return
        # Runs of white space count as one space; a bounded head is kept.
        if not self.kept:
            data = data.lstrip(self._SPACE)
        for at in range(0, len(data), 1024):
            for piece in re.split(rb"([ \t-\r]+)", data[at : at + 1024]):
                blank = piece[:1] and piece[0] in self._SPACE
                self.kept += (b"" if self.kept.endswith(b" ") else b" ") if blank else piece
            if len(self.kept) > 64:
                self.full = True
                return

    def found(self) -> bool:
        return self._START.match(bytes(self.kept)) is not None


@dataclass(frozen=True)
class Look:
    """What one pass over a content tells: its length, hashes, and type as far as its bytes tell it."""

    length: int
    checksum: str | None
    mail_checksum: str | None
    magic: str | None
    plain: bool
    sha256: str
    md5: str


class Scanner:
    """Looks at a content piece by piece, in memory that does not grow with it."""

    def __init__(self, is_mail: bool = False):
        self.length = 0
        self.buffer, self.at, self.padded = bytearray(BUFFER_BYTES), 0, hashlib.md5()
        self.sha256, self.md5 = hashlib.sha256(), hashlib.md5()
        self.utf8, self.valid = codecs.getincrementaldecoder("utf-8")(), True
        self.head = b""
        self.headers, self.html = _Headers(is_mail), _HtmlHead()

    def feed(self, data: bytes) -> None:
        self.length += len(data)
        self.sha256.update(data)
        self.md5.update(data)
        at = 0
        while at < len(data):
            n = min(len(data) - at, BUFFER_BYTES - self.at)
            self.buffer[self.at : self.at + n] = data[at : at + n]
            self.at, at = self.at + n, at + n
            if self.at == BUFFER_BYTES:
                self.padded.update(self.buffer)
                self.at = 0
        if len(self.head) < HEAD_BYTES + 64:
            self.head += data[: HEAD_BYTES + 64 - len(self.head)]
        if self.valid:
            try:
                self.utf8.decode(data)
                self.valid = b"\0" not in data
            except UnicodeDecodeError:
                self.valid = False
        self.headers.feed(data)
        self.html.feed(data)

    def look(self, whole: bool = True) -> Look:
        if self.at:
            # The unused end of the buffer holds what the piece before left there.
            self.padded.update(self.buffer)
        if self.valid and whole:
            try:
                self.utf8.decode(b"", final=True)
            except UnicodeDecodeError:
                self.valid = False
        self.headers.finish()
        magic = magic_of(self.head)
        if magic is None and self.headers.mail:
            magic = MAIL
        if magic is None and self.html.found():
            magic = "text/html"
        mail = None
        if self.headers.id:
            mail = hashlib.md5(self.headers.id + bytes(max(0, BUFFER_BYTES - len(self.headers.id)))).hexdigest()
        plain = self.valid and self.length > 0
        return Look(self.length, self.padded.hexdigest(), mail, magic, plain, self.sha256.hexdigest(), self.md5.hexdigest())


class Digester:
    """Length and digests of a content in pieces, where its type and its checksum, which costs a whole buffer, are not asked for."""

    def __init__(self):
        self.length, self.sha256, self.md5 = 0, hashlib.sha256(), hashlib.md5()

    def feed(self, data: bytes) -> None:
        self.length += len(data)
        self.sha256.update(data)
        self.md5.update(data)

    def look(self) -> Look:
        return Look(self.length, None, None, None, False, self.sha256.hexdigest(), self.md5.hexdigest())


def looked_type(look: Column, by_name: Column | None = None) -> Column:
    """The type of a content by what a pass over it told, in the order that ``functions.mime.identify`` has."""
    steps = [look["magic"]] + ([] if by_name is None else [F.when(by_name != OCTETS, by_name)])
    return F.coalesce(*steps, F.when(look["plain"], F.lit("text/plain")), F.lit(OCTETS))


def looked_checksum(look: Column, mimetype: Column) -> Column:
    return F.when(mimetype == MAIL, F.coalesce(look["mail_checksum"], look["checksum"])).otherwise(look["checksum"])


class TooLarge(ValueError):
    """A content is longer than it may be."""


def kept_content(
    pieces: Iterable[bytes],
    folder: str | None,
    inline_bytes: int,
    most_bytes: int | None = None,
    is_mail: bool = False,
    digests_only: bool = False,
) -> dict:
    """``content`` if it is small, else ``location`` of a new file below ``folder`` and ``look``, of a content in pieces.

    Without a folder all is kept as a value. A content above ``most_bytes`` raises ``TooLarge``. With ``digests_only`` the
    look tells neither type nor checksum.
    """
    held, size, stream, name, scanner = [], 0, None, None, None
    try:
        for piece in pieces:
            size += len(piece)
            if most_bytes is not None and size > most_bytes:
                raise TooLarge(f"more than {most_bytes} bytes")
            if stream is not None:
                stream.write(piece)
                scanner.feed(piece)
                continue
            held.append(piece)
            if size > inline_bytes and folder is not None:
                name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
                store, path = open_store(name)
                store.create_dir(posixpath.dirname(path), recursive=True)
                stream, scanner = store.open_output_stream(path), Digester() if digests_only else Scanner(is_mail)
                for piece in held:
                    stream.write(piece)
                    scanner.feed(piece)
                held = []
    finally:
        if stream is not None:
            stream.close()
    if stream is None:
        return {"content": b"".join(held)}
    return {"location": name, "look": scanner.look().__dict__}


def read_pieces(location: str, start: int = 0, stop: int | None = None, step: int = READ_BYTES) -> Iterator[bytes]:
    """The bytes of a stored content from ``start`` to ``stop``, in pieces."""
    store, path = open_store(location)
    with store.open_input_file(path) as stream:
        stream.seek(start)
        left = None if stop is None else stop - start
        while left is None or left > 0:
            piece = stream.read(step if left is None else min(step, left))
            if not piece:
                return
            left = None if left is None else left - len(piece)
            yield piece


def look_at(location: str, is_mail: bool = False, stop: int | None = None) -> Look:
    """What a pass over a file tells, or over its first bytes."""
    scanner = Scanner(is_mail)
    for piece in read_pieces(location, 0, stop):
        scanner.feed(piece)
    return scanner.look(whole=stop is None or scanner.length < stop)


def decoded_pieces(pieces: Iterable[bytes]) -> Iterator[str]:
    """Text of a content in pieces: by its byte order mark, else UTF-8; what is malformed becomes U+FFFD."""
    decoder, head = None, b""
    for piece in pieces:
        if decoder is None:
            head += piece
            if len(head) < 3:
                continue
            decoder, piece = _decoder(head)
        yield decoder.decode(piece)
    if decoder is None:
        decoder, piece = _decoder(head)
        yield decoder.decode(piece)
    yield decoder.decode(b"", final=decoder.encoding == "utf-8")


class _Decoder:
    def __init__(self, encoding: str):
        self.encoding = encoding
        self._inner = codecs.getincrementaldecoder(encoding)("replace")

    def decode(self, data: bytes, final: bool = False) -> str:
        return self._inner.decode(data, final)


def _decoder(head: bytes) -> tuple[_Decoder, bytes]:
    if head.startswith(codecs.BOM_UTF8):
        return _Decoder("utf-8"), head[3:]
    if head.startswith(codecs.BOM_UTF16_LE):
        return _Decoder("utf-16-le"), head[2:]
    if head.startswith(codecs.BOM_UTF16_BE):
        return _Decoder("utf-16-be"), head[2:]
    return _Decoder("utf-8"), head
