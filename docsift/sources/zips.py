"""Zip archives by position: the directory read once, in a stream, and entries read at their own place.

Formats are those of the published zip specification; numbers are little-endian.
"""

from __future__ import annotations

import bz2
import lzma
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zipfile import BadZipFile

# Reads up to so many bytes at a place.
Reader = Callable[[int, int], bytes]

# Signatures and sizes of the records' fixed parts.
END, END_64, LOCATOR_64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, LOCATOR_SIZE, END_64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
STORED, DEFLATED, BZIP2, LZMA = 0, 8, 12, 14
_MANY_16, _MANY_32 = 0xFFFF, 0xFFFFFFFF

READ_BYTES = 1 << 20


@dataclass(frozen=True)
class Entry:
    """An entry as the directory tells it, and how many compressed bytes stand before it in the directory's order."""

    ordinal: int
    name: str
    method: int
    flags: int
    crc: int
    compressed: int
    size: int
    offset: int
    before: int


def entries(read: Reader, length: int) -> Iterator[Entry]:
    """The directory's entries one after the other; only a part of the directory is held."""
    start, size, shift = _directory(read, length)
    held, at, end, ordinal, before = b"", start, start + size, 0, 0
    while at < end or held:
        while len(held) < CENTRAL_SIZE and at < end:
            held, at = _more(read, held, at, end)
        if len(held) < CENTRAL_SIZE:
            raise BadZipFile("Truncated central directory")
        if held[:4] != CENTRAL:
            raise BadZipFile("Bad magic number for central directory")
        flags, method, _, _, crc, compressed, full, n, extra, comment = struct.unpack("<HHHHLLLHHH", held[8:34])
        (offset,) = struct.unpack("<L", held[42:46])
        whole = CENTRAL_SIZE + n + extra + comment
        while len(held) < whole and at < end:
            held, at = _more(read, held, at, end)
        if len(held) < whole:
            raise BadZipFile("Truncated central directory")
        name = held[CENTRAL_SIZE : CENTRAL_SIZE + n]
        more = held[CENTRAL_SIZE + n : CENTRAL_SIZE + n + extra]
        full, compressed, offset = _sizes_64(more, full, compressed, offset)
        yield Entry(ordinal, name.decode("utf-8" if flags & 0x800 else "cp437"), method, flags, crc, compressed, full, offset + shift, before)
        ordinal, before, held = ordinal + 1, before + compressed, held[whole:]


def _more(read: Reader, held: bytes, at: int, end: int) -> tuple[bytes, int]:
    got = read(at, min(READ_BYTES, end - at))
    if not got:
        raise BadZipFile("Truncated central directory")
    return held + got, at + len(got)


def _directory(read: Reader, length: int) -> tuple[int, int, int]:
    """Where the directory begins, its size, and by how much all places are shifted by what stands before the archive."""
    tail_at = max(0, length - END_SIZE - _MANY_16)
    tail = read(tail_at, length - tail_at) if length else b""
    # The record is looked for without a comment first, then from the end.
    at = len(tail) - END_SIZE
    if at < 0 or tail[at : at + 4] != END or tail[-2:] != b"\0\0":
        at = tail.rfind(END)
    if at < 0 or len(tail) - at < END_SIZE:
        raise BadZipFile("File is not a zip file")
    size, offset = struct.unpack("<LL", tail[at + 12 : at + 20])
    place = tail_at + at
    end = place
    locator = read(place - LOCATOR_SIZE, LOCATOR_SIZE) if place >= LOCATOR_SIZE else b""
    if locator[:4] == LOCATOR_64 and place >= LOCATOR_SIZE + END_64_SIZE:
        record = read(place - LOCATOR_SIZE - END_64_SIZE, END_64_SIZE)
        if record[:4] == END_64:
            size, offset = struct.unpack("<QQ", record[40:56])
            end = place - LOCATOR_SIZE - END_64_SIZE
    start = end - size
    if start < 0:
        raise BadZipFile("Bad offset for central directory")
    return start, size, start - offset


def _sizes_64(extra: bytes, full: int, compressed: int, offset: int) -> tuple[int, int, int]:
    """Sizes and place, taken from the 64-bit field where the short ones are used up."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at : at + 4])
        if at + 4 + n > len(extra):
            raise BadZipFile("Corrupt extra field")
        if kind == 1:
            values = extra[at + 4 : at + 4 + n]
            found = []
            for value in (full, compressed, offset):
                if value == _MANY_32 and len(values) >= 8:
                    value, values = int.from_bytes(values[:8], "little"), values[8:]
                elif value == _MANY_32:
                    raise BadZipFile("Corrupt zip64 extra field")
                found.append(value)
            full, compressed, offset = found
        at += 4 + n
    return full, compressed, offset


def content_of(read: Reader, entry: Entry) -> Iterator[bytes]:
    """The content of an entry in pieces, checked at its end; no more than a piece is held, whatever its size."""
    head = read(entry.offset, LOCAL_SIZE)
    if len(head) < LOCAL_SIZE or head[:4] != LOCAL:
        raise BadZipFile("Bad magic number for file header")
    if entry.flags & 1:
        raise BadZipFile(f"File {entry.name!r} is encrypted, password required for extraction")
    if entry.flags & 0x20:
        raise BadZipFile("compressed patched data (flag bit 5)")
    n, extra = struct.unpack("<HH", head[26:30])
    at = entry.offset + LOCAL_SIZE + n + extra
    crc, size = 0, 0
    for piece in _expanded(_raw(read, at, entry.compressed), entry):
        # A directory may understate a size; what it says is what there is.
        piece = piece[: entry.size - size]
        crc, size = zlib.crc32(piece, crc), size + len(piece)
        if piece:
            yield piece
    if size < entry.size:
        raise BadZipFile("Compressed data ended early")
    if crc != entry.crc:
        raise BadZipFile(f"Bad CRC-32 for file {entry.name!r}")


def _raw(read: Reader, at: int, size: int) -> Iterator[bytes]:
    end = at + size
    while at < end:
        piece = read(at, min(READ_BYTES, end - at))
        if not piece:
            raise BadZipFile("Truncated entry")
        at += len(piece)
        yield piece


def _expanded(pieces: Iterator[bytes], entry: Entry) -> Iterator[bytes]:
    if entry.method == STORED:
        yield from pieces
    elif entry.method == DEFLATED:
        inflate = zlib.decompressobj(-15)
        for piece in pieces:
            while piece and not inflate.eof:
                yield inflate.decompress(piece, READ_BYTES)
                piece = inflate.unconsumed_tail
        yield inflate.flush()
    elif entry.method in (BZIP2, LZMA):
        yield from _by_blocks(pieces, entry)
    else:
        raise BadZipFile(f"compression type {entry.method}")


def _by_blocks(pieces: Iterator[bytes], entry: Entry) -> Iterator[bytes]:
    expand = bz2.BZ2Decompressor() if entry.method == BZIP2 else None
    held = b""
    for piece in pieces:
        if expand is None:
            # The stream begins with its version and the size and bytes of its properties.
            held += piece
            if len(held) < 4 or len(held) < 4 + int.from_bytes(held[2:4], "little"):
                continue
            n = int.from_bytes(held[2:4], "little")
            bits = held[4]
            if n < 5 or bits >= 225:
                raise BadZipFile("Bad properties of compressed data")
            options = {"id": lzma.FILTER_LZMA1, "lc": bits % 9, "lp": bits // 9 % 5, "pb": bits // 45, "dict_size": int.from_bytes(held[5:9], "little")}
            expand = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[options])
            piece = held[4 + n :]
        while not expand.eof:
            out = expand.decompress(piece, READ_BYTES)
            if out:
                yield out
            if expand.needs_input or not out:
                break
            piece = b""
