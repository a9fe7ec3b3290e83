"""Blocked gzip: independent blocks of at most 64 KiB, so a file can be entered at any block.

A virtual offset is the place of a block in the file, shifted by 16 bits, plus a place in the block's content.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from cohortry.sources.remote import Seekable

MAGIC = b"\x1f\x8b\x08\x04"
LARGEST = 1 << 16
#: Content that a writer puts into one block, and the empty block that ends a file.
CONTENT = 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def block_length(file: Seekable, at: int) -> int | None:
    """Bytes of the block that begins at ``at``; None if none does."""
    head = file.read(at, 12)
    if len(head) < 12 or head[:4] != MAGIC:
        return None
    extra_length = struct.unpack_from("<H", head, 10)[0]
    extra, place = file.read(at + 12, extra_length), 0
    while place + 4 <= len(extra):
        kind, length = extra[place : place + 2], struct.unpack_from("<H", extra, place + 2)[0]
        if kind == b"BC" and length == 2 and place + 6 <= len(extra):
            return struct.unpack_from("<H", extra, place + 4)[0] + 1
        place += 4 + length
    return None


def block(file: Seekable, at: int) -> tuple[bytes, int]:
    """Content of the block at ``at``, and the place of the next."""
    length = block_length(file, at)
    if length is None:
        raise ValueError(f"no compressed block at byte {at}")
    data = file.read(at, length)
    if len(data) < length:
        raise ValueError(f"the block at byte {at} is cut short")
    start = 12 + struct.unpack_from("<H", data, 10)[0]
    return zlib.decompress(data[start:-8], wbits=-15), at + length


def next_block(file: Seekable, start: int) -> int:
    """The first place from ``start`` on where a block begins that another block or the end follows; the file's size if none."""
    at = start
    while at < file.size:
        window = file.read(at, 1 << 18)
        place = window.find(MAGIC)
        if place < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += place
        length = block_length(file, at)
        if length is not None and (at + length == file.size or block_length(file, at + length) is not None):
            return at
        at += 1
    return file.size


def content(file: Seekable, at: int) -> Iterator[tuple[int, bytes]]:
    """Place and content of each block from ``at`` to the end of the file."""
    while at < file.size:
        here = at
        data, at = block(file, here)
        yield here, data


class BlockWriter:
    """Content put into blocks, with the virtual offset of the next byte."""

    def __init__(self, level: int = 6):
        self.level, self.done, self.open, self.written = level, [], bytearray(), 0

    def tell(self) -> int:
        return self.written << 16 | len(self.open)

    def write(self, data: bytes) -> None:
        """Data of one record; it begins a block of its own unless it fits the open one."""
        if self.open and len(self.open) + len(data) > CONTENT:
            self.flush()
        for start in range(0, len(data), CONTENT):
            self.open += data[start : start + CONTENT]
            if len(self.open) >= CONTENT:
                self.flush()

    def flush(self) -> None:
        if not self.open:
            return
        packer = zlib.compressobj(self.level, zlib.DEFLATED, -15)
        body = packer.compress(bytes(self.open)) + packer.flush()
        head = MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        self.done.append(head + body + struct.pack("<II", zlib.crc32(self.open), len(self.open)))
        self.written += len(self.done[-1])
        self.open.clear()

    def finish(self) -> bytes:
        self.flush()
        return b"".join([*self.done, END])
