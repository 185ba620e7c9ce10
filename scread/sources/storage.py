"""Files by any path that Arrow's file systems know, in pieces that can be read from the middle.

A plain file falls into pieces of fixed size. A block-compressed gzip file (a member of at most 64 kB each,
its size in the header) falls into its members. Any other gzip file is a stream without pieces.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

from pyarrow import fs

PIECE = 65_536
WINDOW = 4 * 65_536  # a member is at most a quarter of it
PLAIN, BLOCKS, STREAM = "plain", "blocks", "stream"
GZIP_MAGIC = b"\x1f\x8b\x08"


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def open_input(path: str):
    system, inner = locate(path)
    return system.open_input_file(inner)


def size(path: str) -> int:
    system, inner = locate(path)
    return system.get_file_info(inner).size


def member_size(head: bytes) -> int | None:
    """Bytes of a block-compressed member from its first bytes; null for another gzip member."""
    if head[:4] != GZIP_MAGIC + b"\x04":
        return None
    extra, at = head[12 : 12 + int.from_bytes(head[10:12], "little")], 0
    while at + 4 <= len(extra):
        n = int.from_bytes(extra[at + 2 : at + 4], "little")
        if extra[at : at + 2] == b"BC" and n == 2:
            return int.from_bytes(extra[at + 4 : at + 6], "little") + 1
        at += 4 + n
    return None


def kind(path: str) -> str:
    with open_input(path) as f:
        head = f.read(1024)
    if head[:3] != GZIP_MAGIC:
        return PLAIN
    return STREAM if member_size(head) is None else BLOCKS


def first_piece(f, how: str, at: int) -> int:
    """Place of the first piece at or after a byte: of members, one whose successor is one too."""
    if how == PLAIN:
        return -(-at // PIECE) * PIECE
    if at == 0 or how == STREAM:
        return 0
    end = f.size()
    f.seek(at)
    window = f.read(WINDOW)
    found = window.find(GZIP_MAGIC)
    while found >= 0:
        n = member_size(window[found : found + 1024])
        if n is not None:
            after = window[found + n : found + n + 3]
            if at + found + n == end or after == GZIP_MAGIC:
                return at + found
        found = window.find(GZIP_MAGIC, found + 1)
    return end


def pieces(f, how: str, place: int) -> Iterator[tuple[int, bytes]]:
    """(place, decompressed bytes) of the pieces from ``place`` on, empty ones left out; a stream's all lie at 0."""
    if how == STREAM:
        f.seek(0)
        text = gzip.GzipFile(fileobj=f)
        while data := text.read(PIECE):
            yield 0, data
        return
    end = f.size()
    f.seek(place)
    while place < end:
        if how == PLAIN:
            data, n = f.read(PIECE), PIECE
        else:
            head = f.read(18)
            n = member_size(head)
            if n is None:  # further fields before the size
                head += f.read(1024)
                n = member_size(head)
                f.seek(place + len(head))
            raw = (head + f.read(n - len(head)))[:n]
            f.seek(place + n)
            data = zlib.decompress(raw[12 + int.from_bytes(raw[10:12], "little") : -8], -15)
        if data:
            yield place, data
        place += n


def cut(path: str, how: str, split_bytes: int) -> list[tuple[int, int]]:
    """Byte ranges of about ``split_bytes`` each, whole pieces of a plain file; a stream is one range."""
    total = size(path)
    if how == STREAM:
        return [(0, max(1, total))]
    step = max(1, split_bytes // PIECE) * PIECE if how == PLAIN else split_bytes
    return [(a, min(a + step, total)) for a in range(0, total, step)] or [(0, 1)]
