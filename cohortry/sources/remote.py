"""Files by path or URI, for readers that seek within them; the same calls on the driver and in tasks."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs

#: Bytes that are fetched at once when a reader asks for a few.
FETCH = 1 << 20


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and the path in it; a path without a scheme is local."""
    path = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if re.match(r"^[a-z0-9+.-]+://", path) else (pafs.LocalFileSystem(), path)


def files(path: str, suffix: str) -> list[str]:
    """The file itself, or the files under a folder whose names end in ``suffix``, in order; hidden ones are left out."""
    system, inside = located(path)
    info = system.get_file_info(inside)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type != pafs.FileType.Directory:
        raise FileNotFoundError(path)
    found = [i.path for i in system.get_file_info(pafs.FileSelector(inside, recursive=True)) if i.type == pafs.FileType.File and i.path.endswith(suffix)]
    root = path.rstrip("/")
    below = sorted(posixpath.relpath(p, inside.rstrip("/")) for p in found)
    return [f"{root}/{p}" for p in below if not any(part.startswith(("_", ".")) for part in p.split("/"))]


def folders(path: str) -> list[str]:
    """Names of the folders right below a folder."""
    system, inside = located(path)
    return sorted(i.base_name for i in system.get_file_info(pafs.FileSelector(inside)) if i.type == pafs.FileType.Directory)


def exists(path: str, folder: bool = False) -> bool:
    """Whether there is a file, or a folder, of that path."""
    system, inside = located(path)
    return system.get_file_info(inside).type == (pafs.FileType.Directory if folder else pafs.FileType.File)


class Seekable:
    """A file that is read by place; neighbouring small reads share one fetch."""

    def __init__(self, handle):
        self.handle, self.size, self.start, self.buffer = handle, handle.size(), 0, b""

    def read(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, fewer at the end of the file."""
        if not (self.start <= at and at + n <= self.start + len(self.buffer)):
            self.start, self.buffer = at, self.handle.read_at(max(0, min(max(n, FETCH), self.size - at)), at) if at < self.size else b""
        return self.buffer[at - self.start : at - self.start + n]


@contextmanager
def opened(path: str) -> Iterator[Seekable]:
    system, inside = located(path)
    with system.open_input_file(inside) as handle:
        yield Seekable(handle)


def whole(path: str) -> bytes:
    """All bytes of a small file."""
    system, inside = located(path)
    with system.open_input_stream(inside) as handle:
        return handle.read()


def put(path: str, data: bytes) -> None:
    system, inside = located(path)
    system.create_dir(posixpath.dirname(inside), recursive=True)
    with system.open_output_stream(inside) as handle:
        handle.write(data)


def move(path: str, to: str) -> None:
    system, inside = located(path)
    target = located(to)[1]
    system.create_dir(posixpath.dirname(target), recursive=True)
    system.move(inside, target)


def remove(path: str) -> None:
    """Deletes a file or a folder with all below it; one that is not there is fine."""
    system, inside = located(path)
    kind = system.get_file_info(inside).type
    if kind == pafs.FileType.Directory:
        system.delete_dir(inside)
    elif kind == pafs.FileType.File:
        system.delete_file(inside)
