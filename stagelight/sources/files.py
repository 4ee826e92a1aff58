"""Files for Python data sources: any file system that Arrow opens by URI, and local paths."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """A file system and the path in it. Hadoop's file:/x is file:///x."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def listed(files: fs.FileSystem, folder: str, recursive: bool = False) -> list[fs.FileInfo]:
    """Files of a folder by path, none if it is not there; names that begin with . or _ are passed over, as Spark does."""
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))
    return sorted((f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path)


def replaced(files: fs.FileSystem, path: str, content: bytes) -> None:
    """Writes a file beside its place and moves it there, so that a reader sees the old one or the new one."""
    beside = f"{path.rpartition('/')[0]}/_{path.rpartition('/')[2]}.new"
    with files.open_output_stream(beside) as f:
        f.write(content)
    files.move(beside, path)


def given_back() -> None:
    """What Arrow and the system's library hold without use goes back: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every system's library has it
    if trim is not None:
        trim(0)
