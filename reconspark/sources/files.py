"""Files by path or URI (local, HDFS, object stores as pyarrow knows them), so that executors open them themselves."""

from __future__ import annotations

import fnmatch
import posixpath

from pyarrow import NativeFile, fs


def _of(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path on it, and what stands before it in the URI."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, inner, path[: len(path) - len(inner)] if path.endswith(inner) else ""


def opened(path: str) -> NativeFile:
    """The file for reading at any place."""
    system, inner, _ = _of(path)
    return system.open_input_file(inner)


def size(path: str) -> int:
    """Bytes of a file."""
    system, inner, _ = _of(path)
    return system.get_file_info(inner).size


def matching(path: str) -> list[str]:
    """The file itself, the files of a folder, or those whose name matches the pattern of the last part; in name order."""
    head, name = posixpath.split(path)
    pattern = any(c in name for c in "*?[")
    system, inner, before = _of(head if pattern else path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        return []
    found = [f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File]
    return sorted(before + f for f in found if not pattern or fnmatch.fnmatchcase(posixpath.basename(f), name))
