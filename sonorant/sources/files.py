"""Files of any file system, opened and written from tasks and the driver alike."""

from __future__ import annotations

import uuid

from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it: a URI names its own, any other path is local."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def open_input(path: str):
    """A seekable file; a missing one raises FileNotFoundError."""
    system, inner = place(path)
    return system.open_input_file(inner)


def exists(path: str) -> bool:
    system, inner = place(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def write_whole(path: str, content: bytes, overwrite: bool = True) -> bool:
    """The content under a name of this attempt, then renamed, so readers see all of it or nothing.

    Without `overwrite` a file that is there stays; the result says whether one was written.
    """
    if not overwrite and exists(path):
        return False
    system, inner = place(path)
    folder = inner.rpartition("/")[0]
    if folder:
        system.create_dir(folder, recursive=True)
    attempt = f"{inner}.{uuid.uuid4().hex}.part"
    try:
        with system.open_output_stream(attempt) as out:
            out.write(content)
        if not isinstance(system, fs.LocalFileSystem) and system.get_file_info(inner).type != fs.FileType.NotFound:
            system.delete_file(inner)  # elsewhere a rename does not replace
        system.move(attempt, inner)
    except BaseException:
        if system.get_file_info(attempt).type != fs.FileType.NotFound:
            system.delete_file(attempt)
        raise
    return True
