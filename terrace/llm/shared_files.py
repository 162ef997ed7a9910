"""Files that tasks write in the folder that driver and executors share."""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and the path there; a plain path is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file under a name of its own for each attempt of a task, complete when closed.

    A task that runs twice leaves two files; the one named in the rows of the attempt that counted is used.
    """

    def __init__(self, folder: str, suffix: str):
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.uri = f"{folder.rstrip('/')}/{self.name}"
        files, path = locate(self.uri)
        files.create_dir(posixpath.dirname(path), recursive=True)
        self._out = files.open_output_stream(path)
        self.written = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.written += len(data)

    def close(self) -> None:
        self._out.close()


def open_file(uri: str):
    files, path = locate(uri)
    return files.open_input_stream(path)
