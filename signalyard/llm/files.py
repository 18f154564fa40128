"""Files in any store that Arrow reads (local, HDFS, S3, ...), by URI."""

from __future__ import annotations

import posixpath

import pyarrow.fs as pafs
from pyspark import TaskContext


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def uri(path: str) -> str:
    """file:/a (as Hadoop writes it) as file:///a."""
    return "file://" + path[len("file:"):] if path.startswith("file:/") and not path.startswith("file://") else path


class WholeFile:
    """A file that appears under its name only once it is complete; a task that
    is run again replaces it with the same bytes."""

    def __init__(self, path: str):
        self._fs, self._path = open_store(path)
        context = TaskContext.get()
        self._part = f"{self._path}.{context.taskAttemptId() if context else 0}.part"
        self._fs.create_dir(posixpath.dirname(self._path), recursive=True)
        self._out = self._fs.open_output_stream(self._part)

    def write(self, data: bytes) -> None:
        self._out.write(data)

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._part, self._path)
