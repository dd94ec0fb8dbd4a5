"""Whole files in the shared folder, read and written by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file://{path}")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes local URIs with one slash.
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return _place(path)


def write_bytes(path: str, data: bytes) -> None:
    """Write a file in one step: a task that runs twice, or dies half way, leaves either the whole file or none."""
    system, at = _open(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, at)


class Replacing:
    """An output stream that takes its file's name when it is closed without an error."""

    def __init__(self, path: str):
        self.system, self.at = _open(path)
        self.system.create_dir(self.at.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.at}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.system.open_output_stream(self.part)
        return self.out

    def __exit__(self, kind, value, trace):
        self.out.close()
        if kind is None:
            self.system.move(self.part, self.at)
        else:
            self.system.delete_file(self.part)


def read_bytes(path: str) -> bytes:
    system, at = _open(path)
    with system.open_input_stream(at) as source:
        return source.read()


def open_file(path: str):
    """A file that can seek."""
    system, at = _open(path)
    return system.open_input_file(at)
