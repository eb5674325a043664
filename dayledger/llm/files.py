"""Files that tasks write to and read from a folder all executors share."""

from __future__ import annotations

from uuid import uuid4

import pyarrow.fs as fs


def write_file(path: str, data: bytes) -> None:
    """Write a whole file and then move it to its name: a task that runs again replaces it."""
    system, at = fs.FileSystem.from_uri(_uri(path))
    part = f"{at}.{uuid4().hex}.part"
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, at)


def open_file(path: str):
    """The file as a binary stream that can seek."""
    system, at = fs.FileSystem.from_uri(_uri(path))
    return system.open_input_file(at)


def _uri(path: str) -> str:
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return path if "://" in path else f"file://{path}"
