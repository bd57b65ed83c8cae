"""Binary files that tasks write and read in the shared folder, on any file system pyarrow knows."""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs


def _open(path: str):
    if "://" not in path:
        path = "file://" + (path.removeprefix("file:"))
    return fs.FileSystem.from_uri(path)


def delete_folder(path: str) -> None:
    system, inner = _open(path)
    with contextlib.suppress(FileNotFoundError):
        system.delete_dir(inner)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write under a name of its own, so that a second attempt of a task never meets the first one's file."""
    system, inner = _open(folder)
    system.create_dir(inner, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{inner}/{file}") as out:
        out.write(data)
    return f"{folder}/{file}"


def read_file(path: str, start: int = 0, size: int | None = None) -> bytes:
    system, inner = _open(path)
    with system.open_input_file(inner) as file:
        file.seek(start)
        return file.read(size) if size is not None else file.read()
