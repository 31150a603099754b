"""Plain files on whatever file system the shared folder is on, from inside tasks."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file. ``Scratch`` names the file system of all its
    paths; one without a scheme is local."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def create(uri: str) -> pa.NativeFile:
    system, path = place(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def stream(uri: str) -> pa.NativeFile:
    system, path = place(uri)
    return system.open_input_stream(path, compression=None, buffer_size=1 << 20)


def mapped(uri: str) -> pa.Buffer:
    """A whole file as a buffer: memory-mapped where it is local, read elsewhere."""
    system, path = place(uri)
    if isinstance(system, fs.LocalFileSystem):
        with pa.memory_map(path) as source:
            return source.read_buffer()
    with system.open_input_file(path) as source:
        return source.read_buffer()


def remove(uri: str) -> None:
    system, path = place(uri)
    system.delete_file(path)
