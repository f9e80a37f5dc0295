"""Files that tasks write to and read from the shared folder, whatever store it is in."""

from __future__ import annotations

import uuid
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs


def unique_name(stem: str, partition: int, suffix: str) -> str:
    """A name that no other task attempt uses: only files that a finished attempt reports are read."""
    return f"{stem}-{partition:06d}-{uuid.uuid4().hex}{suffix}"


def create(uri: str) -> BinaryIO:
    """Open a new file for writing, making its folder."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path)


def open_random(uri: str) -> pa.NativeFile:
    """A file for random access: mapped into memory where it is local, so that arrays are views of it."""
    store, path = fs.FileSystem.from_uri(uri)
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def open_stream(uri: str) -> pa.NativeFile:
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_stream(path)
