"""Files in the shared folder, opened from tasks through the folder's own file system."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from typing import BinaryIO

from pyarrow import fs


def split(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def normal(uri: str) -> str:
    """``file:/a`` as Hadoop writes it becomes ``file:///a``."""
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_whole(uri: str, write: Callable[[BinaryIO], None], attempt: str) -> int:
    """Write a file under a name of this attempt, then move it to its place. A task that runs again
    (or twice at a time) puts the same content there; readers never see half a file."""
    store, path = split(normal(uri))
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{attempt}"
    with store.open_output_stream(part, compression=None) as out:
        write(out)
    with suppress(FileNotFoundError):
        if store.get_file_info(path).type == fs.FileType.File and not isinstance(store, fs.LocalFileSystem):
            store.delete_file(path)  # a local move replaces, others may not
    store.move(part, path)
    return store.get_file_info(path).size


def read_whole(uri: str) -> bytes:
    store, path = split(normal(uri))
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def open_at(uri: str):
    """A file that can be read at offsets."""
    store, path = split(normal(uri))
    return store.open_input_file(path)


def open_stream(uri: str):
    store, path = split(normal(uri))
    return store.open_input_stream(path, compression=None)
