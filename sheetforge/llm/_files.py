"""Raw files in the shared folder, written and read by executors through Arrow's file systems."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder given as a URI or a local path."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder)


def new_name(folder: str, suffix: str) -> str:
    """A name that no other task and no other attempt of this task uses.

    A task reports the names it wrote with its result; files of lost attempts are reported by none and stay unread.
    """
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def writer(name: str):
    system, path = opened(name)
    return system.open_output_stream(path, compression=None)


def reader(name: str):
    system, path = opened(name)
    return system.open_input_file(path)
