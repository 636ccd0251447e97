"""Binary files in the shared folder, by whatever store its address names."""

from __future__ import annotations

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def create(path: str):
    """A new file for sequential writing; its folder is made if need be."""
    store, name = _place(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    return store.open_output_stream(name, compression=None)


def open_input(path: str):
    """The file with random access."""
    store, name = _place(path)
    return store.open_input_file(name)


def open_stream(path: str):
    """The file for one sequential pass."""
    store, name = _place(path)
    return store.open_input_stream(name, compression=None)
