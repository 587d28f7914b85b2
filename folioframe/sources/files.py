"""Files of a run: local paths, and URIs that pyarrow's file systems open (hdfs, s3, gs, file, ...)."""

from __future__ import annotations

import os
import posixpath
from functools import cache

#: Stores whose objects appear whole, when their stream is closed.
_OBJECT_STORES = ("s3", "gcs", "abfs")


def is_uri(path: str) -> bool:
    return "://" in path


@cache
def _store(place: str):
    """One connection in each process."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(place)


def _opened(uri: str):
    """The store of a URI and the name there; names are taken as they are, without escapes, as Spark takes them."""
    scheme, rest = uri.split("://", 1)
    place, _, name = rest.partition("/")
    store, base = _store(f"{scheme}://{place}/")
    return store, f"{base.rstrip('/')}/{name}"


def read_file(path: str) -> bytes:
    if not is_uri(path):
        with open(path, "rb") as f:
            return f.read()
    store, name = _opened(path)
    with store.open_input_file(name) as f:
        return f.read()


def write_file(path: str, data: bytes) -> None:
    """A reader sees the old file or the whole new one; folders are made."""
    if not is_uri(path):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.part", "wb") as f:
            f.write(data)
        os.replace(f"{path}.part", path)
        return
    store, name = _opened(path)
    whole = store.type_name in _OBJECT_STORES
    if not whole:
        store.create_dir(posixpath.dirname(name), recursive=True)
    with store.open_output_stream(name if whole else f"{name}.part") as f:
        f.write(data)
    if not whole:
        store.move(f"{name}.part", name)


def is_file(path: str) -> bool:
    if not is_uri(path):
        return os.path.isfile(path)
    from pyarrow import fs

    store, name = _opened(path)
    return store.get_file_info(name).type == fs.FileType.File


def absolute(path: str) -> str:
    """A local path resolved; a URI as it is, without a slash at its end."""
    return path.rstrip("/") if is_uri(path) else os.path.realpath(path)
