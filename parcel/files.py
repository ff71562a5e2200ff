"""Thin helpers over ``pyarrow.fs`` for the few file-metadata steps Spark's
DataFrame writer cannot do itself (final shard names, folder swap) and for the
byte copy that runs inside delivery tasks.

``pyarrow.fs`` resolves ``file:``, ``s3://``, ``gs://`` and ``hdfs://`` URIs on
the driver and on executors alike, so the same code names shards on the driver
and copies bytes in Python workers.
"""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable, Iterator

import pyarrow.fs as pafs

# Hadoop scheme aliases that pyarrow knows under another name.
_SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def _has_scheme(uri: str) -> bool:
    head = uri.split("/", 1)[0]
    return head.endswith(":") and len(head) > 2


def local_path(uri: str) -> str | None:
    """The OS path for a ``file:`` URI or bare path, else ``None``."""
    if uri.startswith("file://"):
        return uri[len("file://"):] or "/"
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if not _has_scheme(uri):
        return os.path.abspath(uri)
    return None


def qualify(uri: str) -> str:
    """The form in which Spark's file listings print paths under ``uri``.

    Local paths become ``file:/abs/path``; other URIs are returned as given.
    Trailing slashes are removed.
    """
    lp = local_path(uri)
    if lp is not None:
        return "file:" + os.path.normpath(lp)
    return uri.rstrip("/")


# One client per (scheme, bucket or host) and process: copying many files
# must not open a new object-store connection (credentials, region lookup)
# for every file.
_CLIENTS: dict[tuple[str, str], pafs.FileSystem] = {}
_BUCKET_SCHEMES = {"s3", "gs"}
_HOST_SCHEMES = {"hdfs", "viewfs"}
_LOCAL = pafs.LocalFileSystem()


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """(filesystem, path) for any URI pyarrow can reach."""
    lp = local_path(uri)
    if lp is not None:
        return _LOCAL, lp
    scheme, rest = uri.split("://", 1)
    scheme = _SCHEME_ALIASES.get(scheme, scheme)
    netloc, _, key = rest.partition("/")
    if scheme in _BUCKET_SCHEMES:
        path = f"{netloc}/{key}".rstrip("/") if key else netloc
    elif scheme in _HOST_SCHEMES:
        path = "/" + key
    else:
        return pafs.FileSystem.from_uri(f"{scheme}://{rest}")
    client = _CLIENTS.get((scheme, netloc))
    if client is None:
        client, _ = pafs.FileSystem.from_uri(f"{scheme}://{rest}")
        _CLIENTS[(scheme, netloc)] = client
    return client, path


def same_store(a: pafs.FileSystem, b: pafs.FileSystem) -> bool:
    """Can the store copy from one to the other by itself?"""
    return isinstance(a, pafs.FileSystem) and isinstance(b, pafs.FileSystem) and a.equals(b)


def join(base: str, *parts: str) -> str:
    out = base.rstrip("/")
    for p in parts:
        p = p.strip("/")
        if p:
            out = f"{out}/{p}"
    return out


def makedirs(uri: str) -> None:
    fs, path = resolve(uri)
    fs.create_dir(path, recursive=True)


def exists(uri: str) -> bool:
    fs, path = resolve(uri)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def delete_dir(uri: str) -> None:
    fs, path = resolve(uri)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def delete_file(uri: str) -> None:
    fs, path = resolve(uri)
    if fs.get_file_info(path).type == pafs.FileType.File:
        fs.delete_file(path)


def list_dir(uri: str) -> list[pafs.FileInfo]:
    """Entries directly under ``uri`` (files and folders, hidden names included)."""
    fs, path = resolve(uri)
    return fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))


def scan(uri: str) -> Iterator[tuple[str, str, Callable[[], tuple[int | None, datetime.datetime | None]]]]:
    """Entries directly under ``uri``, one at a time: name, ``File`` or
    ``Directory``, and a function for size and time of change (UTC). A mounted
    folder is read as a stream, and only entries that are asked get a look of
    their own; an object store tells all that in its listing."""
    local = local_path(uri)
    if local is None:
        for info in list_dir(uri):
            yield info.base_name, info.type.name, lambda i=info: (i.size, i.mtime)
        return
    try:
        entries = os.scandir(local)
    except FileNotFoundError:
        return
    except NotADirectoryError:
        return
    with entries:
        for entry in entries:
            def look(e=entry):
                found = e.stat()
                changed = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=found.st_mtime_ns // 1000)
                return found.st_size, changed

            yield entry.name, "Directory" if entry.is_dir() else "File", look


def write_whole(uri: str, data: bytes) -> None:
    """A small file that is there as a whole or not at all."""
    fs, path = resolve(uri)
    temporary = f"{path}.new"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(data)
    fs.move(temporary, path)


def touch(uri: str) -> None:
    """An empty file, whoever else makes it at the same time."""
    fs, path = resolve(uri)
    fs.open_output_stream(path, compression=None).close()


def read_whole(uri: str) -> bytes | None:
    """A small file's bytes; ``None`` if it isn't there."""
    fs, path = resolve(uri)
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path, compression=None) as data:
        return data.read()
