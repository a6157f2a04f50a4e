"""Files that tasks write to and read from the shared folder themselves.

Paths are URIs of any file system that Arrow opens. A task gives each file a
name of its own and reports it in its rows; what the reports name is the
result, so files of failed or repeated attempts are never read.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    if uri.startswith("file:/"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def new_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


@contextmanager
def write_to(uri: str):
    fs, path = _open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        yield out


@contextmanager
def read_from(uri: str):
    """A seekable file; reading a range fetches that range."""
    fs, path = _open_fs(uri)
    with fs.open_input_file(path) as source:
        yield source


def read_range(source, start: int, size: int) -> bytes:
    source.seek(start)
    data = source.read(size)
    if len(data) != size:
        raise EOFError(f"{size} bytes at {start} asked, {len(data)} there")
    return data
