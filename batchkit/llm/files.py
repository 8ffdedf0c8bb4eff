"""Files that tasks write to and read from the shared folder, on any file system Spark and Arrow both know."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def new_name(folder: str, suffix: str) -> str:
    """A name no other attempt uses: what a lost or repeated task wrote is never read."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def opened(uri: str):
    """A stream to read."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path)


def created(uri: str):
    """A stream to write; missing folders are made."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path)


def save_table(uri: str, table: pa.Table) -> None:
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with created(uri) as sink, pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)


def load_table(uri: str) -> pa.Table:
    with opened(uri) as source:
        return pa.ipc.open_stream(source).read_all()
