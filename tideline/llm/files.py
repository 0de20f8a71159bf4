"""Files that tasks write themselves, on any file system pyarrow knows by its address."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import TaskContext


def _located(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address)


def file_name(number: int, suffix: str) -> str:
    """A name that no other partition, file number or attempt of a task has."""
    part = TaskContext.get().partitionId()
    return f"{part:09d}-{number:06d}-{uuid.uuid4().hex}{suffix}"


@contextmanager
def new_file(folder: str, name: str):
    """A binary stream to a new file of the folder. What a failed attempt leaves behind is
    in no list of files and never read."""
    system, path = _located(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        yield out
