"""Files that tasks write to and read from the shared folder, through Arrow's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyarrow import fs


@contextmanager
def atomic_output(uri: str):
    """A binary stream that appears at ``uri`` only when complete.

    A lost or speculative attempt leaves at most a file of its own with another name; attempts
    of one task write the same bytes, so whichever is last wins.
    """
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with system.open_output_stream(own) as out:
            yield out
    except BaseException:
        system.delete_file(own)
        raise
    system.move(own, path)


def open_input(uri: str):
    """A seekable binary stream of ``uri``."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def exact_reader(stream) -> Callable[[int], bytes]:
    def read(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise EOFError(f"{n} bytes wanted, {len(data)} left")
        return data

    return read
